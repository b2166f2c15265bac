"""Reference SQL (DuckDB) for the detector queries over hourly window results.

Independent of the Spark plans: running statistics are plain window sums over
the whole stream, tree paths are six unrolled joins with a split table, and the
half-space-tree score applies the stop rule literally (a CASE chain over the
seven node masses of each tree), not the parent-mass shortcut of the Spark form.
"""
from __future__ import annotations

from telemetra.constants import (ADWIN_CLOCK, ADWIN_DELTA, ADWIN_GRACE, ADWIN_MIN_WINDOW, DRIFT_COOLDOWN, FAULT_LIMITS,
                                 FEATURES, FIXTURE_SPEC, HOUR_MS, MIN_SAMPLES_FOR_DRIFT, SNAPSHOT_EVERY)
from telemetra.operators.detector import MAX_FEATURES, Z_DIGITS
from telemetra.operators.hst import BRANCHES, forest

KEYS = "datastream_id, window_start, fire_index"
ORDER = "result_time, window_start, fire_index"


def _feature_sql(name: str) -> str:
    return {
        "average": "average", "min_value": "min_value", "max_value": "max_value",
        "spread": "max_value - min_value", "delta": "delta",
        "rate": "delta / greatest((window_end - window_start) / 1000.0, 1.0)",
        "distinct_counts": "CAST(distinct_counts AS DOUBLE)", "activity_level": "true_ratio",
        "time": "CAST(time AS DOUBLE)", "day_of_week": "CAST(day_of_week AS DOUBLE)",
    }[name]


def features_cte(src: str = "hourly") -> str:
    fault = " ".join(
        f"WHEN metric = '{m}' THEN CASE WHEN min_value < {lo} THEN min_value "
        f"WHEN max_value > {hi} THEN max_value END" for m, (lo, hi) in FAULT_LIMITS.items())
    fcols = []
    for i in range(MAX_FEATURES):
        whens = " ".join(f"WHEN branch = '{b}' THEN {_feature_sql(n[i])}"
                         for b, n in FEATURES.items() if i < len(n))
        fcols.append(f"CASE {whens} END AS f{i}")
    return f"""
cal AS (
  SELECT datastream_id, metric, sensor_type, window_start, window_end, result_time, fire_index,
         min_value, max_value, average, delta, distinct_counts, true_ratio, true_count,
         hour(make_timestamp(window_end * 1000)) AS time,
         isodow(make_timestamp(window_end * 1000)) - 1 AS day_of_week,
         CASE WHEN sensor_type = 'analog' THEN CASE {fault} END END AS anomaly_value
  FROM {src}),
br AS (
  SELECT *, CASE WHEN sensor_type = 'analog' AND anomaly_value IS NOT NULL THEN 'fault'
                 WHEN sensor_type = 'analog' THEN 'analog'
                 WHEN sensor_type = 'counter' THEN 'counter'
                 WHEN sensor_type = 'state' THEN 'state'
                 WHEN sensor_type = 'alarm' AND metric = 'smoke' AND true_count > 0 THEN 'smoke'
                 WHEN sensor_type = 'alarm' AND metric = 'move' THEN 'motion' END AS branch
  FROM cal),
feat AS (SELECT *, {', '.join(fcols)} FROM br WHERE branch IS NOT NULL)"""


def _z(i: int, incl: bool) -> str:
    p = "l" if incl else "s"
    return (f"round(CASE WHEN {p}hi{i} > {p}lo{i} THEN (f{i} - {p}m{i}) / sqrt({p}v{i}) ELSE 0.0 END, {Z_DIGITS})")


def zscores_cte() -> str:
    stats = ", ".join(f"avg(f{i}) OVER {w} AS {p}m{i}, var_pop(f{i}) OVER {w} AS {p}v{i}, "
                      f"min(f{i}) OVER {w} AS {p}lo{i}, max(f{i}) OVER {w} AS {p}hi{i}"
                      for i in range(MAX_FEATURES) for p, w in (("s", "wp"), ("l", "wi")))
    zs = ", ".join(f"{_z(i, False)} AS zs{i}" for i in range(MAX_FEATURES))
    zl = ", ".join(f"{_z(i, True)} AS zl{i}" for i in range(MAX_FEATURES))
    branches = ", ".join(f"'{b}'" for b in BRANCHES)
    return f"""
run AS (
  SELECT *, row_number() OVER w AS n, {stats}
  FROM feat WHERE branch IN ({branches})
  WINDOW w AS (PARTITION BY datastream_id ORDER BY {ORDER}),
         wp AS (PARTITION BY datastream_id ORDER BY {ORDER}
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         wi AS (PARTITION BY datastream_id ORDER BY {ORDER}
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
zz AS (SELECT *, {zs}, {zl} FROM run)"""


def trees_cte() -> str:
    rows = []
    for b in BRANCHES:
        fr = forest(b)
        for t in range(fr.n_trees):
            for node, (k, thr) in enumerate(zip(fr.feats[t], fr.thrs[t])):
                rows.append(f"('{b}',{t},{node},{k},{thr!r})")
    return f"""
tr AS (SELECT * FROM (VALUES {', '.join(rows)}) v(branch, tree, node, feat, thr))"""


def hst_cte() -> str:
    fr = forest(BRANCHES[0])
    H, nn, lim = fr.height, fr.n_nodes, fr.size_limit
    zs_list = lambda p: "[" + ", ".join(f"{p}{i}" for i in range(MAX_FEATURES)) + "]"
    steps = [f"""
p0 AS (
  SELECT z.datastream_id, z.window_start, z.fire_index, z.n, (z.n - 1) // {fr.window} AS blk, z.branch,
         t.tree, {zs_list('zs')} AS zs, {zs_list('zl')} AS zl, 0 AS s0, 0 AS l0
  FROM zz z JOIN (SELECT DISTINCT branch, tree FROM tr) t ON t.branch = z.branch)"""]
    for d in range(1, H + 1):
        prev = ", ".join([f"p.s{j}" for j in range(d)] + [f"p.l{j}" for j in range(d)])
        steps.append(f"""
p{d} AS (
  SELECT p.datastream_id, p.window_start, p.fire_index, p.n, p.blk, p.branch, p.tree, p.zs, p.zl, {prev},
         2 * p.s{d-1} + 1 + CASE WHEN p.zs[a.feat + 1] < a.thr THEN 0 ELSE 1 END AS s{d},
         2 * p.l{d-1} + 1 + CASE WHEN p.zl[b.feat + 1] < b.thr THEN 0 ELSE 1 END AS l{d}
  FROM p{d-1} p
  JOIN tr a ON a.branch = p.branch AND a.tree = p.tree AND a.node = p.s{d-1}
  JOIN tr b ON b.branch = p.branch AND b.tree = p.tree AND b.node = p.l{d-1})""")
    snodes = ", ".join(f"s{d}" for d in range(H + 1))
    lnodes = ", ".join(f"l{d}" for d in range(H + 1))
    depths = ", ".join(str(d) for d in range(H + 1))
    chain = "0"
    for d in range(H, -1, -1):
        chain = (f"m{d} * {2 ** d}" if d == H else
                 f"m{d} * {2 ** d} + CASE WHEN m{d} < {lim} THEN 0 ELSE {chain} END")
    pivots = ", ".join(f"coalesce(max(CASE WHEN d = {d} THEN mass END), 0) AS m{d}" for d in range(H + 1))
    return ",".join(steps) + f""",
learned AS (
  SELECT datastream_id, blk, tree, unnest([{lnodes}]) AS node FROM p{H}),
mass AS (SELECT datastream_id, blk, tree, node, count(*) AS mass FROM learned GROUP BY ALL),
visit AS (
  SELECT datastream_id, window_start, fire_index, n, blk, tree,
         unnest([{snodes}]) AS node, unnest([{depths}]) AS d
  FROM p{H} WHERE blk > 0),
vm AS (
  SELECT v.datastream_id, v.n, v.tree, v.d, m.mass
  FROM visit v LEFT JOIN mass m
    ON m.datastream_id = v.datastream_id AND m.blk = v.blk - 1 AND m.tree = v.tree AND m.node = v.node),
per_tree AS (SELECT datastream_id, n, tree, {pivots} FROM vm GROUP BY datastream_id, n, tree),
tot AS (SELECT datastream_id, n, sum({chain}) AS total FROM per_tree GROUP BY datastream_id, n),
hst AS (
  SELECT z.datastream_id, z.window_start, z.fire_index, z.n, z.branch, z.sensor_type, z.metric,
         z.window_end, z.average, z.delta, z.distinct_counts, z.true_count,
         CASE WHEN (z.n - 1) // {fr.window} = 0 THEN 0.0
              ELSE 1.0 - coalesce(t.total, 0) / {fr.max_score} END AS anomaly_score
  FROM zz z LEFT JOIN tot t ON t.datastream_id = z.datastream_id AND t.n = z.n)"""


def epochs_cte() -> str:
    """Scores between drift resets: each step of the recursion scores the rest of every stream that
    drifted set-wise, and finds the first tick of the drift test at which two parts differ.

    ``epochs`` holds one row per stream and reset: rows after ``start`` up to ``stop`` (the
    drift's row; null without one) with their scores. ``borders`` are the prefix lengths at
    which the buckets of the drift test meet after n values.
    """
    branches = ", ".join(f"'{b}'" for b in BRANCHES)
    return f"""
numbered AS MATERIALIZED (
  SELECT *, datastream_id AS stream, row_number() OVER (PARTITION BY datastream_id ORDER BY {ORDER}) AS pos FROM feat),
levels AS (
  SELECT CAST(n AS BIGINT) AS n, CAST(1 AS BIGINT) AS size, CAST(n AS BIGINT) AS rest, CAST(0 AS BIGINT) AS newer
  FROM range({ADWIN_CLOCK}, (SELECT max(pos) + 1 FROM numbered), {ADWIN_CLOCK}) t(n)
  UNION ALL
  SELECT n, size * 2, (rest - b) // 2, newer + b * size
  FROM (SELECT *, CASE WHEN rest <= 5 THEN rest ELSE 4 + rest % 2 END AS b FROM levels) WHERE rest > b),
borders AS MATERIALIZED (
  SELECT n, n - newer - j * size AS n0
  FROM (SELECT *, unnest(range(1, CASE WHEN rest <= 5 THEN rest ELSE 4 + rest % 2 END + 1)) AS j FROM levels)
  WHERE n - newer - j * size >= {ADWIN_MIN_WINDOW} AND newer + j * size >= {ADWIN_MIN_WINDOW}),
epochs AS (
  SELECT stream, CAST(-1 AS BIGINT) AS epoch, CAST(0 AS BIGINT) AS start, CAST(0 AS BIGINT) AS stop,
         CAST([] AS STRUCT(pos BIGINT, cnt BIGINT, score DOUBLE)[]) AS scores
  FROM (SELECT DISTINCT stream FROM numbered)
  UNION ALL
  (WITH act AS (SELECT stream, epoch + 1 AS epoch, stop AS start FROM epochs WHERE stop IS NOT NULL),
  later AS (
    SELECT f.*, a.epoch, count(*) FILTER (WHERE branch <> 'fault') OVER (PARTITION BY f.stream ORDER BY pos) AS cnt
    FROM numbered f JOIN act a ON a.stream = f.stream AND f.pos > a.start),
  turns AS (
    SELECT *, row_number() OVER (PARTITION BY stream ORDER BY pos) AS mi,
           CASE WHEN branch <> lag(branch) OVER (PARTITION BY stream ORDER BY pos) THEN 1 ELSE 0 END AS turn
    FROM later WHERE branch IN ({branches})),
  parts AS (SELECT *, sum(turn) OVER (PARTITION BY stream ORDER BY pos) AS part FROM turns),
  feat AS (SELECT * REPLACE (stream || '#' || CAST(part AS VARCHAR) AS datastream_id) FROM parts),{zscores_cte()},{hst_cte()},
  scored AS (SELECT z.stream, z.epoch, z.pos, z.cnt, z.mi, h.anomaly_score AS score
             FROM zz z JOIN hst h ON h.datastream_id = z.datastream_id AND h.n = z.n),
  fed AS (
    SELECT stream, pos, row_number() OVER w AS k, sum(score) OVER w AS s, sum(score * score) OVER w AS q
    FROM scored WHERE mi > CASE WHEN epoch > 0 THEN {DRIFT_COOLDOWN} ELSE 0 END AND cnt >= {MIN_SAMPLES_FOR_DRIFT}
    WINDOW w AS (PARTITION BY stream ORDER BY pos ROWS UNBOUNDED PRECEDING)),
  splits AS (
    SELECT t.stream, t.pos, t.k, 1.0 / b.n0 + 1.0 / (t.k - b.n0) AS m, ln(2.0 * ln(t.k) / {ADWIN_DELTA}) AS l,
           greatest(t.q / t.k - (t.s / t.k) * (t.s / t.k), 0.0) AS v, abs(o.s / b.n0 - (t.s - o.s) / (t.k - b.n0)) AS gap
    FROM fed t JOIN borders b ON b.n = t.k JOIN fed o ON o.stream = t.stream AND o.k = b.n0
    WHERE t.k > {ADWIN_GRACE}),
  hits AS (SELECT stream, min(pos) AS stop FROM splits
           WHERE gap > sqrt(2.0 * m * v * l) + 2.0 / 3.0 * m * l GROUP BY stream)
  SELECT a.stream, a.epoch, a.start, h.stop,
         list({{'pos': s.pos, 'cnt': s.cnt, 'score': s.score}}) FILTER (WHERE s.pos <= coalesce(h.stop, s.pos)) AS scores
  FROM act a LEFT JOIN hits h ON h.stream = a.stream LEFT JOIN scored s ON s.stream = a.stream
  GROUP BY a.stream, a.epoch, a.start, h.stop)),
judged AS (
  SELECT e.stream, e.epoch, e.stop, x.pos, x.cnt, x.score
  FROM (SELECT stream, epoch, stop, unnest(scores) AS x FROM epochs WHERE epoch >= 0) e)"""


def points_select(src: str, value: str | None = None) -> str:
    return f"""
SELECT 'anomalies' AS measurement, sensor_type, metric, datastream_id,
       CASE WHEN branch = 'fault' THEN 'hardware_fault'
            WHEN branch IN ('analog', 'counter') THEN 'statistical' END AS anomaly_type,
       window_end AS time_ms,
       {value or ('anomaly_value' if src == 'feat' else 'CAST(NULL AS DOUBLE)')} AS anomaly_value,
       round(CASE WHEN branch = 'analog' THEN average END, 6) AS average,
       round(CASE WHEN branch = 'counter' THEN delta END, 6) AS delta,
       CASE WHEN branch = 'state' THEN distinct_counts END AS distinct_counts,
       CASE WHEN branch IN ('smoke', 'motion') THEN true_count END AS true_count,
       round(CASE WHEN branch IN ('fault', 'smoke') THEN 1.0
                  ELSE {'CAST(NULL AS DOUBLE)' if src == 'feat' else 'anomaly_score'} END, 6) AS anomaly_score
FROM {src}"""


def detector_queries(base: tuple[str, ...], plain_cte, with_) -> dict[str, str]:
    f, d, o = base
    hourly = plain_cte(HOUR_MS, "hourly", None)
    ft = features_cte()
    q: dict[str, str] = {}
    q["calendar_features"] = with_(f, d, o, hourly, ft, select=f"""
SELECT {KEYS}, branch, CAST(time AS INTEGER) AS time, CAST(day_of_week AS INTEGER) AS day_of_week
FROM feat""")
    W = FIXTURE_SPEC.window_ms
    q["detector_gate"] = with_(f, d, o, hourly, select=f"""
SELECT datastream_id, metric, sensor_type, window_start, window_end, result_time, fire_index,
       round(min_value, 6) AS min_value, round(max_value, 6) AS max_value, round(average, 6) AS average,
       round(delta, 6) AS delta, distinct_counts, round(true_ratio, 6) AS true_ratio, true_count
FROM hourly
WHERE ((window_start // {W}) + fire_index) % 9 NOT IN (1, 2, 3, 4, 6)
  AND CASE sensor_type WHEN 'analog' THEN min_value IS NOT NULL AND max_value IS NOT NULL
                                          AND average IS NOT NULL
                       WHEN 'counter' THEN delta IS NOT NULL
                       WHEN 'state' THEN distinct_counts IS NOT NULL
                       WHEN 'alarm' THEN true_ratio IS NOT NULL AND true_count IS NOT NULL
                       ELSE true END""")
    q["hardware_faults"] = with_(f, d, o, hourly, ft, select=points_select("feat") + "\nWHERE branch = 'fault'")
    q["smoke_events"] = with_(f, d, o, hourly, ft, select=points_select("feat") + "\nWHERE branch = 'smoke'")
    for b, names in FEATURES.items():
        cols = ", ".join(f"round(f{i}, 6) AS {n}" for i, n in enumerate(names))
        q[f"features_{b}"] = with_(f, d, o, hourly, ft, select=f"""
SELECT {KEYS}, {cols} FROM feat WHERE branch = '{b}'""")
    zc = zscores_cte()
    zcols = ", ".join(
        f"CASE WHEN {i} < CASE branch WHEN 'analog' THEN 6 WHEN 'counter' THEN 4 ELSE 3 END "
        f"THEN zs{i} END AS z{i}" for i in range(MAX_FEATURES))
    q["zscores"] = with_(f, d, o, hourly, ft, zc, select=f"SELECT {KEYS}, n, {zcols} FROM zz")
    h = hst_cte()
    t = trees_cte()
    q["hst_scores"] = with_(f, d, o, hourly, ft, zc, t, h, select=f"""
SELECT {KEYS}, n, round(anomaly_score, 6) AS anomaly_score FROM hst""")
    q["anomaly_statistical"] = with_(f, d, o, hourly, ft, zc, t, h, select=points_select("hst") + """
WHERE anomaly_score > 0.85 AND n >= 100""")
    resets = lambda select: with_(f, d, o, hourly, ft, t, epochs_cte(), select=select).replace("WITH", "WITH RECURSIVE", 1)
    q["adwin_drift"] = resets("""
SELECT 'concept_drift' AS measurement, r.sensor_type, r.metric, r.stream AS datastream_id, 'ADWIN' AS detector,
       r.window_end AS time_ms, round(j.score, 6) AS drift_value, j.cnt AS count_before_reset, j.epoch + 1 AS reset_count
FROM judged j JOIN numbered r ON r.stream = j.stream AND r.pos = j.pos WHERE j.pos = j.stop""")
    q["anomaly_full"] = resets(points_select("""(
  SELECT *, 1.0 AS anomaly_score FROM numbered WHERE branch IN ('fault', 'smoke')
  UNION ALL
  SELECT r.*, j.score FROM judged j JOIN numbered r ON r.stream = j.stream AND r.pos = j.pos
  WHERE j.score > 0.85 AND j.cnt >= 100 AND j.pos IS DISTINCT FROM j.stop)""", "CASE WHEN branch = 'fault' THEN anomaly_value END"))
    q["detector_state"] = resets(f"""
, saved AS (
  SELECT stream, stop AS pos FROM epochs WHERE epoch >= 0 AND stop IS NOT NULL
  UNION SELECT stream, pos FROM numbered WHERE pos % {SNAPSHOT_EVERY} = 0
  UNION SELECT stream, max(pos) FROM numbered GROUP BY stream)
SELECT e.stream AS datastream_id, e.epoch AS reset_count,
       (SELECT count(*) FROM numbered r WHERE r.stream = e.stream AND r.pos > e.start AND r.branch <> 'fault') AS "count",
       (SELECT count(*) FROM saved v WHERE v.stream = e.stream) AS snapshots
FROM epochs e WHERE e.epoch >= 0 AND e.stop IS NULL""")
    return q
