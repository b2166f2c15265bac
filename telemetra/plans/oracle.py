"""Reference SQL (DuckDB dialect) for the registered queries.

Written from the definitions, not from the Spark plans: the watermark is the plain
running maximum over the global arrival order and panes come from a self-join, so
agreement with the Spark plans (threshold tables, partial aggregates, running
late-state merge) is a real cross-check. Only the ``events`` view is read.
"""
from __future__ import annotations

import re

from telemetra.constants import (BROKEN_TIME, FIXTURE_SPEC, GARBAGE_PAYLOAD, HOUR_MS, METRIC_TYPE,
                                 NAMESPACE_DNS_HEX, NAMESPACE_URL_HEX, WindowSpec)
from telemetra.functions.timeparse import ISO_PATTERN
from telemetra.fixtures import feed as FD


def _case(col: str, mapping: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _iso(ms: str) -> str:
    return f"(strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || '+00:00')"


def feed_cte() -> str:
    stype = _case("event_type", {k: v[0] for k, v in FD.EVENT_SENSOR.items()})
    metric = "CASE " + " ".join(f"WHEN event_type = '{k}' THEN {list(v[1])}[user_id % {FD.THINGS} + 1]"
                                for k, v in FD.EVENT_SENSOR.items()) + " END"
    number = "CASE " + " ".join(f"WHEN metric0 = '{m}' THEN round(value * {a} + {b}, 2)"
                                for m, (a, b) in FD.SCALE.items()) + " ELSE value END"
    blank = lambda code, x: f"CASE WHEN fault = {code} THEN '   ' ELSE {x} END"
    return f"""
ev AS (
  SELECT event_id, user_id, event_type, value, props, epoch_us(ts) // 1000 AS ms FROM events),
cp AS (
  SELECT ev.*, c.copy FROM ev CROSS JOIN (VALUES (0), (1)) c(copy)
  WHERE c.copy = 0 OR ev.event_id % {FD.REPEAT_MOD} = {FD.REPEAT_REM}),
fx AS (
  SELECT *, {metric} AS metric0,
         CASE WHEN {stype} = 'state' AND event_id % {FD.MIXED_MOD} = {FD.MIXED_REM} THEN 'alarm' ELSE {stype} END AS stype,
         'thing-' || CAST(user_id % {FD.THINGS} AS VARCHAR) AS thing,
         event_id % {FD.FAULT_MOD} AS fault,
         ms + {FD.PUBLISH_STEP_MS} * (event_id % {FD.PUBLISH_MOD}) AS pub_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM cp),
fy AS (
  SELECT event_id, copy, fault,
         pub_ms + CASE WHEN event_id % {FD.LONG_DELAY_MOD} = 0 THEN {FD.LONG_DELAY_MS}
                       WHEN event_id % {FD.SHORT_DELAY_MOD} = 0 THEN {FD.SHORT_DELAY_MS} ELSE 0 END
                + {FD.COPY_DELAY_MS} * copy AS arrival_ms,
         event_id * 2 + copy AS arrival_seq,
         '{{"thing_id":"' || {blank(FD.BLANK_THING, 'thing')} || '","datastream_id":"' ||
         {blank(FD.BLANK_STREAM, "thing || ':' || metric0")} ||
         '","metric":"' || {blank(FD.BLANK_METRIC, 'metric0')} ||
         '","sensor_type":"' || CASE WHEN fault = {FD.UNKNOWN_TYPE} THEN 'gauge' ELSE stype END || '","seq":' ||
         CASE WHEN fault = {FD.TEXT_SEQ} THEN '"' || CAST(event_id AS VARCHAR) || '"'
              WHEN fault = {FD.DECIMAL_SEQ} THEN CAST(event_id AS VARCHAR) || '.0'
              WHEN fault = {FD.HUGE_SEQ} THEN '{FD.HUGE}' ELSE CAST(event_id AS VARCHAR) END ||
         ',"event_time":"' || CASE WHEN fault = {FD.BROKEN_EVENT_TIME} THEN '{BROKEN_TIME}'
                                   WHEN event_id % {FD.NAIVE_MOD} = {FD.NAIVE_REM} THEN left({_iso('ms')}, 23)
                                   ELSE {_iso('ms')} END ||
         '","publish_time":"' || CASE WHEN fault = {FD.BROKEN_PUBLISH_TIME} THEN '{BROKEN_TIME}'
                                      ELSE {_iso('pub_ms')} END || '","value":' ||
         CASE WHEN fault = {FD.NULL_VALUE} THEN 'null'
              WHEN fault = {FD.ODD_VALUE} THEN CASE WHEN stype = 'state' THEN '"OPEN"' ELSE '"warm"' END
              WHEN stype IN ('analog', 'counter') THEN coalesce(CAST({number} AS VARCHAR), 'null')
              WHEN stype = 'state' THEN CASE WHEN k % 2 = 0 THEN '"ON"' ELSE '"OFF"' END
              ELSE CASE WHEN value > 100 THEN 'true' ELSE 'false' END END || '}}' AS t
  FROM fx),
fj AS (
  SELECT event_id, copy, arrival_ms, arrival_seq,
         CASE fault WHEN {FD.GARBAGE} THEN '{GARBAGE_PAYLOAD}' WHEN {FD.NOT_AN_OBJECT} THEN '[' || t || ']'
                    WHEN {FD.TRUNCATED} THEN left(t, -1) WHEN {FD.TRAILING} THEN t || ' trailing'
                    WHEN {FD.HIDDEN_TRAILING} THEN t || '}} x' WHEN {FD.LED_BY_BLANK} THEN '  ' || t
                    ELSE t END AS payload
  FROM fy)"""


_STRING_FIELDS = ("thing_id", "datastream_id", "metric", "sensor_type", "event_time", "publish_time")


def decoded_cte() -> str:
    kinds = ",\n         ".join(
        f"CASE WHEN is_obj THEN json_type(payload, '$.{f}') END AS {f}_kind,\n"
        f"         CASE WHEN is_obj THEN json_extract_string(payload, '$.{f}') END AS {f}"
        for f in _STRING_FIELDS)
    blank = lambda f: f"regexp_replace({f}, '^\\s+|\\s+$', '', 'g') = ''"
    bad_str = lambda f: f"({f}_kind IS NULL OR {f}_kind <> 'VARCHAR' OR {blank(f)})"
    ts = lambda f: (f"CASE WHEN regexp_full_match({f}, '{ISO_PATTERN}') "  # noqa: E731
                    f"THEN TRY_CAST(CASE WHEN regexp_matches({f}, ':[0-9.]+(Z|[+-].*)$') THEN {f} ELSE {f} || '+00:00' END "
                    f"AS TIMESTAMPTZ) END")
    return f"""
d0 AS (
  SELECT arrival_ms, arrival_seq, octet_length(encode(payload)) AS size_bytes,
         coalesce(json_valid(payload) AND json_type(TRY_CAST(payload AS JSON)) = 'OBJECT', false) AS is_obj, payload
  FROM fj),
d1 AS (
  SELECT arrival_ms, arrival_seq, size_bytes, is_obj,
         {kinds},
         CASE WHEN is_obj THEN json_type(payload, '$.seq') END AS seq_kind,
         CASE WHEN is_obj THEN TRY_CAST(json_extract_string(payload, '$.seq') AS BIGINT) END AS seq,
         CASE WHEN is_obj THEN json_type(payload, '$.value') END AS vk,
         CASE WHEN is_obj THEN json_extract_string(payload, '$.value') END AS vtext
  FROM d0),
d2 AS (
  SELECT *,
    CASE WHEN vk IS NULL OR vk = 'NULL' THEN 'null' WHEN vk = 'VARCHAR' THEN 'string'
         WHEN vk = 'BOOLEAN' THEN 'bool' WHEN vk IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'number'
         ELSE 'other' END AS value_kind,
    {ts('event_time')} AS ev_ts, {ts('publish_time')} AS pub_ts
  FROM d1),
dec AS (
  SELECT arrival_ms, arrival_seq, size_bytes, thing_id, datastream_id, metric, sensor_type,
    event_time, publish_time, seq, value_kind,
    CASE WHEN value_kind = 'number' THEN CAST(vtext AS DOUBLE)
         WHEN value_kind = 'bool' THEN CASE WHEN vtext = 'true' THEN 1.0 ELSE 0.0 END END AS num,
    CASE WHEN value_kind = 'bool' THEN CASE WHEN vtext = 'true' THEN 'True' ELSE 'False' END
         WHEN value_kind IN ('string', 'number') THEN vtext END AS sval,
    CASE WHEN value_kind = 'bool' THEN vtext = 'true'
         WHEN value_kind = 'number' THEN CAST(vtext AS DOUBLE) <> 0
         WHEN value_kind = 'string' THEN length(vtext) > 0 ELSE false END AS bval,
    CASE WHEN NOT is_obj THEN 'decode_failed'
         WHEN {bad_str('thing_id')} THEN 'invalid_thing_id'
         WHEN {bad_str('datastream_id')} THEN 'invalid_datastream_id'
         WHEN {bad_str('metric')} THEN 'invalid_metric'
         WHEN sensor_type_kind IS NULL OR sensor_type_kind <> 'VARCHAR'
              OR sensor_type NOT IN ('analog', 'counter', 'state', 'alarm') THEN 'invalid_sensor_type'
         WHEN seq_kind IS NULL OR seq_kind NOT IN ('BIGINT', 'UBIGINT')
              OR NOT coalesce(seq BETWEEN -2147483648 AND 2147483647, false) THEN 'invalid_seq'
         WHEN {bad_str('event_time')} OR ev_ts IS NULL THEN 'invalid_event_time'
         WHEN value_kind = 'null' THEN 'invalid_value'
         WHEN {bad_str('publish_time')} OR pub_ts IS NULL THEN 'invalid_publish_time'
         WHEN sensor_type = 'analog' AND value_kind <> 'number' THEN 'invalid_analog_value'
         WHEN sensor_type = 'counter' AND value_kind <> 'number' THEN 'invalid_counter_value'
         WHEN sensor_type = 'state' AND NOT (value_kind = 'string' AND vtext IN ('ON', 'OFF'))
              THEN 'invalid_state_value'
         WHEN sensor_type = 'alarm' AND value_kind <> 'bool' THEN 'invalid_alarm_value'
    END AS error,
    epoch_ms(ev_ts) AS event_ms, epoch_ms(pub_ts) AS publish_ms
  FROM d2)"""


def ok_cte() -> str:
    return """
ok AS (
  SELECT thing_id, datastream_id, metric, sensor_type, seq, event_time, publish_time, value_kind,
         num, sval, bval, event_ms, publish_ms, arrival_ms, arrival_seq
  FROM dec WHERE error IS NULL)"""


def _wstart(ms: str, w: int) -> str:
    return f"({ms} - ((({ms}) % {w}) + {w}) % {w})"


def classified_cte(spec: WindowSpec) -> str:
    W, B, L = spec.window_ms, spec.bound_ms, spec.lateness_ms
    return f"""
wm AS (
  SELECT *, max(event_ms) OVER (ORDER BY arrival_ms, arrival_seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {B} - 1 AS wm,
         {_wstart('event_ms', W)} AS window_start
  FROM ok),
cls AS (
  SELECT *, window_start + {W} AS window_end,
         CASE WHEN wm >= window_start + {W} + {L} THEN 'too_late'
              WHEN wm IS NULL OR wm < window_start + {W} - 1 THEN 'on_time'
              ELSE 'late_accepted' END AS lateness
  FROM wm),
acc AS (
  SELECT * FROM cls WHERE lateness <> 'too_late'
  QUALIFY row_number() OVER (PARTITION BY datastream_id, window_start, seq
                             ORDER BY arrival_ms, arrival_seq) = 1)"""


def _state_select(a: str) -> str:
    o = f"{a}.arrival_ms, {a}.arrival_seq"
    last = f"{a}.event_ms DESC, {a}.arrival_ms DESC, {a}.arrival_seq DESC"
    first = f"{a}.event_ms, {a}.arrival_ms, {a}.arrival_seq"
    return f"""count(*) AS n, max({a}.event_ms) AS max_ev, max({a}.publish_ms) AS max_pub,
    max({a}.arrival_ms) AS max_arr,
    first({a}.sensor_type ORDER BY {o}) AS sensor_type, first({a}.metric ORDER BY {o}) AS metric,
    min({a}.num) FILTER (WHERE NOT isnan({a}.num)) AS vmin,
    max({a}.num) FILTER (WHERE NOT isnan({a}.num)) AS vmax, sum({a}.num) AS vsum,
    first({a}.num ORDER BY {first}) AS cfirst, first({a}.num ORDER BY {last}) AS clast,
    count(*) FILTER (WHERE {a}.sval = 'ON') AS n_on_v, count(*) FILTER (WHERE {a}.sval = 'OFF') AS n_off_v,
    count(DISTINCT {a}.sval) FILTER (WHERE {a}.sensor_type IN ('state', 'alarm')
                                      AND {a}.sval NOT IN ('ON', 'OFF')) AS n_other,
    first({a}.sval ORDER BY {last}) AS slast,
    count(*) FILTER (WHERE {a}.bval) AS tc, count(*) FILTER (WHERE NOT {a}.bval) AS fc,
    first({a}.bval ORDER BY {last}) AS alast"""


def result_select(W: int, src: str = "g", digits: int | None = 6) -> str:
    """Wide result columns (same names/types as the Spark ``finalize``)."""
    st = f"{src}.sensor_type"
    out = f"""{src}.datastream_id,
  strftime(make_timestamp({src}.window_start * 1000), '%H:%M:%S') || ' - ' ||
    strftime(make_timestamp(({src}.window_start + {W}) * 1000), '%H:%M:%S') AS "window",
  {src}.n AS count, {st} AS sensor_type, {src}.metric, {src}.window_start,
  {src}.window_start + {W} AS window_end, {src}.result_ms AS result_time,
  greatest({src}.max_ev, 0) AS max_event_time, greatest({src}.max_pub, 0) AS max_publish_time,
  CASE WHEN greatest({src}.max_ev, 0) > 0 THEN {src}.result_ms - greatest({src}.max_ev, 0) ELSE 0 END AS latency,
  CASE WHEN greatest({src}.max_pub, 0) > 0 THEN {src}.result_ms - greatest({src}.max_pub, 0) ELSE 0 END
    AS end_to_end_latency,
  CAST({src}.pane AS INTEGER) AS fire_index, {src}.pane > 1 AS is_late_firing,
  round(CASE WHEN {st} = 'counter' THEN coalesce({src}.cfirst, 0.0) END, 6) AS first_value,
  round(CASE WHEN {st} = 'counter' THEN coalesce({src}.clast, 0.0) END, 6) AS last_value,
  round(CASE WHEN {st} = 'counter' THEN coalesce({src}.clast, 0.0) - coalesce({src}.cfirst, 0.0) END, 6) AS delta,
  round(CASE WHEN {st} = 'analog' THEN {src}.vmin END, 6) AS min_value,
  round(CASE WHEN {st} = 'analog' THEN {src}.vmax END, 6) AS max_value,
  CASE WHEN {st} = 'analog' THEN round({src}.vsum / {src}.n, 6) END AS average,
  CAST(CASE WHEN {st} = 'state' THEN CAST({src}.n_on_v > 0 AS INT) + CAST({src}.n_off_v > 0 AS INT) + {src}.n_other
       WHEN {st} = 'alarm' THEN CAST({src}.tc > 0 AS INT) + CAST({src}.fc > 0 AS INT) END AS BIGINT)
    AS distinct_counts,
  CASE WHEN {st} = 'state' THEN {src}.n_on_v END AS on_count,
  CASE WHEN {st} = 'state' THEN {src}.n_off_v END AS off_count,
  CASE WHEN {st} = 'state' THEN {src}.slast END AS last_state,
  CASE WHEN {st} = 'alarm' THEN {src}.tc END AS true_count,
  CASE WHEN {st} = 'alarm' THEN {src}.fc END AS false_count,
  CASE WHEN {st} = 'alarm' THEN round({src}.tc / {src}.n, 6) END AS true_ratio,
  CASE WHEN {st} = 'alarm' THEN {src}.tc > 0 END AS triggered,
  CASE WHEN {st} = 'alarm' THEN {src}.alast END AS alarm_last_value"""
    if digits is None:   # full precision (detector input)
        out = re.sub(r"round\(([^\n]*?), 6\)( END)? AS", r"\1\2 AS", out)
    return out


def panes_cte(spec: WindowSpec) -> str:
    W, B = spec.window_ms, spec.bound_ms
    return f"""
cnt AS (
  SELECT *, count(*) FILTER (WHERE lateness = 'on_time')
              OVER (PARTITION BY datastream_id, window_start) AS n_on
  FROM acc),
numbered AS (
  SELECT *, CASE WHEN lateness = 'on_time' THEN 1
                 ELSE row_number() OVER (PARTITION BY datastream_id, window_start, lateness
                                         ORDER BY arrival_ms, arrival_seq)
                      + CASE WHEN n_on > 0 THEN 1 ELSE 0 END END AS pane
  FROM cnt),
pl AS (SELECT DISTINCT datastream_id, window_start, pane, n_on FROM numbered),
fw AS (
  SELECT w.window_start,
         (SELECT min(o.arrival_ms) FROM ok o WHERE o.event_ms >= w.window_start + {W} + {B}) AS fire_ms
  FROM (SELECT DISTINCT window_start FROM acc) w),
pg AS (
  SELECT p.datastream_id, p.window_start, p.pane, any_value(p.n_on) AS n_on, {_state_select('a')}
  FROM pl p JOIN numbered a
    ON a.datastream_id = p.datastream_id AND a.window_start = p.window_start AND a.pane <= p.pane
  GROUP BY p.datastream_id, p.window_start, p.pane),
g AS (
  SELECT pg.*, CASE WHEN pg.pane = 1 AND pg.n_on > 0 THEN coalesce(fw.fire_ms, pg.max_arr)
                    ELSE pg.max_arr END AS result_ms
  FROM pg JOIN fw USING (window_start)),
results AS (SELECT {result_select(W)} FROM g)"""


def stream_cte(spec: WindowSpec, n_batches: int) -> str:
    """Micro-batch replay: batches are equal arrival spans of the raw feed; the watermark
    before batch b is the max event time of earlier batches - bound - 1. Pane 1 is
    emitted once the final watermark passes the window; every late pane is emitted."""
    W, B, L = spec.window_ms, spec.bound_ms, spec.lateness_ms
    return f"""
span AS (SELECT min(arrival_ms) AS lo, (max(arrival_ms) - min(arrival_ms) + 1 + {n_batches - 1}) // {n_batches} AS sp
         FROM fj),
bok AS (SELECT ok.*, (ok.arrival_ms - span.lo) // span.sp AS batch FROM ok, span),
bmax AS (SELECT batch, max(event_ms) AS mx FROM bok GROUP BY batch),
bwm AS (SELECT b.batch, (SELECT max(m.mx) FROM bmax m WHERE m.batch < b.batch) - {B} - 1 AS wm
        FROM (SELECT DISTINCT batch FROM bok) b),
scls AS (
  SELECT bok.*, {_wstart('event_ms', W)} AS window_start, {_wstart('event_ms', W)} + {W} AS window_end,
         CASE WHEN bwm.wm >= {_wstart('event_ms', W)} + {W} + {L} THEN 'too_late'
              WHEN bwm.wm IS NULL OR bwm.wm < {_wstart('event_ms', W)} + {W} - 1 THEN 'on_time'
              ELSE 'late_accepted' END AS lateness
  FROM bok JOIN bwm USING (batch)),
sacc AS (
  SELECT * FROM scls WHERE lateness <> 'too_late'
  QUALIFY row_number() OVER (PARTITION BY datastream_id, window_start, seq
                             ORDER BY arrival_ms, arrival_seq) = 1),
scnt AS (
  SELECT *, count(*) FILTER (WHERE lateness = 'on_time')
              OVER (PARTITION BY datastream_id, window_start) AS n_on
  FROM sacc),
snum AS (
  SELECT *, CASE WHEN lateness = 'on_time' THEN 1
                 ELSE row_number() OVER (PARTITION BY datastream_id, window_start, lateness
                                         ORDER BY arrival_ms, arrival_seq)
                      + CASE WHEN n_on > 0 THEN 1 ELSE 0 END END AS pane
  FROM scnt),
spl AS (SELECT DISTINCT datastream_id, window_start, pane, n_on FROM snum),
spg AS (
  SELECT p.datastream_id, p.window_start, p.pane, any_value(p.n_on) AS n_on, {_state_select('a')}
  FROM spl p JOIN snum a
    ON a.datastream_id = p.datastream_id AND a.window_start = p.window_start AND a.pane <= p.pane
  GROUP BY p.datastream_id, p.window_start, p.pane),
sg AS (
  SELECT spg.*, spg.max_arr AS result_ms FROM spg
  WHERE spg.pane > 1 OR spg.n_on = 0
     OR (SELECT max(event_ms) FROM bok) - {B} - 1 >= spg.window_start + {W} - 1),
sresults AS (SELECT {result_select(W, 'sg')} FROM sg)"""


def plain_cte(window_ms: int, name: str = "plain", digits: int | None = 6) -> str:
    W = window_ms
    return f"""
pw AS (SELECT *, {_wstart('event_ms', W)} AS window_start FROM ok
       QUALIFY row_number() OVER (PARTITION BY datastream_id, {_wstart('event_ms', W)}, seq
                                  ORDER BY arrival_ms, arrival_seq) = 1),
pgg AS (SELECT a.datastream_id, a.window_start, 1 AS pane, {_state_select('a')}
        FROM pw a GROUP BY a.datastream_id, a.window_start),
pg2 AS (SELECT *, max_arr AS result_ms FROM pgg),
{name} AS (SELECT {result_select(W, 'pg2', digits)} FROM pg2)"""


def _uuid5_sql(ns_hex: str, name: str) -> str:
    """uuid5 text: SHA-1 of namespace bytes + name, version nibble 5, variant bits 10xx."""
    h = f"sha1(unhex('{ns_hex}') || encode({name}))"
    var = (f"substr('0123456789abcdef', (((strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) & 3) | 8) + 1, 1)")
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"{var} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))")


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


# --------------------------------------------------------------------------- queries

def base(spec: WindowSpec = FIXTURE_SPEC) -> tuple[str, ...]:
    return (feed_cte(), decoded_cte(), ok_cte(), classified_cte(spec))


def oracle_queries(spec: WindowSpec = FIXTURE_SPEC) -> dict[str, str]:
    W, L = spec.window_ms, spec.lateness_ms
    f, d, o, c = base(spec)
    q: dict[str, str] = {}
    q["obs_typed"] = with_(f, d, select="""
SELECT arrival_seq, error, thing_id, datastream_id, metric, sensor_type, seq, value_kind,
       round(num, 6) AS num, CASE WHEN value_kind <> 'number' THEN sval END AS sval, bval,
       event_ms, publish_ms FROM dec""")
    q["dlq_reasons_windowed"] = with_(f, d, select=f"""
SELECT {_wstart('arrival_ms', W)} AS window_start, {_wstart('arrival_ms', W)} + {W} AS window_end,
       error AS reason, count(*) AS dlq_count
FROM dec WHERE error IS NOT NULL GROUP BY 1, 2, 3""")
    from telemetra.fixtures.avro_feed import DAMAGED
    gone = lambda c: f"CASE WHEN NOT bad THEN {c} END AS {c}"
    text = ", ".join(gone(c) for c in ("thing_id", "datastream_id", "metric", "sensor_type", "seq"))
    q["obs_avro"] = with_(f, d, f"""
flagged AS (SELECT *, value_kind = 'null' OR (arrival_seq // 2) % {FD.FAULT_MOD} IN {DAMAGED} AS bad FROM dec)""", select=f"""
SELECT arrival_seq, CASE WHEN bad THEN 'decode_failed' ELSE error END AS error, {text},
       CASE WHEN bad THEN 'null' ELSE value_kind END AS value_kind, CASE WHEN NOT bad THEN round(num, 6) END AS num,
       CASE WHEN NOT bad AND value_kind <> 'number' THEN sval END AS sval, NOT bad AND bval AS bval,
       {gone("event_ms")}, {gone("publish_ms")} FROM flagged""")
    q["ok_observations"] = with_(f, d, o, select="""
SELECT thing_id, datastream_id, metric, sensor_type, seq, event_time, publish_time, value_kind,
       round(num, 6) AS num, bval, event_ms, publish_ms, arrival_ms, arrival_seq FROM ok""")
    q["dlq_records"] = with_(f, d, select="""
SELECT error,
       CASE WHEN error = 'decode_failed' THEN 'payload is not a JSON object' END AS error_details,
       strftime(make_timestamp(arrival_ms * 1000), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
       CASE WHEN error = 'decode_failed' THEN size_bytes END AS size_bytes,
       CASE WHEN error <> 'decode_failed' THEN left(coalesce(thing_id, ''), 100) END AS thing_id,
       CASE WHEN error <> 'decode_failed' THEN left(coalesce(datastream_id, ''), 100) END AS datastream_id,
       CASE WHEN error <> 'decode_failed' THEN left(coalesce(metric, ''), 100) END AS metric,
       CASE WHEN error <> 'decode_failed' THEN left(coalesce(sensor_type, ''), 50) END AS sensor_type,
       CASE WHEN error <> 'decode_failed' THEN seq END AS seq,
       arrival_ms, arrival_seq
FROM dec WHERE error IS NOT NULL""")
    q["dlq_reasons"] = with_(f, d, select="""
SELECT error AS reason, count(*) AS dlq_count FROM dec WHERE error IS NOT NULL GROUP BY error""")
    metric_map = _case("metric", METRIC_TYPE)
    by_value = ("CASE WHEN value_kind = 'string' THEN 'state' WHEN value_kind = 'bool' THEN 'alarm' "
                "ELSE 'analog' END")
    q["type_by_metric"] = with_(f, d, select=f"""
SELECT arrival_seq, metric, value_kind, coalesce({metric_map}, {by_value}) AS type_by_metric
FROM dec WHERE error IS NULL OR error <> 'decode_failed'""")
    q["type_by_value"] = with_(f, d, select=f"""
SELECT arrival_seq, value_kind, {by_value} AS type_by_value,
       coalesce(CASE WHEN sensor_type IN ('analog', 'counter', 'state', 'alarm') THEN sensor_type END,
                {metric_map}, {by_value}) AS identify_type
FROM dec WHERE error IS NULL OR error <> 'decode_failed'""")
    q["lateness_classes"] = with_(f, d, o, c, select="""
SELECT arrival_ms, arrival_seq, datastream_id, seq, window_start, window_end, lateness FROM cls""")
    B = spec.bound_ms
    q["watermark_replay"] = with_(f, d, o, c, select=f"""
SELECT w.window_start,
  (SELECT min(o.arrival_ms) FROM ok o WHERE o.event_ms >= w.window_start + {W} + {B}) AS fire_arrival_ms,
  (SELECT min(o.arrival_ms) FROM ok o WHERE o.event_ms >= w.window_start + {W} + {L} + {B} + 1)
    AS expire_arrival_ms,
  w.n AS n_rows
FROM (SELECT window_start, count(*) AS n FROM cls GROUP BY window_start) w""")
    from telemetra.plans.catalog import SILENT_MS, SOURCE_IDLE_MS, STREAM_BATCHES
    q["watermark_idle"] = with_(f, d, o, f"""
src AS (SELECT arrival_ms, arrival_seq, event_ms,
               CASE WHEN thing_id = 'thing-4' AND (arrival_ms // {SILENT_MS}) % 2 = 1 THEN 'thing-0' ELSE thing_id END AS source
        FROM ok),
inst AS (SELECT arrival_ms AS ms, arrival_seq AS seq FROM src UNION SELECT arrival_ms + {SOURCE_IDLE_MS}, -1 FROM src),
tl AS (SELECT i.ms, i.seq, s.source, r.event_ms, r.arrival_ms
       FROM inst i CROSS JOIN (SELECT DISTINCT source FROM src) s
       LEFT JOIN src r ON r.source = s.source AND r.arrival_ms = i.ms AND r.arrival_seq = i.seq),
st AS (SELECT ms, seq, max(event_ms) OVER w AS mx, max(arrival_ms) OVER w AS heard
       FROM tl WINDOW w AS (PARTITION BY source ORDER BY ms, seq ROWS UNBOUNDED PRECEDING)),
comb AS (SELECT ms, seq, min(mx) AS m FROM st WHERE heard IS NOT NULL AND ms - heard < {SOURCE_IDLE_MS} GROUP BY ms, seq),
wins AS (SELECT {_wstart('event_ms', W)} AS window_start, count(*) AS n_rows FROM ok GROUP BY 1),
moved AS (SELECT window_start, n_rows,
  (SELECT min({{'ms': ms, 'seq': seq}}) FROM comb WHERE m >= window_start + {W} + {B}) AS f,
  (SELECT min({{'ms': ms, 'seq': seq}}) FROM comb WHERE m >= window_start + {W} + {L} + {B} + 1) AS e FROM wins)""", select="""
SELECT window_start, f.ms AS fire_arrival_ms, f.seq AS fire_arrival_seq, e.ms AS expire_arrival_ms, e.seq AS expire_arrival_seq, n_rows
FROM moved""")
    q["late_records"] = with_(f, d, o, c, select=f"""
SELECT thing_id, datastream_id, metric, sensor_type, seq, event_time, publish_time,
       round(greatest(0.0, (arrival_ms - (window_end + {L})) / 1000.0), 3) AS late_by_sec
FROM cls WHERE lateness = 'too_late'""")
    q["dedup_seq"] = with_(f, d, o, c, select="""
SELECT datastream_id, window_start, seq, arrival_ms, arrival_seq, lateness FROM acc""")
    p = panes_cte(spec)
    q["window_panes"] = with_(f, d, o, c, p, select="SELECT * FROM results")
    q["late_firing_report"] = with_(f, d, o, c, p, select="""
SELECT datastream_id, window_start, fire_index,
       '[LATE FIRING] key=' || datastream_id || ' metric=' || metric || ' window=' || "window" ||
       ' fire_index=' || CAST(fire_index AS VARCHAR) AS line
FROM results WHERE is_late_firing""")
    q["latency_metrics"] = with_(f, d, o, c, p, select="""
SELECT datastream_id, window_start, fire_index, result_time, latency, end_to_end_latency,
       (window_end - window_start) / 1000.0 AS window_duration_sec,
       round(CASE WHEN (window_end - window_start) > 0
                  THEN count / ((window_end - window_start) / 1000.0) ELSE 0.0 END, 6) AS throughput
FROM results""")
    # spoiled messages: no count, text latency and arrays are dropped; without fire_index it is 1
    spoil = f"((window_start // {W}) + fire_index) % 13"
    passed = f"""
passed AS (SELECT * REPLACE (CASE WHEN {spoil} = 3 THEN 1 ELSE fire_index END AS fire_index)
           FROM results WHERE {spoil} NOT IN (1, 2, 4))"""
    pts = """'processed_data' AS measurement, sensor_type, metric, datastream_id,
  CAST(fire_index AS VARCHAR) AS fire_index, window_end AS time_ms, window_start, window_end, count,
  result_time, max_event_time, max_publish_time, (window_end - window_start) / 1000.0 AS window_duration_sec,
  latency, end_to_end_latency,
  round(CASE WHEN window_end > window_start THEN count / ((window_end - window_start) / 1000.0)
             ELSE 0.0 END, 6) AS throughput"""
    q["required_fields_gate"] = with_(f, d, o, c, p, passed, select="""
SELECT metric, sensor_type, datastream_id, window_start, window_end, count, latency, end_to_end_latency,
  result_time, max_event_time, max_publish_time, CAST(fire_index AS BIGINT) AS fire_index,
  (window_end - window_start) / 1000.0 AS window_duration_sec,
  round(CASE WHEN window_end > window_start THEN count / ((window_end - window_start) / 1000.0)
             ELSE 0.0 END, 6) AS throughput
FROM passed""")
    type_fields = {"analog": ("min_value", "max_value", "average"),
                   "counter": ("delta", "first_value", "last_value"),
                   "state": ("on_count", "off_count", "distinct_counts"),
                   "alarm": ("true_ratio", "false_count", "true_count")}
    for t, fl in type_fields.items():
        q[f"points_{t}"] = with_(f, d, o, c, p, passed, select=f"""
SELECT {pts}, {', '.join(fl)} FROM passed
WHERE sensor_type = '{t}' AND {' AND '.join(x + ' IS NOT NULL' for x in fl)}""")
    ts = "strftime(make_timestamp(arrival_ms * 1000), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
    dlq_text = f"""CASE WHEN error = 'decode_failed' THEN
      '{{"error":"decode_failed","error_details":"payload is not a JSON object","timestamp":"' || {ts}
      || '","size_bytes":' || CAST(size_bytes AS VARCHAR) || '}}'
    ELSE '{{"error":"' || error || '","timestamp":"' || {ts} || '","thing_id":"' || left(coalesce(thing_id, ''), 100)
      || '","datastream_id":"' || left(coalesce(datastream_id, ''), 100) || '","metric":"'
      || left(coalesce(metric, ''), 100) || '","sensor_type":"' || left(coalesce(sensor_type, ''), 50)
      || '","seq":' || coalesce(CAST(seq AS VARCHAR), 'null') || '}}' END"""
    dbl = lambda x: f"""CASE WHEN arrival_seq % 3 = 0 THEN '"' || replace(replace({x}, '\\', '\\\\'), '"', '\\"') || '"' ELSE {x} END"""
    dlq_topic = f"""
dlqt AS (SELECT arrival_seq, arrival_ms AS timestamp_ms, error, thing_id, seq,
                {dbl(dlq_text)} AS value
         FROM dec WHERE error IS NOT NULL)"""
    spoiled_text = f"""CASE arrival_seq % 11 WHEN 5 THEN regexp_replace({dlq_text}, '"error":"[^"]*",', '')
                             ELSE {dlq_text} END"""
    q["dlq_points"] = with_(f, d, select=f"""
SELECT 'dlq_metrics' AS measurement, CASE arrival_seq % 11 WHEN 5 THEN 'unknown' ELSE error END AS reason,
       'flink_decoder' AS stage, sha256({dbl(spoiled_text)}) AS dlq_id,
       CAST(1 AS BIGINT) AS dlq_count, arrival_ms AS time_ms
FROM dec WHERE error IS NOT NULL AND arrival_seq % 11 <> 4""")
    q["double_encoded_unwrap"] = with_(f, d, dlq_topic, select="""
SELECT arrival_seq, error, CASE WHEN error <> 'decode_failed' THEN left(coalesce(thing_id, ''), 100) END AS thing_id,
       CASE WHEN error <> 'decode_failed' THEN seq END AS seq
FROM dlqt""")
    late_pts = f"""
lp AS (SELECT 'late_events' AS measurement, coalesce(datastream_id, 'unknown') AS datastream_id,
              CASE arrival_seq % 5 WHEN 2 THEN 'unknown' ELSE coalesce(metric, 'unknown') END AS metric,
              CASE arrival_seq % 5 WHEN 3 THEN 'NA' ELSE CAST(seq AS VARCHAR) END AS seq,
              CASE arrival_seq % 5 WHEN 1 THEN 0.0
                   ELSE round(greatest(0.0, (arrival_ms - (window_end + {L})) / 1000.0), 3) END AS late_by_seconds,
              CAST(1 AS BIGINT) AS late_count, event_ms AS time_ms, arrival_ms, arrival_seq
       FROM cls WHERE lateness = 'too_late')"""
    q["late_points"] = with_(f, d, o, c, late_pts, select="""
SELECT measurement, datastream_id, metric, seq, late_by_seconds, late_count, time_ms FROM lp""")
    q["upsert_latest"] = with_(f, d, o, c, late_pts, select="""
SELECT measurement, datastream_id, metric, seq, late_by_seconds, late_count, time_ms FROM lp
QUALIFY row_number() OVER (PARTITION BY measurement, datastream_id, metric, seq, time_ms
                           ORDER BY arrival_ms DESC, arrival_seq DESC) = 1""")
    q["payload_hygiene"] = with_(f, d, o, c, p, select=f"""
SELECT datastream_id, window_start, CAST(fire_index AS BIGINT) AS fire_index FROM results
WHERE ((window_start // {W}) + fire_index) % 9 NOT IN (1, 2, 3, 4, 6)""")
    pl = plain_cte(W)
    for t in ("analog", "counter", "state", "alarm"):
        q[f"window_{t}"] = with_(f, d, o, pl, select=f"""
SELECT {', '.join(f'"{c}"' for c in TYPE_COLUMNS[t])} FROM plain WHERE sensor_type = '{t}'""")
    q["datastream_keys"] = with_(f, d, o, select=f"""
SELECT thing_id, metric, sensor_type,
       {_uuid5_sql(NAMESPACE_URL_HEX, "thing_id || ':' || metric")} AS datastream_key,
       {_uuid5_sql(NAMESPACE_DNS_HEX, "'iot-simulator:' || sensor_type || ':' || "
                   "CAST(CAST(split_part(thing_id, '-', 2) AS INTEGER) AS VARCHAR)")} AS thing_key
FROM (SELECT DISTINCT thing_id, metric, sensor_type FROM ok)""")
    q["stream_panes"] = with_(f, d, o, stream_cte(spec, STREAM_BATCHES), select="SELECT * FROM sresults")
    from telemetra.plans.oracle_detector import detector_queries
    q.update(detector_queries((f, d, o), plain_cte, with_))
    return q


COMMON = ("datastream_id", "window", "count", "sensor_type", "metric", "window_start", "window_end",
          "max_event_time", "max_publish_time")
TYPE_COLUMNS = {
    "analog": COMMON + ("min_value", "max_value", "average"),
    "counter": COMMON + ("first_value", "last_value", "delta"),
    "state": COMMON + ("distinct_counts", "on_count", "off_count", "last_state"),
    "alarm": COMMON + ("distinct_counts", "true_count", "false_count", "true_ratio", "triggered",
                       "alarm_last_value"),
}
