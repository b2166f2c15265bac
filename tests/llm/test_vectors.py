"""Top-k search and centroid clustering: brute force, DuckDB SQL, bounds, odd rows."""
import hashlib
import math

import duckdb
import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from telemetra.llm import bitplanes, queries, topk

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def table(spark, rows, clash=()):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in clash:
        df = df.selectExpr("*", f"1 AS {name}")
    return df


def in_duckdb(sql, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    return sorted(con.execute(sql).fetchall(), key=str)


def test_queries_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    for name in ("op11_nra_topk", "op12_bitplane_clusters"):
        got = queries.queries()[name](spark, SF)
        sql = con.sql(queries.oracle_sql()[name])
        assert got.columns == sql.columns
        assert sorted(map(tuple, got.collect())) == sorted(sql.fetchall())


def brute_topk(rows, k=topk.K):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q is not None and q % 100 == 0:
            found = sorted(((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for i, w in ok if i != q))[:k]
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(found)]
    return sorted(out, key=str)


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.1, 8).astype(np.float32).tolist()) for i in range(230)]
    rows += [(300, rows[3][1]), (301, rows[3][1]), (302, rows[3][1])]          # ties
    rows += [(400, rows[7][1])] * 2                                           # a repeated query
    rows += [(None, rows[3][1]), (500, None), (501, [0.5, None]), (502, [NAN] * 8), (503, [INF] + [0.0] * 7),
             (600, []), (601, [0.25]), (700, [9.0] * 12), (701, [-3000.0] * 8)]
    return rows


def test_topk_odd_rows(spark):
    rows = odd_vectors()
    df = table(spark, rows, ("query_id", "rank", "score", "n", "q", "v", "id")).repartition(5)
    got = topk.search(df, F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False))).collect()
    assert sorted(map(tuple, got), key=str) == brute_topk(rows)
    assert in_duckdb(topk.SQL, rows) == brute_topk(rows)
    assert topk.search(table(spark, []), F.col("vec_id") % 100 == 0).isEmpty()
    assert topk.search(table(spark, [(1, [1.0])]), F.col("vec_id") % 100 == 0).isEmpty()    # no query
    alone = topk.search(table(spark, [(0, [1.0]), (5, [1.0])]), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in alone] == [(0, 1, 5, 1024 * 1024)]


def test_topk_in_slabs(spark, monkeypatch):
    """More query components than one broadcast may hold: several slabs, the same rows."""
    rows = odd_vectors()
    monkeypatch.setattr(topk, "SLAB_COMPONENTS", 24)
    got = topk.search(table(spark, rows).repartition(3), F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False))).collect()
    assert sorted(map(tuple, got), key=str) == brute_topk(rows)


def run_blocks(blocks, batch, k, trace=None):
    best = topk.Best(len(batch), k)
    ids = -1 - np.arange(len(batch))
    start = 0
    for x in blocks:
        block = topk.Block(np.arange(start, start + len(x)), np.ones(len(x), bool), x)
        topk.search_block(block, batch, ids, best, trace)
        start += len(x)
    return list(zip(best.query.tolist(), best.id.tolist(), best.score.tolist()))


def plain(blocks, batch, k):
    score = np.concatenate(blocks).astype(object) @ batch.T.astype(object)
    return [(q, i, score[i, q]) for q in range(len(batch))
            for i in sorted(range(len(score)), key=lambda i: (-score[i, q], i))[:k]]


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2 ** 32 - 1), st.integers(1, 60), st.integers(1, 6), st.integers(1, 5),
       st.sampled_from([2, 50, 1 << 25]))
def test_blocks_equal_all_scores(seed, n, width, k, most):
    rng = np.random.default_rng(seed)
    blocks = [rng.integers(-most, most + 1, (n, width)), rng.integers(-most, most + 1, (max(1, n // 2), width))]
    batch = rng.integers(-most, most + 1, (4, width))
    assert run_blocks(blocks, batch, k) == plain(blocks, batch, k)


def test_bounds_hold_and_searches_stop_early():
    rng = np.random.default_rng(3)
    x = rng.integers(-500, 500, (512, 16))
    block = topk.Block(np.arange(512), np.ones(512, bool), x)
    q = rng.integers(-500, 500, (5, 16))
    exact, before = x @ q.T, None
    for depth in (1, 16, 128, 300, 512):
        upper, lower = block.bounds(depth, np.maximum(q.T, 0), np.minimum(q.T, 0))
        assert (lower <= exact).all() and (exact <= upper).all()
        assert before is None or ((upper <= before[0]).all() and (lower >= before[1]).all())
        before = upper, lower
    assert (upper == exact).all()
    # a bound carried over from the first block ends most searches of the second before its lists do
    blocks = [rng.normal(0, 100, (4096, 6)).astype(np.int64) for _ in range(2)]
    batch, trace = rng.normal(0, 100, (32, 6)).astype(np.int64), []
    assert run_blocks(blocks, batch, 10, trace) == plain(blocks, batch, 10)
    assert sum(c for depth, n, c in trace if depth < n) > 32


# ---- clusters

def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, tuple(math.floor(64 * float(np.float32(x))) for x in v)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in named][:k] + sorted(v for i, v in kept if i is None)[:max(0, k - len(named))]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else c
                     for j, c in enumerate(centroids)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    of = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return sorted(((i, c, d, sum(x[2] for x in found if x[1] == c), sum(x[2] for x in found), of(c))
                   for i, c, d in found), key=str)


def odd_clusters():
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(i % 5, 0.5, 64).astype(np.float32).tolist()) for i in range(60)]
    rows += [(3, rows[3][1]), (4, rows[9][1]), (None, rows[5][1]), (70, None), (71, [1.0] * 63), (72, [1.0] * 65),
             (73, [None] + [1.0] * 63), (74, [NAN] + [1.0] * 63), (75, [INF] + [1.0] * 63), (76, []),
             (77, [-1000.0] * 64), (78, [0.0] * 64), (79, [-0.001] * 64)]
    return rows


def test_clusters_odd_rows(spark):
    rows = odd_clusters()
    want = brute_clusters(rows)
    df = table(spark, rows, ("cluster", "distance", "id", "v", "planes", "norm")).repartition(4)
    got = bitplanes.cluster_report(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == want == in_duckdb(bitplanes.sql(), rows)
    assert bitplanes.cluster_report(table(spark, [])).isEmpty()
    few = rows[:3] + rows[:1]                                                  # fewer vectors than centroids
    assert sorted(map(tuple, bitplanes.cluster_report(table(spark, few)).collect()), key=str) == brute_clusters(few)


def test_beyond_the_limit_is_set_to_it(spark):
    rows = [(0, [1e30] * 64), (1, [-1e30] * 64), (2, [0.0] * 64)]
    got = {r["vec_id"]: r["distance"] for r in bitplanes.cluster_report(table(spark, rows)).collect()}
    assert got == {0: 0, 1: 0, 2: 0}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32 - 1), st.sampled_from([1, 5, 700, (1 << 26) - 1]))
def test_popcounts_equal_products(seed, most):
    rng = np.random.default_rng(seed)
    v, c = rng.integers(-most, most + 1, (9, 64)), rng.integers(-most, most + 1, (3, 64))
    planes = 1 + int(max(np.abs(v).max(), np.abs(c).max())).bit_length()
    pv, pc = bitplanes.pack_planes(v, planes), bitplanes.pack_planes(c, planes)
    assert (bitplanes.dots(pv, pc) == v @ c.T).all() and (bitplanes.norms(pv) == (v * v).sum(1)).all()
    cluster = rng.integers(0, 3, 9)
    assert (bitplanes.cluster_sums(pv, cluster, 4) == np.stack([v[cluster == j].sum(0) for j in range(4)])).all()
