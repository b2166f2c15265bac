"""Merkle manifest: a plain Python tree, DuckDB SQL, sources of every size, odd rows."""
import hashlib
import zlib

import duckdb
from corpus_helpers import DOC, ODD_TEXTS, documents, empty
from pyspark.sql import functions as F

from telemetra.llm import merkle, queries

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, low=False):
    text = row["text"]
    if low and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])


def tree(digests):
    """(root, for every digest its list of (left, right) per level)."""
    groups = [[i] for i in range(len(digests))]
    paths, level = [[] for _ in digests], list(digests)
    while len(level) > 1:
        above, runs = [], []
        for s in range(0, len(level), 16):
            run = level[s:s + 16]
            for j in range(len(run)):
                for i in groups[s + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(h(*run))
            runs.append(sum(groups[s:s + 16], []))
        level, groups = above, runs
    return level[0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    sub = {}
    for s in order:
        held = sorted(by_source[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        sub[s] = (held, *tree([leaf(r) for r in held]))
    root, above = tree([sub[s][1] for s in order])
    out = []
    for k, s in enumerate(order):
        held, subroot, paths = sub[s]
        for r, path in zip(held, paths):
            path = path + above[k]
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            d = leaf(r, hit)
            for left, right in path:
                d = h(left, d, right)
            out.append((r["doc_id"], leaf(r), subroot, root, h(*[a + b for a, b in path]), d, d == root))
    return sorted(out, key=str)


def in_duckdb(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [tuple(r) for r in rows])
    return sorted(con.execute(merkle.SQL).fetchall(), key=str)


def test_query_equals_brute_force_and_sql(spark):
    got = queries.op13_merkle_manifest(spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = sorted(map(tuple, got.collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert found == brute(rows) == sorted(con.execute(merkle.SQL).fetchall(), key=str)
    assert {r[-1] for r in found} == {True, False}


def test_sources_of_many_sizes(spark):
    """Trees of one to four levels, runs of one, and more sources than one run holds."""
    sizes = [1, 2, 15, 16, 17, 255, 256, 257, 300] + [1] * 12
    rows, i = [], 0
    for k, n in enumerate(sizes):
        for _ in range(n):
            rows.append((i * 7919 % 100_003, f"Text {i}", "en", None if k == 3 else f"s{k}" if k % 2 else f"é{k}", i))
            i += 1
    df = spark.createDataFrame(rows, DOC).repartition(6)
    assert sorted(map(tuple, merkle.manifest_report(df).collect()), key=str) == brute(df.collect()) == in_duckdb(rows)


def test_odd_rows(spark):
    clash = ("tree", "lo", "hi", "n", "digest", "leaf", "root", "path", "children")
    df = documents(spark, ODD_TEXTS, clash=clash)
    want = brute(df.collect())
    assert sorted(map(tuple, merkle.manifest_report(df).collect()), key=str) == want
    assert in_duckdb(df.select("doc_id", "text", "lang", "source", "n_chars").collect()) == want
    assert merkle.manifest_report(empty(spark)).isEmpty()
    one = documents(spark, ["A"]).limit(1)
    assert [tuple(r) for r in merkle.manifest_report(one).collect()] == brute(one.collect())


def test_any_change_is_found(spark):
    """A leaf that differs never folds to the root; its own one always does."""
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    leaves = df.select("doc_id", F.coalesce("source", F.lit("0")).alias("tree"),
                       merkle.leaf_digest(*[F.col(c) for c in merkle.FIELDS]).alias("digest"), F.lit(None).cast("string").alias("shown"))
    found = merkle.manifest(leaves).select(
        (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("own"),
        (merkle.fold(F.sha2(F.col("leaf"), 256), F.col("path")) == F.col("root")).alias("other")).distinct().collect()
    assert [tuple(r) for r in found] == [(True, False)]
