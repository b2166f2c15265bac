"""SimHash near-duplicates by meet-in-the-middle ball hashing.

1. **Fingerprint** (map side, no shuffle): ASCII-lower-cased words, word shingles, XXH64
   per shingle, one 64-bit majority fingerprint per text.
2. **Ball hashing** over *distinct* fingerprints: for a maximum distance r every
   fingerprint emits all variants within r/2 flipped bits (r = 2: itself and 64
   neighbours). Two fingerprints within r bits have a variant in common, and variants
   are shuffled as 8-byte keys. All fingerprints that share a variant are, by the
   triangle inequality, within r of one another when r is even, so linking each to the
   smallest of its variant loses no link between components; a variant group holds at
   most a ball of fingerprints, however many documents share one of them. Links are
   deduplicated and verified by their differing bits.
3. **Components**: alternating large-star / small-star rounds over the links, each round
   written below ``spark.checkpoint.dir``; only a count comes back to the driver.
4. Documents take the smallest doc_id of their fingerprint's component by a join on the
   fingerprint; copies are never paired with each other.

Texts without words (null, empty, blank) have fingerprint zero and are linked like any
other. Repeated rows keep one output row each. A null doc_id never names a component
unless no other id is there. An empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm.common import broadcast_if_small, cut, packed, release

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42


def majority_bits(hashes: np.ndarray) -> int:
    """64-bit fingerprint of uint64 hashes: bit set where over half of them have it."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = hashes[i:i + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_text(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of one text (bytes.split cuts at exactly x20, x09-x0D)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= k:
        shingles = [digest(join(words), SEED)]
    else:
        shingles = [digest(join(t), SEED) for t in zip(*(words[i:] for i in range(k)))]
    return majority_bits(np.array(shingles, dtype="<u8"))


def fingerprints(docs: DataFrame, text: str = "text", k: int = SHINGLE_WORDS) -> Column:
    """Column expression: signed 64-bit fingerprint of a text column."""
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([fingerprint_text(t, k) for t in s], dtype=np.uint64).view(np.int64))
            release()
    return fp(docs[text])


def variants(radius: int) -> list[int]:
    """XOR masks (signed) of all bit flips of at most ``radius`` bits."""
    masks = [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def ball_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) with a < b: links between distinct fingerprints (column ``fp``) of one ball.

    The links connect exactly what all pairs within ``max_bits`` (even) connect.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even: variants of half the radius meet in the middle")
    emitted = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in variants(max_bits // 2)])).alias("m")) \
        .select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("variant"))
    least = F.min("fp").over(Window.partitionBy("variant"))
    return (emitted.select(least.alias("a"), F.col("fp").alias("b"))
            .filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
            .distinct())


def connected(links: DataFrame, name: str = "component") -> DataFrame:
    """(node, root): smallest node reachable for every node of undirected ``links`` (a, b).

    Large-star then small-star until every node has one parent that has none itself. A
    node's neighbours meet only as a map-side combined minimum, joined back to the links,
    so a hub with very many neighbours never sits in one task.
    """
    def with_least(edges: DataFrame) -> DataFrame:
        return edges.join(edges.groupBy("a").agg(F.min("b").alias("m")), "a")

    edges = cut(links.select("a", "b"), f"{name}-links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = cut(with_least(both).filter("b > a")
                    .select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct(), f"{name}-large")
        small = with_least(large)
        edges = cut(small.select("a", F.col("m").alias("b"))
                    .unionByName(small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                    .distinct(), f"{name}-small")
        unsettled = (edges.groupBy("a").count().filter("count > 1").select("a")
                     .unionByName(edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "left_semi")))
        if unsettled.isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _marked(docs: DataFrame, id_col: str, text: str, k: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    marked = cut(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                             fingerprints(docs, text, k).alias("fp")), "simhash")
    distinct = marked.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = connected(ball_links(distinct.select("fp"), max_bits), "simhash")
    named = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    component = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked, named.join(component, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, ``fp`` (signed fingerprint), ``component_id``."""
    marked, by_fp = _marked(docs, id_col, text, k, max_bits)
    return marked.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (nulls last), then text hash."""
    marked, by_fp = _marked(docs, id_col, text, k, max_bits)
    rank = F.struct(F.col("id").isNull(), "id", "text_hash")
    first = marked.join(by_fp.select("fp", "root"), "fp").groupBy("root").agg(F.min(rank).alias("r")).select("r.id", "r.text_hash")
    times = marked.groupBy("id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("id").alias("i"), F.col("text_hash").alias("h"))
    chosen = cut(first.join(broadcast_if_small(times), F.expr("id <=> i AND text_hash = h"), "left")
                 .select("id", "text_hash", F.col("h").isNotNull().alias("repeated")), "simhash-kept")
    rows = docs.select(packed(docs), docs[id_col].alias("i"), F.xxhash64(text).alias("h"))

    def of(repeated: bool) -> DataFrame:
        keys = chosen.filter(F.col("repeated") == repeated).select("id", "text_hash")
        return rows.join(keys, F.expr("i <=> id AND h = text_hash"), "left_semi")
    # rows that occur more than once are few; only they are reduced to one
    return of(False).unionByName(of(True).dropDuplicates(["i", "h"])).select("row.*")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
