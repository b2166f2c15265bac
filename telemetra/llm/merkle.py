"""Merkle dataset manifest over nested-interval labels, with DataFrame functions only.

1. **Leaves**: the digest H (lowercase hex SHA-256) of a row's fields, each ``-`` where null,
   else its UTF-8 byte count, ``:`` and its value.
2. **Ranks** without a global window: rows are range-partitioned and sorted by (source, id,
   leaf) and written with their position; the few (partition, source) counts give offsets by
   a prefix sum, so a source that holds a third of all rows is ranked by many tasks.
3. **Nested-interval labels**: a node carries the interval ``lo..hi`` of leaf ranks that it
   covers. A level's nodes are grouped by ``lo`` div 16^level: groups of at most 16.
   Subroots, ordered by source, form one more tree of the same kind.
4. **Ancestors** come by containment joins bucketed by level: a node joins the parent whose
   interval holds its own, within the bucket ``lo`` div 16^level. **Siblings** are the
   children of that parent whose intervals lie before or after the node's own (interval
   difference). Rows of the join are runs of 16 leaves, not leaves: leaves of a run share all
   ancestors. A run carries (left, right) sibling digests per level, at most 15 digests each.

Null fields hash as ``-``. Null ids come first in their source, a null source before all
others; rows that are repeated are leaves of their own, and equal rows have equal digests, so
their order doesn't matter. Texts of any length are hashed whole. A source of one row has its
leaf as subroot; one source has its subroot as root. Further columns are ignored. An empty
table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm.common import ascii_lower, broadcast_if_small, cut

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 5
#: bits that ``monotonically_increasing_id`` leaves for a partition's own count
POSITION_BITS = 33


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column) -> Column:
    """H over the fields: ``-`` for null, else byte count, ``:`` and the value as text."""
    told = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in told])


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``lo`` (rank from 0 within ``tree``, by ``order``) and ``n`` (rows of the tree)."""
    by = ["tree", *[F.col(c).asc_nulls_first() for c in order], "_row"]
    written = cut(rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by)
                  .sortWithinPartitions(*by).drop("_row").withColumn("_pos", F.monotonically_increasing_id())
                  .withColumn("_part", F.shiftright("_pos", POSITION_BITS)), name)
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = written.groupBy("_part", "tree").agg(F.min("_pos").alias("_first"), F.count("*").alias("_n")).select(
        "_part", "tree", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("n"))
    return written.join(broadcast_if_small(cut(blocks, f"{name}-blocks")), ["_part", "tree"]) \
        .withColumn("lo", F.col("_pos") + F.col("_shift")).drop("_part", "_pos", "_shift")


def bucket(lo: str, level: int) -> Column:
    return F.floor(F.col(lo) / F.lit(FAN_OUT ** level)).cast("long")


def grouped(nodes: DataFrame, level: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """The nodes of ``level`` over those of the level below: (tree, n, lo, hi, digest, children).

    The one leaf of a tree of one row stays its own digest.
    """
    kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest", *extra)))
    over = nodes.groupBy("tree", "n", bucket("lo", level).alias("_bucket")).agg(kids.alias("children"))
    joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
    return over.select("tree", "n", F.col("children")[0]["lo"].alias("lo"),
                       F.element_at("children", -1)["hi"].alias("hi"),
                       F.when(F.col("n") == 1, F.col("children")[0]["digest"]).otherwise(F.sha2(joined, 256)).alias("digest"),
                       "children")


def tree_levels(leaves: DataFrame, extra: tuple[str, ...], name: str) -> list[DataFrame]:
    """Node tables of levels 1, 2, ... until every tree has its one topmost node."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels = [cut(grouped(leaves.withColumn("hi", F.col("lo")), 1, extra), f"{name}-1")]
    width = FAN_OUT
    while width < most:
        below = levels[-1].filter(F.col("n") > width).select("tree", "n", "lo", "hi", "digest")
        levels.append(cut(grouped(below, len(levels) + 1), f"{name}-{len(levels) + 1}"))
        width *= FAN_OUT
    return levels


def siblings(children: str, lo: Column, hi: Column) -> Column:
    """(left, right): digests of the children whose intervals lie before and after ``lo..hi``."""
    def told(outside) -> Column:
        return F.array_join(F.transform(F.filter(children, outside), lambda c: c["digest"]), "")
    return F.struct(told(lambda c: c["hi"] < lo).alias("left"), told(lambda c: c["lo"] > hi).alias("right"))


def tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's topmost node."""
    out = None
    for level in levels:
        top = level.filter((F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)).select("tree", "digest")
        out = top if out is None else out.unionByName(top)
    return out


def with_paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Level 1's nodes with ``path``, the (left, right) of every level from their own upwards.

    ``above`` (tree, path, ...) is the path that goes on from each tree's topmost node.
    """
    further = [c for c in above.columns if c != "tree"]
    held = None
    for level in range(len(levels), 0, -1):
        nodes = levels[level - 1]
        top = nodes.filter((F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)).join(above, "tree")
        if held is None:
            held = top
            continue
        parent = held.select("tree", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                             bucket("lo", level + 1).alias("_bucket"), F.col("children").alias("_kids"), *further)
        inner = nodes.filter(~((F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1))) \
            .withColumn("_bucket", bucket("lo", level + 1)).join(parent, ["tree", "_bucket"]) \
            .filter((F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))) \
            .withColumn("path", F.concat(F.array(siblings("_kids", F.col("lo"), F.col("hi"))), "path"))
        held = top.unionByName(inner.select(*top.columns))
    return held


def own_path(children: str = "children") -> Column:
    """The path of the exploded leaf ``c``: its siblings in the run, then the run's path."""
    inner = F.array(siblings(children, F.col("c.lo"), F.col("c.hi")))
    return F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(inner, "path"))


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to with these siblings."""
    return F.aggregate(path, start, lambda d, s: digest(s["left"], d, s["right"]))


def proof_digest(path: Column) -> Column:
    """H over all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(leaves: DataFrame, id_col: str = "doc_id", name: str = "merkle") -> DataFrame:
    """(id, leaf, subroot, root, path, shown) for leaves (id, tree, digest, shown).

    ``tree`` is a non-null text that orders the trees; ``shown`` is any further column that
    stays with its leaf; ``path`` holds the (left, right) sibling digests of every level.
    """
    own = leaves.select(F.col(id_col).alias("_id"), "tree", "digest", F.col("shown").alias("_shown"))
    levels = tree_levels(ranked(own, ["_id", "digest"], name), ("_id", "_shown"), name)
    subroots = cut(tops(levels), f"{name}-subroots")
    upper = tree_levels(ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_of"), "digest"),
                               ["_of"], f"{name}-top"), ("_of",), f"{name}-top")
    none = F.array().cast("array<struct<left:string,right:string>>")
    above = with_paths(upper, tops(upper).select("tree", F.col("digest").alias("root"), none.alias("path"))) \
        .withColumn("c", F.explode("children")) \
        .select(F.col("c._of").alias("tree"), F.col("c.digest").alias("subroot"), "root", own_path().alias("path"))
    return with_paths(levels, cut(above, f"{name}-above")).withColumn("c", F.explode("children")).select(
        F.col("c._id").alias(id_col), F.col("c.digest").alias("leaf"), "subroot", "root",
        own_path().alias("path"), F.col("c._shown").alias("shown"))


def manifest_report(docs: DataFrame) -> DataFrame:
    """The manifest of a documents table, and what a tampered copy of it verifies as."""
    fields = [F.col(c) for c in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPER_MODULUS == 0, F.lit(False))
    changed = leaf_digest(*fields[:-1], ascii_lower(F.col("text")))
    leaves = docs.select("doc_id", F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")).alias("tree"),
                         leaf_digest(*fields).alias("digest"), F.when(hit, changed).alias("shown"))
    return manifest(leaves).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("shown", "leaf"), F.col("path")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    coalesce(xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % {TAMPER_MODULUS} = 0, false) AS hit
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN hit THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS shown FROM d),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS ix,
         count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (
  SELECT 0 AS level, tree, ix, n, leaf AS h FROM placed
  UNION ALL
  SELECT level + 1, tree, ix // {FAN_OUT}, (n + {FAN_OUT - 1}) // {FAN_OUT}, sha256(string_agg(h, '' ORDER BY ix))
  FROM nodes WHERE n > 1 GROUP BY level, tree, ix // {FAN_OUT}, n),
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS ix, count(*) OVER () AS n
             FROM nodes WHERE n = 1),
over AS (
  SELECT 0 AS level, ix, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, ix // {FAN_OUT}, (n + {FAN_OUT - 1}) // {FAN_OUT}, sha256(string_agg(h, '' ORDER BY ix))
  FROM over WHERE n > 1 GROUP BY level, ix // {FAN_OUT}, n),
steps AS (
  SELECT level, tree, ix, n, h FROM nodes WHERE n > 1
  UNION ALL SELECT 100 + level, NULL, ix, n, h FROM over WHERE n > 1),
leaf_rows AS (SELECT row_number() OVER () AS rid, p.*, s.subroot, s.ix AS sat, s.n AS sn,
                (SELECT h FROM over WHERE n = 1) AS root
         FROM placed p JOIN subroots s USING (tree)),
path AS (
  SELECT rid, 0 AS level, tree, ix, n, sat, sn, coalesce(shown, leaf) AS h, '' AS said FROM leaf_rows
  UNION ALL
  SELECT p.rid, CASE WHEN p.n > 1 THEN p.level + 1 WHEN p.level < 100 THEN 100 ELSE p.level + 1 END,
         CASE WHEN p.n > 1 THEN p.tree END,
         CASE WHEN p.n > 1 THEN p.ix // {FAN_OUT} ELSE p.sat END,
         CASE WHEN p.n > 1 THEN (p.n + {FAN_OUT - 1}) // {FAN_OUT} ELSE p.sn END,
         CASE WHEN p.n > 1 THEN p.sat END, CASE WHEN p.n > 1 THEN p.sn END,
         CASE WHEN p.n > 1 THEN sha256(string_agg(CASE WHEN s.ix = p.ix THEN p.h ELSE s.h END, '' ORDER BY s.ix)) ELSE p.h END,
         CASE WHEN p.n > 1 THEN p.said || coalesce(string_agg(s.h, '' ORDER BY s.ix) FILTER (WHERE s.ix <> p.ix), '') ELSE p.said END
  FROM path p LEFT JOIN steps s ON p.n > 1 AND s.level = p.level AND s.tree IS NOT DISTINCT FROM p.tree
                               AND s.ix // {FAN_OUT} = p.ix // {FAN_OUT}
  WHERE p.n > 1 OR p.level < 100
  GROUP BY p.rid, p.level, p.tree, p.ix, p.n, p.sat, p.sn, p.h, p.said)
SELECT doc_id, leaf, subroot, root, sha256(said) AS proof_sha256, h AS folded_root, h = root AS verified
FROM leaf_rows JOIN (SELECT rid, h, said FROM path WHERE n = 1 AND level >= 100) USING (rid)
"""
