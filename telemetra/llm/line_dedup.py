"""Line dedup by site-relative frequency, with DataFrame functions only.

A site's page total and the pages that contain a line are counted per host; a line on more
than ``MAX_RATIO`` of the host's pages (and on ``MIN_PAGES`` at least, so that a small site
keeps its text) is boilerplate there and is dropped from all its pages. Pages with equal
text count once: a page that was crawled many times doesn't turn its own lines into
boilerplate, exact copies are the business of the near-duplicate operators.

Plan: the lines of a page are reduced to 12-byte hashes before the first shuffle, and pages
are counted with map-side combining, so a host with a third of all pages is spread over
tasks by its lines. The boilerplate table (at most 1 / MAX_RATIO times the mean lines a
page for each host) is written below ``spark.checkpoint.dir``. Up to ``BROADCAST_LINES``
rows (its size is counted first) it is broadcast and the texts are not shuffled; beyond,
the pages are joined by (host, salt) with ``SALTS`` salts. Both ways give the same rows.

Lines are compared without outer blanks; blank lines are kept and never counted. Null text
stays null with no lines; null and empty hosts form one host. Repeated rows are one page
but keep one output row each. An empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import cut, packed

MAX_RATIO = 0.02
MIN_PAGES = 5
BROADCAST_LINES = 100_000
SALTS = 64


def _key(line: Column) -> Column:
    """96 bits that stand for a trimmed line."""
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the boilerplate line keys of each host that has any."""
    page = pages.select(F.coalesce(F.col(host), F.lit("")).alias("host"), _key(F.col(text)).alias("page"),
                        F.col(text).alias("text"))
    totals = page.filter("text is not null").select("host", "page").distinct().groupBy("host").agg(
        F.count("*").alias("pages"))
    keys = F.array_distinct(F.transform(
        F.filter(F.transform(lines_of(F.col("text")), lambda x: F.trim(x)), lambda x: x != ""), _key))
    on = page.select("host", "page", F.explode(keys).alias("line")).distinct() \
        .groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    return on.join(totals, "host").filter(F.col("n") > F.col("pages") * max_ratio) \
        .groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with cleaned ``text`` and two further columns, ``n_lines`` and ``n_dropped``.

    Columns of those names in the input are replaced.
    """
    found = cut(boilerplate(pages, host, text, max_ratio, min_pages), "boilerplate")
    small = found.select(F.sum(F.size("lines"))).first()[0] or 0
    keep = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    rows = pages.select(packed(pages, keep), F.coalesce(F.col(host), F.lit("")).alias("host"))
    if small <= BROADCAST_LINES:
        joined = rows.join(F.broadcast(found), "host", "left")
    else:
        salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))) \
            .join(found.withColumn("salt", F.explode(salts)), ["host", "salt"], "left")
    lines = lines_of(F.col("row")[text])
    kept = F.when(F.col("lines").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.array_contains("lines", _key(F.trim(x)))))
    return joined.withColumn("kept", kept).select(
        *[F.array_join("kept", "\n").alias(c) if c == text else F.col("row")[c].alias(c) for c in keep],
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size(lines) - F.size("kept"), F.lit(0)).alias("n_dropped"))


#: the rows of op1_line_dedup
SQL = f"""
WITH pages AS (SELECT doc_id, coalesce(source, '') AS host, source, text FROM documents),
totals AS (SELECT host, count(DISTINCT text) AS pages FROM pages GROUP BY host),
lines AS (SELECT host, text, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')))) AS line
          FROM pages),
bad AS (SELECT l.host, list(l.line) AS lines
        FROM (SELECT host, line, count(DISTINCT text) AS n FROM lines WHERE line <> '' GROUP BY host, line) l
        JOIN totals t ON l.host = t.host WHERE n >= {MIN_PAGES} AND n > t.pages * {MAX_RATIO}::DOUBLE GROUP BY l.host),
cleaned AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines,
                   list_filter(string_split(text, chr(10)),
                               lambda x: NOT coalesce(list_contains(b.lines, trim(x, ' ')), false)) AS kept
            FROM pages p LEFT JOIN bad b ON p.host = b.host)
SELECT doc_id, source, array_to_string(kept, chr(10)) AS text, coalesce(len(lines), 0)::INTEGER AS n_lines,
       coalesce(len(lines) - len(kept), 0)::INTEGER AS n_dropped
FROM cleaned
"""
