"""Small helpers shared by the corpus operators of this subpackage.

Every operator selects the columns it needs before anything else, so extra input
columns, whatever their names, neither travel through shuffles nor clash.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.session import materialize, scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: code points handled at once inside a Python task; bounds the numpy working set
CHARS_AT_ONCE = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: white space of the word contracts (space and x09-x0D)
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: later scans and
    retries after a lost executor start from the written table."""
    return materialize(df, True, name)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``cut`` for tables near the input's size, with their path, to be deleted once a later table has been
    written from them. Spark deletes the write's shuffle files when it ends: only the table is read again."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path), path


def remainder(doc_id: str | Column, m: int) -> Column:
    """crc32(doc_id as text) mod m (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % m


def is_remainder(doc_id: str | Column, m: int, r: int) -> Column:
    """True where the remainder is ``r``; a null id is never so."""
    return F.coalesce(remainder(doc_id, m) == r, F.lit(False))


def hash_share(col: Column, share: float) -> Column:
    """True for a fixed, hash-chosen share of the values of ``col``."""
    return F.pmod(F.xxhash64(col, F.lit("share")), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def packed(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One struct of a table's columns, so that helper columns beside it can't clash with them."""
    return F.struct(*[df[c].alias(c) for c in (columns or df.columns)]).alias("row")


def broadcast_if_small(df: DataFrame, rows: int = 300_000) -> DataFrame:
    """``df``, marked for broadcast where it is counted to have at most ``rows`` (narrow) rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ranges(sizes: list[int], limit: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose ``sizes`` add up to at most ``limit`` (one row at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n + 1
    if start < len(sizes):
        yield start, len(sizes)


def slices(texts: list[str], limit: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of at most ``limit`` characters together (one text at least)."""
    yield from ranges([len(t) for t in texts], limit)


def release() -> None:
    """Hand the Arrow memory of a batch that is done back, so that a worker that is used again stays small."""
    pa.default_memory_pool().release_unused()


def code_points(text: str) -> np.ndarray:
    """Code points of ``text`` (lone surrogates kept) as uint32."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
