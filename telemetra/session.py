"""Session helpers: a local session for tests/bench and lineage cutting."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# HotSpot never compiles a method above this many bytes: it would run interpreted, several times slower
JIT_LIMIT = "8000"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """Session for tests and the local bench. On a cluster use the provided session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("telemetra")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # constraint inference grows with the size of CASE chains pushed through
        # projections (fault limits, validation reasons) and can stall the optimizer
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.sql.codegen.hugeMethodLimit", JIT_LIMIT)
        .config("spark.driver.memory", driver_memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only a local session may go without: it gets a temporary folder. On a cluster an unset
    folder is an error, since no machine's own folder is seen by the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="telemetra-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def compile_wide_rows(spark: SparkSession) -> None:
    """Let Spark split generated code that HotSpot would not compile, also in a session that we did not make.

    Decoding is one wide projection; as one method it is beyond ``JIT_LIMIT``. Results are the same.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_LIMIT)


def materialize(df: DataFrame, enabled: bool = True, name: str = "table") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the session's checkpoint directory.

    Used where a derived table is scanned more than once (e.g. the watermark
    thresholds and the classification join both read the decoded observations):
    an executor loss then re-reads the written table instead of re-decoding raw
    payloads, and later scans get column pruning and filter pushdown. The
    directory is ``spark.checkpoint.dir`` (a shared folder on a cluster). The table
    must live as long as the result is read; ``remove_cuts`` deletes a session's.
    """
    if not enabled:
        return df
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint directory for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it is."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in whatever store they are."""
    fs, p = _file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def remove_cuts(spark: SparkSession) -> None:
    """Delete the intermediate tables of this session once their results have been read."""
    delete_path(spark, ensure_checkpoint_dir(spark))
