"""Session helpers.

The library never builds its own cluster configuration: it reads what the
session has.  ``get_spark`` is for tests, benchmarks and local use only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the library is tuned for (tests, bench)."""
    master = master or os.environ.get("RANKLENS_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("RANKLENS_SHUFFLE_PARTITIONS", "8"))
    b = (
        SparkSession.builder.master(master)
        .appName("ranklens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RANKLENS_DRIVER_MEMORY", "16g"))
        # a join on (qid, docno) may reuse a partitioning on qid alone
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured there.  Only
    when the session has none (local tests) a fresh folder is created and set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        d = tempfile.mkdtemp(prefix="ranklens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is planned and run inside gives its shuffle files back when it ends, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df, name: str):
    """The rows written once as Parquet under the shared checkpoint folder and read back: lineage ends here, nothing runs twice."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_end(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
