"""Intermediate tables in the folder that the cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ranklens.session import checkpoint_dir, shuffles_end


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    with shuffles_end(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Tables of ``written`` that nothing reads any more give their disk back."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
