"""Sinks (X06, X08): partitioned parquet and key-value records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quiver.session import shared_path


def write_partitioned(df: DataFrame, path: str, partition_col: str | None = "split",
                      mode: str = "overwrite") -> str:
    """Parquet sink, one folder per value of ``partition_col``."""
    w = df.write.mode(mode)
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)
    return path


def write_and_reload(spark: SparkSession, df: DataFrame, name: str,
                     partition_col: str | None = None) -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage through storage every executor can see, so a lost executor
    only recomputes from the written files.
    """
    path = shared_path(spark, name)
    write_partitioned(df, path, partition_col)
    return spark.read.parquet(path)
