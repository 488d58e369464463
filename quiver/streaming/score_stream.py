"""Incremental scoring of arriving parquet files with ``foreachBatch``."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession


def stream_score(spark: SparkSession, source_dir: str, schema, score: Callable[[DataFrame], DataFrame],
                 sink_path: str, checkpoint_path: str, glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> None:
    """Score every new file under ``source_dir`` once and write the results
    to ``sink_path`` (parquet, one folder ``batch=<id>`` per micro-batch, so that a
    batch that is run again replaces its own rows). Each micro-batch is an ordinary DataFrame, so
    ``score`` may join, aggregate and shuffle; the checkpoint in shared
    storage makes restarts resume where they stopped. Runs until the files
    present now are processed (``availableNow``)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch={batch_id}")

    q = (src.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())
    q.awaitTermination()
