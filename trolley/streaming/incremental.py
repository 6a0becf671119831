"""Incremental line loading as a micro-batch stream.

The study's load is a daily batch that inserts only rows whose natural key
is absent.  Here each micro-batch of newly arrived files goes through the same
insert-if-absent step (``quality.append_to_table``), so replays after a
failure insert nothing twice.  Stream progress is kept under the shared
checkpoint folder named by the session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from trolley.operators.quality import append_to_table
from trolley.session import checkpoint_dir


def start_incremental_load(spark: SparkSession, source_dir: str, schema: StructType, target_path: str,
                           key: list, name: str = "incremental_lines", available_now: bool = True):
    """Start the stream; returns the StreamingQuery (``awaitTermination`` it
    for a one-shot catch-up run with ``available_now``)."""
    progress = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    src = spark.readStream.schema(schema).parquet(source_dir)

    def load_batch(batch_df, epoch_id):
        append_to_table(batch_df.sparkSession, target_path, batch_df, key)

    writer = src.writeStream.foreachBatch(load_batch).option("checkpointLocation", progress).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
