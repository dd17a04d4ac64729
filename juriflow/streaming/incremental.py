"""New documents as a stream: each micro-batch of whole documents goes through a plan once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_documents(spark: SparkSession, path: str, schema, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 100, available_now: bool = True) -> StreamingQuery:
    """Parquet files that arrive in ``path`` (whole documents each) through ``plan``, appended to ``out``.

    A batch is written into a folder of its own, so that a batch that is run
    again after a failure replaces what it wrote.
    """
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    w = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
