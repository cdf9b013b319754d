"""Documents that arrive as files, each handled once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_documents(spark: SparkSession, path: str, schema: StructType, handle: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, files_per_trigger: int = 100) -> None:
    """Run a batch operator over the files that have come since the last run; the checkpoint takes the place
    of a status poll. A batch that is run again overwrites its own output."""
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)

    def write(batch: DataFrame, number: int) -> None:
        handle(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    arrived.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
