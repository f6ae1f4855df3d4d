"""Structured Streaming forms of intake and outbox delivery."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import intake


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files as they appear under a folder: path, content."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(folder).select("path", "content")


def register(files: DataFrame, table: str, run_id: str, checkpoint: str):
    """Each micro-batch is normalised and appended but for sources already registered."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = intake.ingest(batch, run_id, "").dropDuplicates(["source_id"])
        try:
            seen = spark.read.parquet(table).select("source_id")
        except Exception as e:  # the table does not exist before the first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        else:
            rows = rows.join(seen, "source_id", "left_anti")
        rows.write.mode("append").parquet(table)

    return files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


def deliver_once(events: DataFrame, at: str = "created_at", delay: str = "1 day") -> DataFrame:
    """An at-least-once outbox read once: repeated idempotency keys within the delay are dropped."""
    return events.withColumn(at, F.to_timestamp(at)).withWatermark(at, delay).dropDuplicatesWithinWatermark(["idempotency_key"])


def to_sink(events: DataFrame, send: Callable[[DataFrame], None], checkpoint: str):
    """Hand each micro-batch, keys once, to an idempotent sink."""
    return events.writeStream.foreachBatch(lambda batch, _: send(batch.dropDuplicates(["idempotency_key"]))).option("checkpointLocation", checkpoint)
