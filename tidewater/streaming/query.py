"""File streams of the two event feeds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import CONTRACTS

STREAMS = ("customer_events", "inventory_events")


@dataclass(frozen=True)
class StreamConfig:
    dataset: str
    source: str
    checkpoint: str
    lateness_hours: int = 24
    max_files: int = 1
    processing_seconds: int | None = None  # None: all that is there, then stop

    def __post_init__(self) -> None:
        if self.dataset not in STREAMS:
            raise ValueError(f"no stream {self.dataset}")
        if self.lateness_hours < 0 or self.max_files < 1 or (self.processing_seconds is not None and self.processing_seconds < 1):
            raise ValueError("lateness must not be negative; files and seconds must be at least 1")


def start(spark: SparkSession, config: StreamConfig, process: Callable[[DataFrame, int], object]):
    """Starts the query; ``process`` gets each micro-batch as strings with file metadata."""
    contract = CONTRACTS[config.dataset]
    text = ", ".join(f"`{n}` string" for n, _ in contract.columns)
    rows = spark.readStream.schema(text).option("maxFilesPerTrigger", config.max_files).json(config.source)
    rows = rows.withColumns({"_source_file_path": F.col("_metadata.file_path"), "_source_file_name": F.col("_metadata.file_name"), "_ingested_at": F.col("_metadata.file_modification_time")})
    # The watermark bounds what Spark itself may keep; lateness is judged by the processor, row by row.
    event_time = F.col(contract.event_time).try_cast("timestamp").alias("_event_time")
    rows = rows.select("*", event_time).withWatermark("_event_time", f"{config.lateness_hours} hours")
    writer = rows.writeStream.foreachBatch(lambda df, n: process(df, n) and None).option("checkpointLocation", config.checkpoint)
    return (writer.trigger(processingTime=f"{config.processing_seconds} seconds") if config.processing_seconds else writer.trigger(availableNow=True)).start()
