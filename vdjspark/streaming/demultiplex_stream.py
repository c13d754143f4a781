"""Demultiplexing reads as they arrive, and running clone counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjspark.operators.demultiplex import Adapter, demultiplex

SCHEMA = "id string, seq string, qual_text string, at timestamp"


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """Reads (id, seq, qual_text, at) from Parquet files that are dropped into a folder."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def demultiplex_stream(reads: DataFrame, adapters: list[Adapter], most: int = 2) -> DataFrame:
    """Each read is assigned on its own, so the stream keeps no state."""
    return demultiplex(reads, adapters, most)


def counts_by_window(reads: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Reads of each sequence and window of arrival; state of windows older than the watermark is dropped."""
    return reads.withWatermark("at", late).groupBy(F.window("at", window).alias("window"), "seq").agg(F.count("*").alias("count"))


def write_samples(stream: DataFrame, path: str, checkpoint: str):
    """Start a query that appends each sample's reads to its own folder, exactly once."""
    return stream.writeStream.format("parquet").partitionBy("sample").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
