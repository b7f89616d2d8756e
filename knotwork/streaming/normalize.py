"""Normalization of a stream of records: stateless, so it needs no watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import normalize_records
from ..sources.io import RECORD


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Tab-separated record files as they arrive in a folder."""
    reader = spark.readStream.schema(RECORD).option("sep", "\t").option("header", True).option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)


def normalize_stream(spark: SparkSession, source: str, target: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Writes normalized records of ``source`` to ``target`` as Parquet, each file once."""
    out = normalize_records(read_stream(spark, source)).withColumn("address_numbers", F.array_join("address_numbers", " "))
    writer = out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
