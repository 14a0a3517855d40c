"""Stream sources. Deployments read Kafka; tests read a growing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import RAW_EVENT


def file_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """NDJSON lines of a folder as text, ``max_files`` files per micro-batch."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def file_events(spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None) -> DataFrame:
    """Events of a folder of NDJSON or Parquet files."""
    reader = spark.readStream.schema(RAW_EVENT).format(fmt).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def kafka_records(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """Records of a topic in the form the decoder takes. New consumers begin
    at the latest offset. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.base64("value").alias("data"),
        F.concat_ws("-", F.col("partition").cast("string"), F.col("offset").cast("string")).alias("sequence"),
        (F.unix_millis("timestamp") / 1000.0).alias("arrival"),
    )
