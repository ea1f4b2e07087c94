"""Stream readers. Every one gives a DataFrame that the batch operators accept."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_source(
    spark: SparkSession, fmt: str, schema: T.StructType | str | None = None, **options: object
) -> DataFrame:
    """A stream from any built-in or installed format, by name and options."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**{k: str(v) for k, v in options.items()}).load()


def kafka_options(properties: Mapping[str, str], topic_key: str = "topic", group_key: str = "group") -> dict[str, str]:
    """Reader options from job properties: ``bootstrap``, a topic list, a consumer group and optional partitions.

    One reader covers all partitions of the topics, so no receivers need to be unioned by hand.
    """
    options = {"kafka.bootstrap.servers": properties["bootstrap"], "subscribe": properties[topic_key]}
    if group_key in properties:
        options["groupIdPrefix"] = properties[group_key]
    if "partitions" in properties:
        options["minPartitions"] = properties["partitions"]
    return options


def source_kafka(spark: SparkSession, properties: Mapping[str, str], **keys: str) -> DataFrame:
    """Message values as text column ``line``; needs the Kafka connector on the class path."""
    return message_lines(stream_source(spark, "kafka", **kafka_options(properties, **keys)))


# The columns every Kafka reader gives.
KAFKA_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT"
)


def message_lines(messages: DataFrame) -> DataFrame:
    """Message values as text, with the time of the message."""
    return messages.select(F.col("value").cast("string").alias("line"), F.col("timestamp").alias("ts"))


def source_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket. Not replayable, so for trials only."""
    return stream_source(spark, "socket", host=host, port=port).withColumnRenamed("value", "line")


def source_text_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files in a folder, oldest first, as column ``line``."""
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": files_per_batch}
    return stream_source(spark, "text", path=path, **options).withColumnRenamed("value", "line")


def source_parquet_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": files_per_batch}
    return stream_source(spark, "parquet", schema, path=path, **options)
