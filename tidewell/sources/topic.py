"""The event topic: a Kafka stream in production, any stream with the same columns elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPIC_SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp, value binary"


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """One topic from its newest offsets on; lost offsets are skipped, not fatal."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .load()
    )


def file_source(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files with the topic's columns, read as a stream."""
    return (
        spark.readStream.schema(TOPIC_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )
