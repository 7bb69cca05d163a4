"""Session settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the job settings; ``master`` is left to spark-submit when not given.

    Shuffle width, executor count and memory belong to the cluster: AQE sizes
    the reduce side from what the map side wrote, so no width is fixed here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Settle the zone (event hashes contain event times as text) and, on one machine, the listing.

    Listing directories by a Spark job pays on a cluster's object store; a local disk is faster listed directly.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
