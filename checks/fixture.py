"""Event records with every defect, derived from the given ``events`` table.

One record per event, a second identical one for every fifth, as the wire
carries them: JSON text, with missing times and prices, negative prices and
unknown event types. ``checks.oracle`` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

REPAIR_RULES = (
    ("invalid_event_type", "view", True, True),
    ("price_is_negative", "abs", True, True),
    ("event_time_is_null", "kafka_timestamp", True, True),
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given events; a table of few files is spread over the cores, a large one is read as it lies."""
    rows, cores = spark.read.parquet(f"{sf_dir}/events.parquet"), spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if len(rows.inputFiles()) < cores else rows


def _choice(key: Column, values: list[str]) -> Column:
    picked = F.when(key == 0, values[0])
    for place, value in enumerate(values[1:], start=1):
        picked = picked.when(key == place, value)
    return picked


def records(spark: SparkSession, sf_dir: str, extra: str | None = None) -> DataFrame:
    """event_id, copy_no, kafka_timestamp, raw_value; ``extra`` adds JSON text before the closing brace."""
    event_id, k = F.col("event_id"), F.col("k")
    keyed = events(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    fields = keyed.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
        F.concat(F.lit("u_"), F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") == "signup", "add_to_cart")
        .when(F.col("event_type") == "error", "INVALID_EVENT")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.concat(F.lit("p_"), event_id % 1000).alias("product_id"),
        _choice(k % 6, ["book", "toy", "3c", "fashion", "beauty"]).alias("category"),
        F.when(event_id % 53 == 0, None)
        .when(event_id % 15 == 0, F.lit(-100))
        .otherwise(F.floor("value"))
        .cast("bigint")
        .alias("price"),
        F.when(event_id % 17 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("event_time"),
        _choice(k % 4, ["ios", "android", "web"]).alias("device"),
    )

    def text(name: str) -> Column:
        return F.coalesce(F.concat(F.lit('"'), F.col(name), F.lit('"')), F.lit("null"))

    values = [
        ("user_id", text("user_id")),
        ("event_type", text("event_type")),
        ("product_id", text("product_id")),
        ("category", text("category")),
        ("price", F.coalesce(F.col("price").cast("string"), F.lit("null"))),
        ("event_time", text("event_time")),
        ("device", text("device")),
    ]
    parts: list[Column] = []
    for place, (name, value) in enumerate(values):
        parts += [F.lit(("," if place else "{") + f'"{name}":'), value]
    tail = F.when(event_id % 11 == 0, F.lit(extra)).otherwise(F.lit("")) if extra else F.lit("")
    copies = F.when(event_id % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    texts = fields.select("event_id", "kafka_timestamp", F.concat(*parts, tail, F.lit("}")).alias("raw_value"))
    return texts.select("event_id", F.explode(copies).alias("copy_no"), "kafka_timestamp", "raw_value")


def topic(spark: SparkSession, sf_dir: str, extra: str | None = None) -> DataFrame:
    """The records as a topic; event_id and copy_no kept for building variants."""
    return records(spark, sf_dir, extra).select(
        F.lit("test-topic").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("copy_no")).cast("bigint").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
        F.col("raw_value").cast("binary").alias("value"),
        "event_id",
        "copy_no",
    )


def two_snapshots(topic_rows: DataFrame) -> DataFrame:
    """Even events and those ending in 1 as snapshot 1, odd ones as snapshot 2, so that some come in both."""
    event_id = F.col("event_id")
    first = topic_rows.filter((event_id % 2 == 0) | (event_id % 10 == 1)).withColumn("snapshot_id", F.lit(1))
    second = topic_rows.filter(event_id % 2 == 1).withColumn("snapshot_id", F.lit(2))
    return first.unionByName(second)


def repair_rules(spark: SparkSession) -> DataFrame:
    schema = "error_reason string, action_value string, enabled boolean, auto_replay boolean"
    return spark.createDataFrame(list(REPAIR_RULES), schema)


def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit per day of the events for each of two tables, at the time of the day's last event."""
    days = events(spark, sf_dir).groupBy(F.dayofyear("ts").alias("day")).agg(F.max("ts").alias("at"))
    tables = F.explode(F.array(F.lit("bronze.kafka_events"), F.lit("silver.bronze_clean"))).alias("table_name")
    return days.select(
        tables, F.col("day").cast("bigint").alias("snapshot_id"), F.col("at").cast("timestamp").alias("committed_at")
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's data files by day, as if the events had been written in from one to thirteen files a day."""
    day = F.dayofyear("ts")
    path = F.concat(F.lit("clean/day="), day.cast("string"), F.lit("/part-"), (F.col("event_id") % (day % 13 + 1)).cast("string"))
    width = F.octet_length("event_type") + F.octet_length("props")
    return events(spark, sf_dir).groupBy(path.alias("file_path")).agg(
        F.count(F.lit(1)).alias("record_count"), F.sum(width).alias("file_size_in_bytes")
    )
