"""Aggregate layer: five-minute tables over event measures.

Every aggregate takes *measures*: rows that carry ``n`` events of one user, type,
category and device. A measure row is one event (:func:`event_measures`) or the
sum of many (:func:`combine`); the results are the same, so one combined pass can
feed all seven tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.events import guarded_ratio, hour_index, hour_start, or_unknown

WINDOW = "5 minutes"
WINDOW_SECONDS = 300
DIMENSIONS = ("user_id", "event_type", "category", "device")
COUNTED = (
    ("view_count", "view"),
    ("click_count", "click"),
    ("add_to_cart_count", "add_to_cart"),
    ("purchase_count", "purchase"),
)
RATES = (
    ("ctr", "click_count"),
    ("add_to_cart_rate", "add_to_cart_count"),
    ("purchase_conversion_rate", "purchase_count"),
)


def event_measures(clean: DataFrame) -> DataFrame:
    """One measure row per clean event; events without a time included."""
    is_purchase = F.col("event_type") == "purchase"
    return clean.select(
        *DIMENSIONS,
        F.lit(1).cast("bigint").alias("n"),
        F.col("price").isNotNull().cast("bigint").alias("priced"),
        F.col("price").alias("price_total"),
        F.when(is_purchase, F.col("price").cast("double")).otherwise(F.lit(0.0)).alias("revenue"),
        F.col("event_time").alias("last_time"),
    )


def windowed(measures: DataFrame) -> DataFrame:
    """Add the five-minute window of each measure; measures without a time drop out."""
    return (
        measures.withColumn("window", F.window("last_time", WINDOW))
        .withColumn("start_time", F.col("window.start"))
        .withColumn("end_time", F.col("window.end"))
        .drop("window")
    )


def price_total() -> Column:
    """Sum of prices; NULL, not a wrong number or a failed job, when it exceeds a bigint."""
    lost = (F.col("priced") > 0) & F.col("price_total").isNull()
    return F.when(F.bool_or(lost), F.lit(None).cast("bigint")).otherwise(F.try_sum("price_total"))


def combine(measures: DataFrame, *keys: str) -> DataFrame:
    """Add up measures that share ``keys`` and all dimensions."""
    return measures.groupBy(*keys, *DIMENSIONS).agg(
        F.sum("n").alias("n"),
        F.sum("priced").alias("priced"),
        price_total().alias("price_total"),
        F.sum("revenue").alias("revenue"),
        F.max("last_time").alias("last_time"),
    )


def count_of(event_type: str) -> Column:
    return F.sum(F.when(F.col("event_type") == event_type, F.col("n")).otherwise(F.lit(0)))


def _type_counts() -> list[Column]:
    return [count_of(kind).alias(name) for name, kind in COUNTED]


def _bounds() -> list[Column]:
    return [F.col("start_time").alias("window_start"), F.col("end_time").alias("window_end")]


def _window_counts(windows: DataFrame, dimension: str) -> DataFrame:
    counts = windows.filter(F.col(dimension).isNotNull()).groupBy("start_time", "end_time", dimension)
    return counts.agg(F.sum("n").alias("count")).select(dimension, "count", *_bounds())


def event_type_5min_count(windows: DataFrame) -> DataFrame:
    return _window_counts(windows, "event_type")


def category_5min_count(windows: DataFrame) -> DataFrame:
    return _window_counts(windows, "category")


def revenue_5min(windows: DataFrame) -> DataFrame:
    """Sum of the prices of all events of a window, whatever their type."""
    sums = windows.filter(F.col("priced") > 0).groupBy("start_time", "end_time")
    return sums.agg(price_total().alias("revenue")).select("revenue", *_bounds())


def active_user_5min(windows: DataFrame) -> DataFrame:
    users = windows.filter(F.col("user_id").isNotNull()).groupBy("start_time", "end_time")
    return users.agg(F.count_distinct("user_id").alias("active_user_count")).select("active_user_count", *_bounds())


def _conversion(windows: DataFrame, dimension: str) -> DataFrame:
    """Type counts, conversion rates, purchase revenue and distinct users per window and dimension."""
    groups = windows.withColumn(dimension, or_unknown(dimension)).groupBy("start_time", "end_time", dimension)
    totals = groups.agg(
        *_type_counts(),
        F.sum("revenue").alias("revenue"),
        F.count_distinct("user_id").alias("active_user_count"),
    )
    return _with_rates(totals, dimension)


def _with_rates(totals: DataFrame, dimension: str) -> DataFrame:
    return totals.select(
        "start_time",
        "end_time",
        dimension,
        *[name for name, _ in COUNTED],
        *[guarded_ratio(part, "view_count").alias(rate) for rate, part in RATES],
        "revenue",
        "active_user_count",
    )


def device_5min_summary(windows: DataFrame) -> DataFrame:
    return _conversion(windows, "device")


def category_conversion_5min(windows: DataFrame) -> DataFrame:
    return _conversion(windows, "category")


def user_activity_5min_summary(windows: DataFrame) -> DataFrame:
    """Type counts, purchase revenue and last activity per window and user; a NULL user is a group."""
    return windows.groupBy("start_time", "end_time", "user_id").agg(
        *_type_counts(),
        F.sum("revenue").alias("revenue"),
        F.max("last_time").alias("last_active_time"),
    )


WINDOW_TABLES = {
    "event_type_5min_count": event_type_5min_count,
    "category_5min_count": category_5min_count,
    "revenue_5min": revenue_5min,
    "active_user_5min": active_user_5min,
    "device_5min_summary": device_5min_summary,
    "category_conversion_5min": category_conversion_5min,
    "user_activity_5min_summary": user_activity_5min_summary,
}


# --- all tables of a refresh from one grouping ---------------------------------------------------

BY_TYPE, BY_USER, BY_DEVICE, BY_CATEGORY, BY_HOUR = "type", "user", "device", "category", "hour"


def leveled(measures: DataFrame) -> DataFrame:
    """Every measure once per level it counts in, added up per level, time and dimensions.

    Windows are summed by type and by user (alone, per device and per category), hours by user, category and device. One
    grouping does all levels, so one shuffle carries them, combined before it; distinct users are rows from here on.
    A measure without a time counts in the NULL hour only. ``named`` are the events that have a category.
    """
    seconds = F.floor(F.unix_seconds("last_time") / WINDOW_SECONDS) * WINDOW_SECONDS
    window, hour = F.timestamp_seconds(seconds), hour_start(hour_index("last_time"))
    nothing, user, device, timed = F.lit(None).cast("string"), F.col("user_id"), or_unknown("device"), F.col("last_time").isNotNull()

    def level(name: str, start: Column, user: Column, first: Column, second: Column = nothing) -> Column:
        return F.struct(
            F.lit(name).alias("level"), start.alias("start_time"), user.alias("user_id"), first.alias("first"), second.alias("second")
        )

    at_levels = F.array(
        F.when(timed & F.col("event_type").isNotNull(), level(BY_TYPE, window, nothing, F.col("event_type"))),
        F.when(timed, level(BY_USER, window, user, nothing)),
        F.when(timed, level(BY_DEVICE, window, user, device)),
        F.when(timed, level(BY_CATEGORY, window, user, or_unknown("category"))),
        level(BY_HOUR, hour, user, F.col("category"), device),
    )
    counted = measures.select(
        F.explode(F.array_compact(at_levels)).alias("at"),
        "n",
        "priced",
        "price_total",
        "revenue",
        "last_time",
        F.when(F.col("category").isNotNull(), F.col("n")).otherwise(F.lit(0)).alias("named"),
        *[F.when(F.col("event_type") == kind, F.col("n")).otherwise(F.lit(0)).alias(name) for name, kind in COUNTED],
    )
    return _added(counted.select("at.*", *[name for name in counted.columns if name != "at"]), "level", "start_time", "user_id", "first", "second")


def _added(sums: DataFrame, *keys: str, more: tuple[Column, ...] = ()) -> DataFrame:
    return sums.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("priced").alias("priced"),
        price_total().alias("price_total"),
        F.sum("revenue").alias("revenue"),
        F.max("last_time").alias("last_time"),
        F.sum("named").alias("named"),
        *[F.sum(name).alias(name) for name, _ in COUNTED],
        *more,
    )


def window_totals(sums: DataFrame) -> DataFrame:
    """The user levels of :func:`leveled` added up over the users, who are counted: a row per level, window and dimension."""
    users = (F.count("user_id").alias("users"),)
    return _added(sums.filter(F.col("level").isin(BY_USER, BY_DEVICE, BY_CATEGORY)), "level", "start_time", "first", more=users)


def refreshed_tables(sums: DataFrame, totals: DataFrame) -> dict[str, DataFrame]:
    """The seven window tables, each a projection of one level."""

    def rows(levels: DataFrame, level: str) -> DataFrame:
        end = (F.col("start_time") + F.expr(f"INTERVAL {WINDOW}")).alias("end_time")
        return levels.filter(F.col("level") == level).select("*", end)

    def counts(levels: DataFrame, level: str, n: str) -> DataFrame:
        return rows(levels, level).filter(F.col(n) > 0).select(F.col("first").alias(level), F.col(n).alias("count"), *_bounds())

    def conversion(level: str) -> DataFrame:
        return _with_rates(rows(totals, level).withColumnsRenamed({"first": level, "users": "active_user_count"}), level)

    windows = rows(totals, BY_USER)
    return {
        "event_type_5min_count": counts(sums, BY_TYPE, "n").withColumnRenamed(BY_TYPE, "event_type"),
        "category_5min_count": counts(totals, BY_CATEGORY, "named"),
        "revenue_5min": windows.filter("priced > 0").select(F.col("price_total").alias("revenue"), *_bounds()),
        "active_user_5min": windows.filter("users > 0").select(F.col("users").alias("active_user_count"), *_bounds()),
        "device_5min_summary": conversion(BY_DEVICE),
        "category_conversion_5min": conversion(BY_CATEGORY),
        "user_activity_5min_summary": rows(sums, BY_USER).select(
            "start_time", "end_time", "user_id", *[name for name, _ in COUNTED], "revenue", F.col("last_time").alias("last_active_time")
        ),
    }


def hour_totals(sums: DataFrame) -> DataFrame:
    """What the profile needs of each hour: totals per user, category and device."""
    return sums.filter(F.col("level") == BY_HOUR).select(
        hour_index("start_time").alias("p_hour"),
        "user_id",
        F.col("first").alias("category"),
        F.col("second").alias("device"),
        *[F.col(name).alias(f"total_{kind}") for name, kind in COUNTED],
        F.col("revenue").alias("total_revenue"),
        F.col("last_time").alias("last_active_time"),
        "n",
    )
