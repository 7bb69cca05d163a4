"""Lifetime profile per user: totals, favourite category, favourite device.

Input are measures (see :mod:`tidewell.operators.gold`), per event or already added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.events import or_unknown
from tidewell.operators.gold import count_of

TOTALS = (
    ("total_view", "view"),
    ("total_click", "click"),
    ("total_add_to_cart", "add_to_cart"),
    ("total_purchase", "purchase"),
)
ADDED = (*[name for name, _ in TOTALS], "total_revenue", "n")


def _totals() -> list[Column]:
    return [
        *[count_of(kind).alias(name) for name, kind in TOTALS],
        F.sum("revenue").alias("total_revenue"),
        F.max("last_time").alias("last_active_time"),
    ]


def _most_frequent(value: str, n: str, where: Column | None = None) -> Column:
    """The value with the greatest count, the smallest one on a tie, NULL last.

    A minimum keeps one candidate per task, where a ranking would gather all values of a user.
    """
    rank = F.struct((-F.col(n)).alias("n"), F.col(value).isNull().alias("is_null"), F.col(value).alias("value"))
    return F.min(rank if where is None else F.when(where, rank))["value"]


def user_metrics(measures: DataFrame) -> DataFrame:
    return measures.groupBy("user_id").agg(*_totals())


def user_category_counts(measures: DataFrame) -> DataFrame:
    """Events per user and category; a missing category is a group of its own."""
    return measures.groupBy("user_id", "category").agg(F.sum("n").alias("count"))


def user_device_counts(measures: DataFrame) -> DataFrame:
    """Events per user and device, a missing device as ``unknown``."""
    return measures.groupBy("user_id", or_unknown("device").alias("device")).agg(F.sum("n").alias("count"))


def favorite_category(measures: DataFrame) -> DataFrame:
    counts = user_category_counts(measures)
    return counts.groupBy("user_id").agg(_most_frequent("category", "count").alias("favorite_category"))


def favorite_device(measures: DataFrame) -> DataFrame:
    counts = user_device_counts(measures)
    return counts.groupBy("user_id").agg(_most_frequent("device", "count").alias("favorite_device"))


def user_totals(measures: DataFrame) -> DataFrame:
    """Totals per user, category and device (a missing device as ``unknown``): the finest level of the profile."""
    device = or_unknown("device").alias("device")
    return measures.groupBy("user_id", "category", device).agg(*_totals(), F.sum("n").alias("n"))


def summed_totals(totals: DataFrame, *keys: str) -> DataFrame:
    """Totals added up per user, category and device, and per further ``keys``."""
    return totals.groupBy(*keys, "user_id", "category", "device").agg(
        *[F.sum(name).alias(name) for name in ADDED], F.max("last_active_time").alias("last_active_time")
    )


def total_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """Per hour, what has to be added to the totals of ``before`` to get those of ``now``; nothing where they are equal.

    Both are added up in one grouping, the former with their signs turned. The last activity needs no difference, as
    stored events are never taken away.
    """
    turned = {name: -F.col(name) for name in ADDED}
    both = now.unionByName(before.withColumns({**turned, "last_active_time": F.lit(None).cast("timestamp")}))
    changes = summed_totals(both, "p_hour")
    return changes.filter(" OR ".join(f"{name} <> 0" for name in ADDED))


def user_profile(measures: DataFrame) -> DataFrame:
    """Totals and both favourites of every user from one read of the measures."""
    return profile_of_totals(user_totals(measures))


def profile_of_totals(totals: DataFrame) -> DataFrame:
    """One row per user from totals per user, category and device.

    They are regrouped to three levels by grouping sets, then folded to one row per user: no join, and no step
    gathers the rows of one user. Users without an id get no favourites, as an equality join on the id would give
    them none. Totals that were taken back to nothing count for nothing.
    """
    levels = totals.filter("n > 0").groupingSets(
        [["user_id"], ["user_id", "category"], ["user_id", "device"]], "user_id", "category", "device"
    ).agg(
        # bits from the left: user_id, category, device; a set bit is a column left out
        F.grouping_id().alias("left_out"),
        *[F.sum(name).alias(name) for name in ADDED],
        F.max("last_active_time").alias("last_active_time"),
    )
    by_user, by_category, by_device = (F.col("left_out") == bits for bits in (0b011, 0b001, 0b010))

    def of_user(name: str) -> Column:
        return F.max(F.when(by_user, F.col(name))).alias(name)

    def favorite(value: str, level: Column) -> Column:
        found = _most_frequent(value, "n", level)
        return F.when(F.col("user_id").isNotNull(), found).alias(f"favorite_{value}")

    return levels.groupBy("user_id").agg(
        *[of_user(name) for name, _ in TOTALS],
        of_user("total_revenue"),
        favorite("category", by_category),
        favorite("device", by_device),
        of_user("last_active_time"),
    )
