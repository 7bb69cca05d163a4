from __future__ import annotations

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import text_of
from tidewell.operators import gold, profile

CLEAN = "user_id string, event_type string, category string, device string, price bigint, event_time string"


def clean(spark, rows):
    df = spark.createDataFrame(rows, CLEAN)
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def event(user="u", kind="view", category="book", device="ios", price=10, at="10:00:00"):
    return (user, kind, category, device, price, at and f"2024-01-01 {at}")


def windows(spark, rows):
    return gold.windowed(gold.event_measures(clean(spark, rows)))


def test_window_edge(spark):
    rows = windows(spark, [event(at="10:04:59.999999"), event(at="10:05:00")])
    assert text_of(gold.event_type_5min_count(rows), "window_start", "window_end", "count") == [
        ("2024-01-01 10:00:00", "2024-01-01 10:05:00", "1"),
        ("2024-01-01 10:05:00", "2024-01-01 10:10:00", "1"),
    ]


def test_missing_values(spark):
    rows = windows(
        spark,
        [
            event(user=None, category=None, device=None),
            event(kind=None, price=None),
            event(kind="purchase", price=7),
            event(at=None),
        ],
    )
    assert text_of(gold.event_type_5min_count(rows), "event_type", "count") == [("purchase", "1"), ("view", "1")]
    assert text_of(gold.category_5min_count(rows), "category", "count") == [("book", "2")]
    assert text_of(gold.revenue_5min(rows), "revenue") == [("17",)]
    assert text_of(gold.active_user_5min(rows), "active_user_count") == [("1",)]
    assert text_of(gold.device_5min_summary(rows), "device", "view_count", "revenue", "active_user_count") == [
        ("ios", "0", "7.0", "1"),
        ("unknown", "1", "0.0", "0"),
    ]
    assert text_of(gold.user_activity_5min_summary(rows), "user_id", "view_count", "purchase_count") == [
        (None, "1", "0"),
        ("u", "0", "1"),
    ]


def test_rates(spark):
    kinds = ["view"] * 4 + ["click"] * 2 + ["add_to_cart", "purchase", "purchase", "purchase"]
    row = gold.device_5min_summary(windows(spark, [event(kind=kind) for kind in kinds])).first()
    assert (row.ctr, row.add_to_cart_rate, row.purchase_conversion_rate, row.revenue) == (0.5, 0.25, 0.75, 30.0)
    none = gold.category_conversion_5min(windows(spark, [event(kind="purchase")])).first()
    assert (none.ctr, none.add_to_cart_rate, none.purchase_conversion_rate) == (0.0, 0.0, 0.0)


def test_windows_without_prices_have_no_revenue_row(spark):
    assert gold.revenue_5min(windows(spark, [event(price=None)])).isEmpty()


def test_price_sums_beyond_bigint_are_null_at_every_level(spark):
    rows = windows(spark, [event(price=2**62), event(price=2**62), event(price=1, user="v")])
    for measures in (rows, gold.combine(rows, "start_time", "end_time")):
        assert [row.revenue for row in gold.revenue_5min(measures).collect()] == [None]


VALUES = st.tuples(
    st.sampled_from([None, "u1", "u2", "u3"]),
    st.sampled_from([None, "view", "click", "add_to_cart", "purchase"]),
    st.sampled_from([None, "book", "toy"]),
    st.sampled_from([None, "ios", "unknown"]),
    st.sampled_from([None, 0, 5, 9]),
    st.sampled_from([None, "2024-01-01 10:00:00", "2024-01-01 10:04:00", "2024-01-01 10:07:00", "2024-01-02 00:00:00"]),
)
SLOW = settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(VALUES, min_size=1, max_size=40))
def test_combined_measures_give_the_same_tables(spark, rows):
    direct = windows(spark, rows)
    combined = gold.combine(direct, "start_time", "end_time")
    for table in gold.WINDOW_TABLES.values():
        assert text_of(table(direct)) == text_of(table(combined))
    typed = sum(row[1] is not None and row[5] is not None for row in rows)
    assert sum(row["count"] for row in gold.event_type_5min_count(combined).collect()) == typed


@SLOW
@given(st.lists(VALUES, min_size=1, max_size=40))
def test_profile_against_plain_python(spark, rows):
    measures = gold.event_measures(clean(spark, rows))
    expected = []
    for user in {row[0] for row in rows}:
        mine = [row for row in rows if row[0] == user]
        totals = [sum(row[1] == kind for row in mine) for _, kind in profile.TOTALS]
        bought = [row[4] for row in mine if row[1] == "purchase"]
        amounts = [0.0 for row in mine if row[1] != "purchase"] + [float(price) for price in bought if price is not None]
        revenue = sum(amounts) if amounts else None

        def top(values):
            return min(set(values), key=lambda value: (-values.count(value), value is None, value or ""))

        category = top([row[2] for row in mine]) if user else None
        device = top([row[3] or "unknown" for row in mine]) if user else None
        last = max((row[5] for row in mine if row[5]), default=None)
        expected.append(tuple(None if v is None else str(v) for v in (user, *totals, revenue, category, device, last)))
    columns = ["user_id", *[name for name, _ in profile.TOTALS], "total_revenue"]
    columns += ["favorite_category", "favorite_device", "last_active_time"]
    key = lambda row: tuple(value or "" for value in row)
    assert text_of(profile.user_profile(measures), *columns) == sorted(expected, key=key)


def test_favorite_ties_and_missing_category(spark):
    rows = [event(category=c) for c in (None, None, "b", "b", "a", "a", "c")]
    measures = gold.event_measures(clean(spark, rows))
    assert text_of(profile.favorite_category(measures)) == [("u", "a")]
    mostly_missing = gold.event_measures(clean(spark, rows + [event(category=None)]))
    assert text_of(profile.favorite_category(mostly_missing)) == [("u", None)]
    assert profile.user_profile(mostly_missing).first()["favorite_category"] is None
