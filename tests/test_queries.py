"""Registered queries against their SQL, and the known counts of the derived records."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, queries
from checks.queries import QUERIES
from compare import compare
from conftest import SF

# (raw, valid, bad, duplicates removed) of the smallest data folder
GOLDEN = (1200, 693, 307, 200)
REASONS = {"event_time_is_null": 59, "price_is_null": 19, "price_is_negative": 65, "invalid_event_type": 201}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert compare(spark, name, SF) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_golden_counts(spark):
    row = queries()["quality_summary"](spark, SF).first()
    assert (row.total_count, row.valid_count, row.bad_count, row.duplicate_removed_count) == GOLDEN
    found = {row.error_reason: row["count"] for row in queries()["error_reason_counts"](spark, SF).collect()}
    assert found == REASONS
    assert queries()["event_type_5min_count"](spark, SF).count() == 685
    assert queries()["revenue_5min"](spark, SF).agg({"revenue": "sum"}).first()[0] == 34426
