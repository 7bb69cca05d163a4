"""Insert-if-absent into the clean table, as both the hourly job and the replay do it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewell.functions.events import hour_index
from tidewell.operators.merge import rows_to_insert, stored_keys
from tidewell.schemas import CLEAN_EVENTS
from tidewell.session import settings
from tidewell.sources.tables import Lake, read_hours

# A Bloom filter of the batch's hashes on the scan of the stored ones, for large hours and batches of up to some 40 million rows.
_FILTER = "spark.sql.optimizer.runtime.bloomFilter"
HASH_FILTER = {
    f"{_FILTER}.enabled": "true",
    f"{_FILTER}.applicationSideScanSizeThreshold": "64MB",
    f"{_FILTER}.creationSideThreshold": "4GB",
    f"{_FILTER}.maxNumItems": "40000000",
    f"{_FILTER}.maxNumBits": "335544320",
}


def insert_clean(lake: Lake, rows: DataFrame, times: DataFrame) -> None:
    """Append the ``rows`` (distinct by hash) whose hash the clean table does not hold.

    The hash covers the event time, so a stored copy lies in the same hour: only
    the hours of ``times`` (the rows' event times, cheap to read) are compared,
    and of those only the hash column. Stored hashes that the batch cannot hold end at the scan, so mostly
    those of repeated events are shuffled, and what they find is small beside the batch.
    """
    hours = times.select(hour_index("event_time").alias("p_hour"))
    target = read_hours(lake, CLEAN_EVENTS, hours.distinct())
    with settings(lake.spark, HASH_FILTER):
        lake.append(rows_to_insert(stored_keys(target, rows, "event_hash"), rows, ["event_hash"]), CLEAN_EVENTS)
