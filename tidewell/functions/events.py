"""Column expressions over event fields; all stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# They decide hashes and validity, so they must not change.
EVENT_TYPES = ("view", "click", "purchase", "add_to_cart")
PAYLOAD_FIELDS = ("user_id", "event_type", "product_id", "category", "price", "event_time", "device")
HASH_SEPARATOR = "||"
HASH_NULL = "__NULL__"
EVENT_TIME_IS_NULL = "event_time_is_null"
PRICE_IS_NULL = "price_is_null"
PRICE_IS_NEGATIVE = "price_is_negative"
EVENT_TYPE_IS_NULL = "event_type_is_null"
INVALID_EVENT_TYPE = "invalid_event_type"
UNKNOWN = "unknown"
SECONDS_PER_HOUR = 3600


def event_hash() -> Column:
    """SHA-256 over the seven payload fields, identical for identical content."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit(HASH_NULL)) for name in PAYLOAD_FIELDS]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256)


def error_reasons() -> Column:
    """Every validation rule the row breaks, in rule order; empty when the row is valid."""
    price, kind = F.col("price"), F.col("event_type")
    broken = (
        (F.col("event_time").isNull(), EVENT_TIME_IS_NULL),
        (price.isNull(), PRICE_IS_NULL),
        (price < 0, PRICE_IS_NEGATIVE),
        (kind.isNull(), EVENT_TYPE_IS_NULL),
        (~kind.isin(*EVENT_TYPES), INVALID_EVENT_TYPE),
    )
    return F.array_compact(F.array(*[F.when(test, F.lit(reason)) for test, reason in broken]))


def hour_index(ts: Column | str) -> Column:
    """Whole hours since the epoch, whatever the session zone; bigint, as far years exceed int."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(ts) / SECONDS_PER_HOUR)


def hour_start(index: Column | str) -> Column:
    index = F.col(index) if isinstance(index, str) else index
    return F.timestamp_seconds(index * SECONDS_PER_HOUR)


def or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN))


def guarded_ratio(part: str, whole: str) -> Column:
    """part / whole, and 0.0 when there is nothing to divide by."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def wrapping_abs(number: Column) -> Column:
    """abs() that leaves the smallest bigint as it is instead of failing under ANSI."""
    return F.when(number < 0, F.coalesce(F.try_subtract(F.lit(0).cast("bigint"), number), number)).otherwise(number)
