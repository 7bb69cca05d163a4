"""Schema drift: which JSON keys a batch carries, compared with the expected ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.events import PAYLOAD_FIELDS


def record_keys(text: str = "raw_value") -> Column:
    """The distinct top-level keys of a JSON record, sorted; NULL for what is no JSON object."""
    return F.array_sort(F.array_distinct(F.json_object_keys(text)))


def observed_keys(bronze: DataFrame) -> DataFrame:
    """Distinct top-level JSON keys. Nearly all records share a key set, so sets are reduced before keys."""
    keys = bronze.select(record_keys().alias("keys")).distinct()
    return keys.select(F.explode("keys").alias("column_name")).distinct()


def with_key_sets(bronze: DataFrame, text: str = "raw_value") -> DataFrame:
    """Beside each record whether its keys are the expected ones in their usual order, and else its key set.

    Both are columns, so the keys are read once and in generated code, and sorted only where they are unusual; an observed
    metric would compute what it holds anew for each of its aggregates, and interpreted.
    """
    usual, keys = F.array(*[F.lit(name) for name in PAYLOAD_FIELDS]), F.col("_keys")
    unusual = F.when(keys != usual, F.array_sort(F.array_distinct(keys)))
    found = bronze.withColumn("_keys", F.json_object_keys(text))
    return found.withColumns({"_as_expected": keys == usual, "_other_set": unusual}).drop("_keys")


def key_metrics() -> list[Column]:
    """Metrics of :func:`with_key_sets` for ``DataFrame.observe``: how many records have the usual keys, and the other key sets, each once.

    They ride along with the job that writes the batch, so no pass of their own reads the records.
    """
    return [F.count_if("_as_expected").alias("as_expected"), F.collect_set("_other_set").alias("other_sets")]


def keys_of_metrics(metrics: dict) -> list[str]:
    """The distinct keys that :func:`key_metrics` saw."""
    seen = set(PAYLOAD_FIELDS) if metrics["as_expected"] else set()
    return sorted(seen.union(*metrics["other_sets"]))


def schema_drift(keys: DataFrame, pipeline: str) -> DataFrame:
    """One row of sorted key lists when a key outside the expected ones appeared, else none."""
    expected = F.array(*[F.lit(name) for name in PAYLOAD_FIELDS])
    observed = keys.agg(F.array_sort(F.collect_set("column_name")).alias("observed_columns"))
    return observed.select(
        F.lit(pipeline).alias("pipeline_name"),
        "observed_columns",
        F.array_sort(F.array_except(expected, "observed_columns")).alias("missing_columns"),
        F.array_sort(F.array_except("observed_columns", expected)).alias("new_columns"),
    ).filter(F.size("new_columns") > 0)


def schema_change_requests(keys: DataFrame, pipeline: str) -> DataFrame:
    """A pending request per new key; to be merged on name, column and change type."""
    return keys.filter(~F.col("column_name").isin(*PAYLOAD_FIELDS)).select(
        F.lit(pipeline).alias("pipeline_name"),
        "column_name",
        F.lit("new_column").alias("change_type"),
        F.lit("pending").alias("status"),
    )
