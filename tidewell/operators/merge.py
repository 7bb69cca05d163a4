"""MERGE by its two uses: insert what is absent, update what matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def rows_to_insert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks. Keys compare by plain equality: NULL matches nothing.

    Store a source whose key is costly to compute before merging it: the optimizer
    may move the join below the steps that compute the key and repeat them.
    """
    return source.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def stored_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The keys (texts) of the target that the source has too.

    The condition on the source's keys holds for all; it marks them as a selection, from which the optimizer may build a
    filter for the target's scan.
    """
    wanted = source.select(key).filter(F.length(key) >= 0)
    return target.select(key).join(wanted, key, "left_semi")


def merge_insert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after inserting the absent rows."""
    return target.unionByName(rows_to_insert(target, source, keys))


def merge_update(target: DataFrame, source: DataFrame, key: str, sets: dict[str, Column]) -> DataFrame:
    """The target with ``sets`` applied to the rows whose key occurs in the source."""
    marks = source.select(key).distinct().withColumn("_matched", F.lit(True))
    joined = target.join(marks, key, "left")
    return joined.select(
        *[
            F.when(F.col("_matched"), sets[name]).otherwise(F.col(name)).alias(name) if name in sets else F.col(name)
            for name in target.columns
        ]
    )
