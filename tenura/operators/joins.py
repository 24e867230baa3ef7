"""Joins that stay balanced when one key holds a large share of the rows.

Joins against a unique key (dimension lookups, pre-aggregated measures) need
no helper: plain left joins, where Catalyst broadcasts by file size and AQE
splits a skewed left side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators.ordered import hot_keys, split_by_keys
from tenura.settings import Limits


def fan_out_left(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    limits: Limits | None = None,
    counted: DataFrame | None = None,
    count_by: list[str] | None = None,
) -> DataFrame:
    """``left`` outer join ``right`` on ``keys`` where ``right`` may repeat a key.

    AQE cannot split the right side of a left outer join. Keys that repeat too
    often on the right therefore go through an inner join, which it can split
    on both sides, plus the left rows without a match.

    ``counted`` may name a cheaper frame to look for hot keys in, by the
    columns ``count_by`` out of ``keys``; it must have no fewer rows per key
    than ``right`` has per join key.
    """
    count_by = count_by or keys
    counted = right if counted is None else counted
    hot = hot_keys(counted.dropna(how="any", subset=count_by), count_by, limits)
    if hot is None:
        return left.join(right, keys, "left")
    cold_left, hot_left = split_by_keys(left, count_by, hot)
    cold_right, hot_right = split_by_keys(right, count_by, hot)
    cold = cold_left.join(cold_right, keys, "left")
    unmatched = hot_left.join(hot_right.select(*keys).distinct(), keys, "left_anti")
    matched = hot_right.join(hot_left, keys).select(*cold.columns)
    return cold.unionByName(matched).unionByName(unmatched, allowMissingColumns=True)


def lookup_rows(few: DataFrame, many: DataFrame, few_key: str, many_key: str) -> DataFrame:
    """The rows of ``many`` whose key occurs in ``few``.

    Used before a left join from a small table into a large one: the small
    side of a left join can not be broadcast, the key list of a semi join can,
    so the large table is filtered where it is scanned and not shuffled.
    """
    wanted = few.filter(F.col(few_key).isNotNull()).select(F.col(few_key).alias(many_key)).distinct()
    return many.join(wanted, many_key, "left_semi")


def update_by_key(df: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """Set ``column`` to the value in ``updates`` (one row per ``key``) where the key matches.

    Returns the new version of the table; a matched NULL is stored as NULL.
    """
    new = updates.select(key, F.col(column).alias("_new"), F.lit(True).alias("_matched"))
    joined = df.join(new, key, "left")
    value = F.when(F.col("_matched"), F.col("_new")).otherwise(F.col(column))
    return joined.withColumn(column, value).select(*df.columns)
