"""Group summaries; all are partial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.ordered import hot_keys, split_by_keys
from tenura.settings import Limits


def amount_stats(amount: str) -> list[Column]:
    """Average, minimum, maximum and sample standard deviation to two decimals."""
    return [
        F.round(F.avg(amount), 2).alias("avg_salary"),
        F.round(F.min(amount), 2).alias("min_salary"),
        F.round(F.max(amount), 2).alias("max_salary"),
        F.round(F.stddev(amount), 2).alias("salary_stddev"),
    ]


def sum_or_zero(value: Column) -> Column:
    """Sum that is 0 when there is nothing but NULLs to add."""
    return F.coalesce(F.sum(value), F.lit(0))


def leave_days(leaves: DataFrame, key: str = "employee_id", out: str = "total_leave_days") -> DataFrame:
    """Days of approved leave per key, computed from the interval."""
    approved = leaves.filter(F.col("status") == "approved")
    return approved.groupBy(key).agg(F.sum(F.datediff("end_date", "start_date")).alias(out))


def average_rating(reviews: DataFrame, key: str = "employee_id", out: str = "avg_rating") -> DataFrame:
    return reviews.groupBy(key).agg(F.round(F.avg("rating"), 1).alias(out))


def distinct_pairs(df: DataFrame, pair: list[str], keep_first_by: str, limits: Limits | None = None) -> DataFrame:
    """One row per pair: the one with the lowest ``keep_first_by``, ties by the other columns.

    The rows of a pair's first key meet in one task, so that grouping or joining
    by that key afterwards needs no shuffle of its own. Pairs of a hot first key
    are spread by both columns.
    """
    hot = hot_keys(df, pair[:1], limits)
    if hot is None:
        return _first_of_pairs(df.repartition(pair[0]), pair, keep_first_by)
    cold_rows, hot_rows = split_by_keys(df, pair[:1], hot)
    cold = _first_of_pairs(cold_rows.repartition(pair[0]), pair, keep_first_by)
    return cold.unionByName(_first_of_pairs(hot_rows, pair, keep_first_by))


def _first_of_pairs(df, pair, keep_first_by):
    rest = [c for c in df.columns if c not in pair and c != keep_first_by]
    first = F.min(F.struct(keep_first_by, *rest)).alias("_first")
    return df.groupBy(*pair).agg(first).select(*pair, "_first.*").select(*df.columns)


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """(row_count, distinct_count) of a column."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(column).alias("distinct_count"))


def distinct_sketches(df: DataFrame, by: list[str], column: str, bits: int = 12) -> DataFrame:
    """(by, sketch): a mergeable sketch of the distinct values of ``column`` per group, 2 ** bits registers each.

    Stored once per partition of a table, sketches answer any union of
    partitions without reading the values again. NULL is not counted.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, bits).alias("sketch"))


def united_count(sketches: DataFrame, by: list[str] | None = None, out: str = "distinct_count") -> DataFrame:
    """The estimated number of distinct values per ``by``, or over all sketches; they must have the same size."""
    return sketches.groupBy(*(by or [])).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def sketch_error(bits: int = 12) -> float:
    """Relative error that an estimate exceeds in less than 0.3 % of cases (three standard deviations)."""
    return 3 * 1.04 / 2 ** (bits / 2)


def top_n(df: DataFrame, n: int, by: Column, *tie_break: str) -> DataFrame:
    """First ``n`` rows by ``by`` and the tie-break; planned as a distributed top-n."""
    return df.orderBy(by, *tie_break).limit(n)
