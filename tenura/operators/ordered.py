"""Ordered work inside groups (lag, lead, row number, rank, running maximum) without hot tasks.

A window puts all rows of one key into one task. That is the best plan as long
as every key is small. The rows of the keys that are known to be hot, or found
to be by a count if the limits ask for it, are range-sorted by (key, order)
instead, which spreads a key over many tasks, and written once to the shared
folder with their position in the sort. The written positions are stable, so
everything that follows may be recomputed. Neighbours then come from a window
over one sort slice plus the edge row of the adjacent slice, row numbers and
running maxima from slice offsets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tenura.operators.skew import count_hot
from tenura.settings import Limits, materialize, session_limits

_POSITION_BITS = 33  # monotonically_increasing_id: partition id above, row position below


@dataclass(frozen=True)
class Neighbour:
    """Value of the row ``step`` rows away: -1 is the previous, +1 the next row."""

    value: str
    out: str
    step: int = -1


@dataclass(frozen=True)
class RowNumber:
    """1, 2, 3, ... in the order of the group."""

    out: str


@dataclass(frozen=True)
class Rank:
    """Rank with gaps over the leading order columns ``by``; ties share a rank."""

    out: str
    by: tuple[str, ...]


@dataclass(frozen=True)
class RunningMax:
    """Largest ``value`` from the first row of the group up to the row itself."""

    value: str
    out: str


def over_groups(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[Neighbour | RowNumber | Rank | RunningMax],
    limits: Limits | None = None,
) -> DataFrame:
    """Add ``columns`` computed within ``keys`` in ascending ``order``.

    ``order`` should end in a unique column, so that the result does not depend
    on the physical order and a hot key can be split anywhere.
    """
    _check(order, columns)
    hot = hot_keys(df, keys, limits)
    if hot is None:
        return _by_window(df, keys, order, columns)
    cold_rows, hot_rows = split_by_keys(df, keys, hot)
    return _by_window(cold_rows, keys, order, columns).unionByName(_by_slices(hot_rows, keys, order, columns))


def _check(order, columns) -> None:
    """Refuse, in every way alike, what the split way can not compute."""
    for c in columns:
        if isinstance(c, Neighbour) and c.step not in (-1, 1):
            raise ValueError(f"{c.out}: a neighbour is one row before or after")
        if isinstance(c, Rank) and list(c.by) != list(order[: len(c.by)]):
            raise ValueError(f"{c.out}: rank by the leading columns of the order")


def number_rows(df: DataFrame, order: list[str], out: str, limits: Limits | None = None) -> DataFrame:
    """Dense 1..n over the whole frame in ascending ``order``.

    ``order`` should be unique: equal rows can not be spread over the sort.
    """
    numbered = _with_global_position(_sorted_slices(df, order))
    return numbered.withColumn(out, F.col("_at") + 1).drop("_at", "_slice", "_pos")


def hot_keys(df: DataFrame, keys: list[str], limits: Limits | None = None) -> DataFrame | None:
    """The keys with more than ``max_group_rows`` rows, or None if there are none.

    They are looked up in the profile of the limits, by default that of the
    session, without a job; limits without a profile have them counted. At most
    (rows / max_group_rows) keys of a table can be hot, which bounds what
    reaches the driver and what is broadcast by ``split_by_keys``.
    """
    spark = df.sparkSession
    limits = limits or session_limits(spark)
    if limits.profile is not None:
        return limits.profile.frame(spark, keys)
    rows = count_hot(df, keys, limits.max_group_rows)
    return spark.createDataFrame(rows, df.select(*keys).schema) if rows else None


def split_by_keys(df: DataFrame, keys: list[str], chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is not in ``chosen``, rows whose key is); NULL equals NULL.

    ``chosen`` comes from ``hot_keys`` and is bounded by it, so it is broadcast.
    """
    small = F.broadcast(chosen.select(*[F.col(k).alias(f"_hot_{k}") for k in keys]))
    same = _all([F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return df.join(small, same, "left_anti"), df.join(small, same, "left_semi")


def _by_window(df, keys, order, columns):
    ordered = W.partitionBy(*keys).orderBy(*order)
    for c in columns:
        if isinstance(c, Neighbour):
            pick = F.lag(c.value, -c.step) if c.step < 0 else F.lead(c.value, c.step)
            df = df.withColumn(c.out, pick.over(ordered))
        elif isinstance(c, RowNumber):
            df = df.withColumn(c.out, F.row_number().over(ordered).cast("bigint"))
        elif isinstance(c, RunningMax):
            so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
            df = df.withColumn(c.out, F.max(c.value).over(so_far))
        else:
            df = df.withColumn(c.out, F.rank().over(W.partitionBy(*keys).orderBy(*c.by)).cast("bigint"))
    return df


def _sorted_slices(df, order):
    sorted_rows = df.orderBy(*order).withColumn("_sort_id", F.monotonically_increasing_id())
    stored = materialize(sorted_rows, "ordered")
    return (
        stored.withColumn("_slice", F.shiftright("_sort_id", _POSITION_BITS))
        .withColumn("_pos", F.col("_sort_id").bitwiseAND((1 << _POSITION_BITS) - 1))
        .drop("_sort_id")
    )


def _with_global_position(sliced):
    # one row per slice of the sort, at most spark.sql.shuffle.partitions rows
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select(F.col("_slice"), F.coalesce(before, F.lit(0)).alias("_offset"))
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn("_at", F.col("_offset") + F.col("_pos"))
        .drop("_offset")
    )


def _by_slices(df, keys, order, columns):
    names = df.columns
    rows = _with_global_position(_sorted_slices(df, [*keys, *order]))
    for c in columns:
        names = [*names, c.out]
        if isinstance(c, Neighbour):
            rows = _slice_neighbour(rows, keys, c)
        elif isinstance(c, RowNumber):
            rows = _nth_of(rows, keys, c.out, hot_only=True)
        elif isinstance(c, RunningMax):
            rows = _slice_running_max(rows, keys, c)
        else:
            rows = _nth_of(rows, keys, "_in_group", hot_only=True)
            rows = _nth_of(rows, [*keys, *c.by], "_in_tie", hot_only=False)
            rows = rows.withColumn(c.out, F.col("_in_group") - F.col("_in_tie") + 1)
            rows = rows.drop("_in_group", "_in_tie")
    return rows.select(*names)


def _nth_of(rows, keys, out, hot_only):
    """Add the 1-based position of each row counted from the first row of its ``keys``."""
    starts = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min("_at").alias("_start"))
    if hot_only:  # one row per hot key
        starts = F.broadcast(starts)
    same = _all([F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    joined = rows.join(starts, same).withColumn(out, F.col("_at") - F.col("_start") + 1)
    return joined.drop("_start", *[f"_k_{k}" for k in keys])


def _slice_running_max(rows, keys, c):
    names = [f"_k_{k}" for k in keys]
    # one row per slice and hot key in it
    parts = rows.groupBy("_slice", *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(
        F.max(c.value).alias("_top")
    )
    earlier = W.partitionBy(*names).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select(F.col("_slice").alias("_part"), *names, F.max("_top").over(earlier).alias("_carried"))
    same = _all([F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    inside = W.partitionBy("_slice", *keys).orderBy("_pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = rows.withColumn("_inside", F.max(c.value).over(inside)).join(
        F.broadcast(carried), same & (F.col("_slice") == F.col("_part"))
    )
    return joined.withColumn(c.out, F.greatest("_inside", "_carried")).drop("_inside", "_carried", "_part", *names)


def _slice_neighbour(rows, keys, c):
    if abs(c.step) != 1:
        raise ValueError("only the adjacent row is supported for split groups")
    payload = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(c.value).alias("v"))
    in_slice = W.partitionBy("_slice").orderBy("_pos")
    by_slice = W.orderBy("_slice")  # one row per slice
    back = c.step < 0
    edge = F.max_by("_row", "_pos") if back else F.min_by("_row", "_pos")
    shift = F.lag if back else F.lead
    with_row = rows.withColumn("_row", payload)
    edges = (
        with_row.groupBy("_slice")
        .agg(edge.alias("_edge"))
        .select("_slice", shift("_edge", 1).over(by_slice).alias("_beyond"))
    )
    near = (
        with_row.withColumn("_inside", shift("_row", 1).over(in_slice))
        .join(F.broadcast(edges), "_slice")
        .withColumn("_near", F.coalesce("_inside", "_beyond"))
    )
    same = _all([F.col(k).eqNullSafe(F.col(f"_near.k{i}")) for i, k in enumerate(keys)])
    same = same & F.col("_near").isNotNull()
    return near.withColumn(c.out, F.when(same, F.col("_near.v"))).drop("_row", "_inside", "_beyond", "_near")


def _all(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result
