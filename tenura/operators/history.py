"""Interval-valued history and slowly changing dimensions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.ordered import Neighbour, over_groups
from tenura.settings import Limits

OPEN_END = "9999-12-31"


def current_rows(df: DataFrame, end: str = "end_date") -> DataFrame:
    """Rows whose interval is open."""
    return df.filter(F.col(end).isNull())


def latest_by(df: DataFrame, key: str, value: str, order: list[str], out: str) -> DataFrame:
    """Last non-NULL ``value`` per ``key``; a partial aggregate, and no sort if ``order`` is a date and a whole number."""
    newest = F.max_by(F.col(value), _position(df, order)).alias(out)
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(newest)


def _position(df: DataFrame, order: list[str]) -> Column:
    """What sorts like the columns of ``order``, NULL first.

    An aggregate that keeps a struct is sort-based, one that keeps a number is
    hash-based, so a date and a whole number become one number.
    """
    types = [df.schema[c].dataType.typeName() for c in order]
    if len(types) != 2 or types[0] != "date" or types[1] not in ("byte", "short", "integer", "long"):
        return F.struct(*order)
    day = F.coalesce(F.unix_date(order[0]), F.lit(-(2**31))).cast("decimal(10,0)")
    number = F.coalesce(F.col(order[1]).cast("decimal(20,0)"), F.lit(Decimal(-(2**63) - 1)).cast("decimal(20,0)"))
    return day * F.lit(Decimal(10**20)).cast("decimal(21,0)") + number


def close_history(
    df: DataFrame,
    key: str,
    start: str,
    tie_break: str,
    out: str = "end_date",
    limits: Limits | None = None,
) -> DataFrame:
    """Chain the rows of a key: each ends the day before the next starts, the last stays open."""
    chained = over_groups(df, [key], [start, tie_break], [Neighbour(start, "_next", 1)], limits)
    return chained.withColumn(out, F.date_sub(F.col("_next"), 1)).drop("_next")


def scd2_columns(df: DataFrame, effective: Column) -> DataFrame:
    """Open-ended current version: effective_date, expiry_date and is_current."""
    return (
        df.withColumn("effective_date", effective)
        .withColumn("expiry_date", F.lit(OPEN_END).cast("date"))
        .withColumn("is_current", F.lit(True))
    )


def scd2_merge(
    versions: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: list[str],
    as_of: Column,
    close_missing: bool = True,
) -> DataFrame:
    """New set of versions after ``incoming`` (one row per key) replaces the current state.

    Unchanged keys keep their version. A changed key has its version closed the
    day before ``as_of`` and a new one opened; new keys open a version; keys
    missing from ``incoming`` are closed if ``close_missing``. A version opened
    on ``as_of`` itself lasted no day: it is replaced, not closed. The query
    fails if it would close a version opened after ``as_of``. Values compare
    NULL-safe column by column. One full outer join on the key; every joined
    pair turns into its one or two versions in place. Write the result to a new
    path: it reads ``versions``.
    """
    names = [key, *tracked, "effective_date", "expiry_date", "is_current"]
    history = versions.filter(~F.col("is_current")).select(*names)
    current = versions.filter("is_current").select(
        F.col(key).alias("_old_key"), *[F.col(c).alias(f"_old_{c}") for c in [*tracked, "effective_date", "expiry_date"]]
    )
    new = incoming.select(F.col(key).alias("_new_key"), *[F.col(c).alias(f"_new_{c}") for c in tracked])
    pairs = current.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    has_old, has_new = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    closes = has_old & ((has_new & changed) | (~has_new & F.lit(close_missing)))
    opens = has_new & (~has_old | changed)
    stays = has_old & ~(closes & F.col("_old_effective_date").eqNullSafe(as_of))
    too_late = closes & (F.col("_old_effective_date") > as_of)

    kept = F.struct(
        F.col("_old_key").alias(key),
        *[F.col(f"_old_{c}").alias(c) for c in tracked],
        F.col("_old_effective_date").alias("effective_date"),
        F.when(too_late, F.raise_error(F.lit("as_of lies before the start of a current version")).cast("date"))
        .when(closes, F.date_sub(as_of, 1))
        .otherwise(F.col("_old_expiry_date"))
        .alias("expiry_date"),
        (~closes).alias("is_current"),
    )
    opened = F.struct(
        F.col("_new_key").alias(key),
        *[F.col(f"_new_{c}").alias(c) for c in tracked],
        as_of.alias("effective_date"),
        F.lit(OPEN_END).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"),
    )
    both = F.filter(F.array(F.when(stays, kept), F.when(opens, opened)), lambda v: v.isNotNull())
    merged = pairs.select(F.explode(both).alias("v")).select(*[F.col(f"v.{c}").alias(c) for c in names])
    return history.unionByName(merged)


def month_ends(first: Column, last: Column) -> Column:
    """The month-end dates within [first, last] as an array; empty if there are none."""
    from_month = F.trunc(first, "month")
    to_month = F.add_months(F.trunc(F.date_add(last, 1), "month"), -1)
    starts = F.sequence(from_month, F.greatest(from_month, to_month), F.expr("interval 1 month"))
    ends = F.transform(starts, F.last_day)
    return F.when(to_month >= from_month, ends).otherwise(F.array().cast("array<date>"))
