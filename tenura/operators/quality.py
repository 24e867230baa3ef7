"""Declarative data-quality checks as Spark jobs.

Every check is a lazy frame (table, check, columns, failing_rows, passed).
Row-local checks of one table share a single scan; uniqueness and references
are pre-aggregated by key, so a hot key does not burden one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowRule:
    """A rule each row meets or breaks by itself; ``broken`` is True for failing rows."""

    check: str
    columns: tuple[str, ...]
    broken: Column


def not_null(column: str) -> RowRule:
    return RowRule("not_null", (column,), F.col(column).isNull())


def accepted_values(column: str, values: list) -> RowRule:
    """NULL passes."""
    return RowRule("accepted_values", (column,), ~F.col(column).isin(*values))


def in_range(column: str, low, high) -> RowRule:
    """``low <= column <= high``; NULL passes."""
    return RowRule("in_range", (column,), ~F.col(column).between(low, high))


def non_negative(column: str) -> RowRule:
    return RowRule("non_negative", (column,), F.col(column) < 0)


def max_length(column: str, limit: int) -> RowRule:
    """Text of at most ``limit`` characters; NULL passes."""
    return RowRule("max_length", (column,), F.length(column) > limit)


def implies(condition: Column, column: str, values: list) -> RowRule:
    """Where ``condition`` holds, ``column`` has one of ``values``."""
    return RowRule("implies", (column,), condition & ~F.col(column).isin(*values))


def row_checks(df: DataFrame, table: str, rules: list[RowRule]) -> DataFrame:
    """All rules in one aggregate over one scan, one result row per rule."""
    counts = df.agg(*[F.count(F.when(r.broken, True)).alias(f"_{i}") for i, r in enumerate(rules)])
    lines = F.array(
        *[
            F.struct(
                F.lit(r.check).alias("check"),
                F.lit(",".join(r.columns)).alias("columns"),
                F.col(f"_{i}").alias("failing_rows"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return _report(counts.select(F.explode(lines).alias("line")).select("line.*"), table)


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """The keys that occur more than once, with their row count; keys with a NULL do not count."""
    keyed = df.select(*columns).dropna(how="any", subset=columns)
    return keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def unique(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """failing_rows counts the keys that occur more than once."""
    return _count_report(duplicate_keys(df, columns), F.count(F.lit(1)), table, "unique", columns)


def primary_key(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Keys that repeat plus rows with a NULL in the key, from one grouping."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    has_null = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    failing = F.sum(F.when(has_null, F.col("row_count")).when(F.col("row_count") > 1, 1).otherwise(0))
    return _count_report(groups, F.coalesce(failing, F.lit(0)), table, "primary_key", columns)


def key_checks(df: DataFrame, table: str, checks: list[tuple[str, list[str]]]) -> DataFrame:
    """Several 'primary_key' and 'unique' checks from one scan and one shuffle, a row per check as by themselves.

    The rows are expanded into one grouping set per key and counted by a
    partial aggregate, so a key with many rows is one row per map task.
    """
    columns = list(dict.fromkeys(c for _, keys in checks for c in keys))
    sets = [list(keys) for keys in dict.fromkeys(tuple(keys) for _, keys in checks)]
    counted = df.groupingSets(sets, *columns).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows"))
    failing = []
    for check, keys in checks:
        # a bit for each column that is not in the set, the first column's the highest
        own = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        has_null = reduce(Column.__or__, [F.col(c).isNull() for c in keys])
        nulls = F.col("_rows") if check == "primary_key" else F.lit(0)
        broken = F.when(has_null, nulls).when(F.col("_rows") > 1, 1).otherwise(0)
        failing.append(F.coalesce(F.sum(F.when(F.col("_set") == own, broken)), F.lit(0)))
    lines = F.array(
        *[
            F.struct(F.lit(check).alias("check"), F.lit(",".join(keys)).alias("columns"), F.col(f"_{i}").alias("failing_rows"))
            for i, (check, keys) in enumerate(checks)
        ]
    )
    found = counted.agg(*[f.alias(f"_{i}") for i, f in enumerate(failing)])
    return _report(found.select(F.explode(lines).alias("line")).select("line.*"), table)


def orphan_keys(child: DataFrame, parent: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """(key, row_count) of child keys without a parent; NULL keys are allowed."""
    used = (
        child.filter(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("_fk"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(key).alias("_pk"))
    return used.join(known, F.col("_fk") == F.col("_pk"), "left_anti").withColumnRenamed("_fk", foreign_key)


def references(
    child: DataFrame, parent: DataFrame, foreign_key: str, key: str, table: str
) -> DataFrame:
    orphans = orphan_keys(child, parent, foreign_key, key)
    total = F.coalesce(F.sum("row_count"), F.lit(0))
    return _count_report(orphans, total, table, "references", [foreign_key])


def minimum_rows(df: DataFrame, table: str, least: int) -> DataFrame:
    """failing_rows is the number of missing rows."""
    missing = F.greatest(F.lit(least) - F.count(F.lit(1)), F.lit(0))
    return _count_report(df, missing, table, "minimum_rows", [])


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def required_columns(df: DataFrame, table: str, required: list[str]) -> DataFrame:
    """failing_rows counts the columns that the schema lacks, and those that hold no value in any row."""
    absent = missing_columns(df, required)
    present = [c for c in required if c not in absent]
    empty = sum([F.when(F.count(c) == 0, 1).otherwise(0) for c in present], F.lit(len(absent)))
    line = df.agg(empty.alias("failing_rows")).select(
        F.lit("required_columns").alias("check"), F.lit(",".join(required)).alias("columns"), "failing_rows"
    )
    return _report(line, table)


def combine(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def gate(report: DataFrame) -> None:
    """Raise if any check failed. The report has one row per check."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        lines = [f"{r['table']}.{r['check']}({r['columns']}): {r['failing_rows']}" for r in failed]
        raise ValueError("data-quality checks failed: " + "; ".join(lines))


def gate_rows(counts: dict[str, int], minimum_rows: dict[str, int]) -> None:
    """Raise if a table has fewer rows than asked for, by counts that are known already."""
    short = {name: least - counts[name] for name, least in minimum_rows.items() if counts[name] < least}
    if short:
        lines = [f"{name}.minimum_rows(): {missing}" for name, missing in short.items()]
        raise ValueError("data-quality checks failed: " + "; ".join(lines))


def _count_report(df, failing, table, check, columns):
    line = df.agg(failing.alias("failing_rows")).select(
        F.lit(check).alias("check"), F.lit(",".join(columns)).alias("columns"), "failing_rows"
    )
    return _report(line, table)


def _report(lines: DataFrame, table: str) -> DataFrame:
    return lines.select(
        F.lit(table).alias("table"),
        "check",
        "columns",
        F.col("failing_rows").cast("bigint").alias("failing_rows"),
        (F.col("failing_rows") == 0).alias("passed"),
    )
