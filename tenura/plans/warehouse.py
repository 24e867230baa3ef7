"""Build, load and validate the star schema."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from tenura.operators import quality
from tenura.operators.keys import attach_key, surrogate_keys
from tenura.operators.ordered import number_rows
from tenura.plans import dimensions, facts
from tenura.plans.extract import extract_all
from tenura.schemas import (
    FOREIGN_KEYS,
    MAX_LENGTHS,
    NOT_NULL,
    PRIMARY_KEYS,
    RANGES,
    SOURCE_TABLES,
    UNIQUE_KEYS,
    WAREHOUSE_TABLES,
)
from tenura.settings import Limits, materialize
from tenura.sources.publish import current_version, publish, read_version, stage

# fixed values: rows a loaded warehouse table has at least
MINIMUM_ROWS = {"dim_employee": 100, "dim_department": 5, "fact_employee_snapshot": 100, "dim_date": 365}


#: the calendar's last year unless the load is later
LAST_YEAR = 2026


def star_schema(
    spark: SparkSession,
    extracts: dict[str, DataFrame],
    source: dict[str, DataFrame],
    as_of=None,
    start_year: int = 2015,
    end_year: int | None = None,
    rating: str = "latest",
    limits: Limits | None = None,
    carry: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """The five dimensions with surrogate keys and the fact that refers to them.

    Keys are numbered on the bare id columns of ``source``, then looked up by
    the wide dimensions and the fact alike. The calendar ends with ``end_year``,
    by default with 2026 or the year of ``as_of`` if that is later.
    """
    if end_year is None:
        end_year = max(LAST_YEAR, int(str(as_of or datetime.date.today())[:4]))
    employee_keys = surrogate_keys(source["employees"], ["employee_id"], "employee_key", limits)
    department_keys = surrogate_keys(source["departments"], ["department_id"], "department_key", limits)
    project_keys = surrogate_keys(source["projects"], ["project_id"], "project_key", limits)
    fact = facts.fact_employee_snapshot(
        extracts["employees"],
        extracts["salaries"],
        extracts["reviews"],
        extracts["leaves"],
        extracts["emp_projects"],
        employee_keys,
        department_keys,
        as_of,
        rating,
        limits=limits,
        carry=carry,
    )
    return {
        "dim_date": dimensions.dim_date(spark, start_year, end_year),
        "dim_department": attach_key(
            dimensions.dim_department(extracts["departments"]), department_keys, ["department_id"]
        ),
        "dim_employee": attach_key(
            dimensions.dim_employee(extracts["employees"], as_of), employee_keys, ["employee_id"]
        ),
        "dim_project": attach_key(dimensions.dim_project(extracts["projects"]), project_keys, ["project_id"]),
        "dim_leave_type": dimensions.dim_leave_type(spark),
        "fact_employee_snapshot": fact,
    }


def build_warehouse(
    spark: SparkSession,
    source: dict[str, DataFrame],
    directory: str,
    as_of=None,
    start_year: int = 2015,
    end_year: int | None = None,
    minimum_rows: dict[str, int] | None = None,
    limits: Limits | None = None,
) -> dict[str, DataFrame]:
    """Extract, transform, load into a new version, validate, publish; returns the loaded tables.

    Raises if a table has too few rows or a fact key no row in its dimension;
    what was published before then stays what readers see. The row counts come
    from the writing itself.
    """
    tables = star_schema(
        spark, extract_all(source), source, as_of, start_year, end_year, limits=limits, carry=("salary_id",)
    )
    # the sort looks at its input twice, for the ranges and for the rows, so the joins are stored before it;
    # the salary id makes the order unique, so that the rows of one employee spread over the sort
    tables["fact_employee_snapshot"] = number_rows(
        materialize(tables["fact_employee_snapshot"], "fact-rows"), ["employee_key", "salary_id"], "snapshot_id", limits
    )
    version, counts = stage(tables, directory)
    loaded = read_version(spark, directory, version)
    least = MINIMUM_ROWS if minimum_rows is None else minimum_rows
    quality.gate_rows(counts, least)
    quality.gate(quality.combine(_key_checks(loaded, "fact_employee_snapshot")))
    publish(spark, directory, version, counts)
    return loaded


def read_warehouse(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The tables of the published version; raises before the first publication."""
    version = current_version(spark, directory)
    if version is None:
        raise ValueError(f"no warehouse has been published in {directory}")
    return read_version(spark, directory, version)


def minimum_row_report(tables: dict[str, DataFrame], minimum_rows: dict[str, int]) -> DataFrame:
    return quality.combine([quality.minimum_rows(tables[name], name, least) for name, least in minimum_rows.items()])


def source_checks(source: dict[str, DataFrame]) -> DataFrame:
    """All declared constraints of the source tables as one report."""
    return quality.combine([report for table in SOURCE_TABLES for report in _table_checks(source, table)])


def warehouse_checks(loaded: dict[str, DataFrame]) -> DataFrame:
    """All declared constraints of the loaded warehouse tables as one report."""
    return quality.combine([report for table in WAREHOUSE_TABLES for report in _table_checks(loaded, table)])


def _table_checks(tables, table):
    df = tables[table]
    keys = [("primary_key", [PRIMARY_KEYS[table]]), *[("unique", columns) for columns in UNIQUE_KEYS.get(table, [])]]
    reports = [quality.key_checks(df, table, keys)]
    rules = [quality.not_null(c) for c in NOT_NULL.get(table, [])]
    rules += [quality.in_range(c, low, high) for c, (low, high) in RANGES.get(table, {}).items()]
    rules += [quality.max_length(c, limit) for c, limit in MAX_LENGTHS.get(table, {}).items()]
    if rules:
        reports.append(quality.row_checks(df, table, rules))
    return reports + _key_checks(tables, table)


def _key_checks(tables, table):
    return [
        quality.references(tables[table], tables[parent], column, key, table)
        for column, (parent, key) in FOREIGN_KEYS.get(table, {}).items()
    ]
