"""Versions of a warehouse: load beside the live one, gate, then publish with one small append.

A load writes all tables into a folder of its own. The manifest is a folder of
JSON lines, one per publication; the last one names the folder readers use. A
publication appends one file, which appears whole or not at all, so readers see
the old version or the new one and never a mixture. A load that fails, or is
never published, changes nothing for them.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tenura.schemas import conform, schema_of
from tenura.sources.writers import LOAD_ORDER, write_table

MANIFEST_SCHEMA = (
    "number bigint, version string, published_at timestamp, tables array<struct<table: string, row_count: bigint>>"
)


def stage(tables: dict[str, DataFrame], directory: str, order: list[str] | None = None) -> tuple[str, dict[str, int]]:
    """Write ``tables`` into a new version folder of ``directory``; (version, row count of each table).

    The rows are counted while they are written, no table is read for it.
    """
    version = f"v-{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    counts = {}
    for name in order or LOAD_ORDER:
        by = ["date_key"] if name == "fact_employee_snapshot" else None
        seen = Observation(f"rows of {name}")
        counted = conform(tables[name], name).observe(seen, F.count(F.lit(1)).alias("rows"))
        write_table(counted, version_path(directory, version, name), partition_by=by)
        counts[name] = seen.get["rows"]
    return version, counts


def version_path(directory: str, version: str, table: str) -> str:
    return f"{directory}/versions/{version}/{table}"


def publications(spark: SparkSession, directory: str) -> DataFrame:
    """(number, version, published_at, tables) of every publication; empty before the first."""
    reader = spark.read.schema(MANIFEST_SCHEMA)
    try:
        return reader.json(f"{directory}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def current_version(spark: SparkSession, directory: str) -> str | None:
    """The version that readers use, None before the first publication."""
    last = publications(spark, directory).agg(F.max_by("version", F.struct("number", "version")).alias("version")).first()
    return last["version"]


def publish(spark: SparkSession, directory: str, version: str, counts: dict[str, int]) -> int:
    """Make ``version`` the one that readers use; its publication number.

    Publishing an earlier version again takes the warehouse back to it. Raises
    if another load has published at the same time: of equal numbers the
    version that sorts last is the one in use.
    """
    number = (publications(spark, directory).agg(F.max("number")).first()[0] or 0) + 1
    line = (number, version, datetime.datetime.now(datetime.UTC), list(counts.items()))
    spark.createDataFrame([line], MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{directory}/manifest")
    if current_version(spark, directory) != version:
        raise RuntimeError(f"another load has been published while {version} was")
    return number


def read_version(spark: SparkSession, directory: str, version: str) -> dict[str, DataFrame]:
    """The tables of a version by their declared schemas, so that tables without rows are read as well."""
    return {
        name: conform(spark.read.schema(schema_of(name)).parquet(version_path(directory, version, name)), name)
        for name in LOAD_ORDER
    }


def count_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "`table` string, row_count bigint")
