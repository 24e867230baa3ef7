"""Sinks: warehouse tables, CSV exports and schema creation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.schemas import SOURCE_TABLES, WAREHOUSE_TABLES, conform, empty_table, schema_of

LOAD_ORDER = [
    "dim_date",
    "dim_department",
    "dim_employee",
    "dim_project",
    "dim_leave_type",
    "fact_employee_snapshot",
]


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the named columns; names that are not there do not matter."""
    return df.drop(*names)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Write parquet; 'overwrite' is the full refresh, 'append' adds rows."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, mode: str = "append"):
    """Append to (or overwrite) a database table in batches of 1000 rows."""
    options = {"batchsize": "1000", "truncate": "true", **(properties or {})}
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def export_csv(df: DataFrame, path: str, one_file: bool = False) -> str:
    """Write CSV with a header as distributed part files; as one file, by one task, only if asked for."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)
    return path


def export_tables(tables: dict[str, DataFrame], directory: str) -> dict[str, str]:
    return {name: export_csv(df, f"{directory}/{name}") for name, df in tables.items()}


def save_as_table(
    df: DataFrame, name: str, path: str, bucket_by: str | None = None, buckets: int = 0
) -> DataFrame:
    """Materialise as a catalog table stored at ``path``.

    Tables bucketed by the same column and count join on it without a shuffle,
    which pays off for tables joined on the employee in every report.
    """
    writer = df.write.mode("overwrite").option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create_source_schema(spark: SparkSession, database: str, directory: str) -> list[str]:
    """Drop and create the empty source tables."""
    return _create(spark, database, directory, list(SOURCE_TABLES), replace=True)


def create_warehouse_schema(spark: SparkSession, database: str, directory: str) -> list[str]:
    """Create the warehouse tables that do not exist yet."""
    return _create(spark, database, directory, list(WAREHOUSE_TABLES), replace=False)


def _create(spark, database, directory, tables, replace):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in tables:
        name = f"{database}.{table}"
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        if not spark.catalog.tableExists(name):
            save_as_table(empty_table(spark, table), name, f"{directory}/{table}")
    return tables


def show_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows as a frame; printing is left to the caller."""
    return df.limit(n)


def total_rows(profile: DataFrame) -> DataFrame:
    """Sum of the row counts of a table profile."""
    return profile.agg(F.sum("row_count").alias("total_rows"))
