"""Table scans: files, catalog tables, SQL text and JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.schemas import SOURCE_TABLES, schema_of


def read_parquet(spark: SparkSession, directory: str, table: str, schema=None) -> DataFrame:
    """``<directory>/<table>.parquet``; with a known ``schema`` no file is opened before the query runs."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{directory}/{table}.parquet")


def read_csv(spark: SparkSession, path: str, table: str | None = None, schema=None) -> DataFrame:
    """CSV with a header, typed by the declared schema of ``table`` or by ``schema``."""
    return spark.read.schema(schema or schema_of(table)).csv(path, header=True)


def read_sql(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan; with a partition column it is read by many tasks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """Scan a database table; takes the arguments of ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def read_jdbc_by_key(
    spark: SparkSession, url: str, table: str, key: str, partitions: int, properties: dict[str, str] | None = None
) -> DataFrame:
    """Scan a database table with ``partitions`` tasks over the range of its numeric ``key``.

    The range comes from one aggregate that the database computes.
    """
    bounds = f"(SELECT min({key}) AS low, max({key}) AS high FROM {table}) AS bounds"
    row = read_jdbc(spark, url=url, table=bounds, properties=properties).first()
    if row is None or row["low"] is None:
        return read_jdbc(spark, url=url, table=table, properties=properties)
    return read_jdbc(
        spark,
        url=url,
        table=table,
        properties=properties,
        partition_column=key,
        lower=row["low"],
        upper=row["high"],
        partitions=partitions,
    )


def read_source_tables(spark: SparkSession, directory: str, file_format: str = "parquet") -> dict[str, DataFrame]:
    """All declared source tables found as ``<directory>/<table>.<format>``."""
    options = {"header": "true"} if file_format == "csv" else {}
    return {
        table: spark.read.format(file_format)
        .options(**options)
        .schema(schema_of(table))
        .load(f"{directory}/{table}.{file_format}")
        for table in SOURCE_TABLES
    }


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make every frame available to SQL text under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def current_schema(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_schema() AS current_schema")


def count_rows(df: DataFrame, out: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row_count, column_count) of every table in one job; each scan only counts."""
    parts = [
        count_rows(df).select(
            F.lit(name).alias("table"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result
