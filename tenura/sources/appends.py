"""Appending to stored tables with keys that go on counting."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tenura.operators.ordered import number_rows
from tenura.settings import Limits


def stored_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, without rows if nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def last_key(stored: DataFrame, key: str) -> int:
    return stored.agg(F.max(key)).first()[0] or 0


def extend_key_map(df: DataFrame, natural: list[str], key: str, path: str, limits: Limits | None = None) -> DataFrame:
    """The key map at ``path`` after all natural keys of ``df`` that it lacks have been given the next numbers.

    Known natural keys keep their number, so loading a batch again adds
    nothing, and any split of the data into batches covers the same keys as one
    load. NULL is a key value like any other. The new keys are found by an
    anti-join on the bare key columns and numbered in their order by a
    distributed sort behind the largest number of the map. One load writes to a
    map at a time; a load that died half-way is repeated, its numbers stay.
    """
    spark = df.sparkSession
    schema = StructType([*df.select(*natural).schema.fields, StructField(key, LongType())])
    stored = stored_or_empty(spark, path, schema)
    known = stored.select(*[F.col(c).alias(f"_known_{c}") for c in natural])
    same = F.lit(True)
    for c in natural:
        same = same & F.col(c).eqNullSafe(F.col(f"_known_{c}"))
    new = df.select(*natural).distinct().join(known, same, "left_anti")
    append_numbered(new, natural, key, path, limits, start=last_key(stored, key))
    return spark.read.schema(schema).parquet(path)


def append_numbered(
    df: DataFrame, order: list[str], key: str, path: str, limits: Limits | None = None, start: int | None = None
) -> str:
    """Append the rows of ``df`` to the table at ``path``, numbered in ``order`` behind its largest ``key``.

    ``order`` should be unique. ``start`` saves looking for the largest key.
    """
    schema = StructType([*df.schema.fields, StructField(key, LongType())])
    if start is None:
        start = last_key(stored_or_empty(df.sparkSession, path, schema), key)
    numbered = number_rows(df, order, key, limits)
    numbered.withColumn(key, F.col(key) + F.lit(start)).write.mode("append").parquet(path)
    return path
