"""Registry of the bound queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from workload.roles import ROLE_SQL, Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, roles: str = "", sql: str | None = None):
    """Register a function of ``Roles`` as query ``name``.

    ``roles`` lists the role tables that ``sql`` uses; ``sql`` is a SELECT or
    starts with ', name AS (...)' to add common table expressions of its own.
    """

    def register(build: Callable[[Roles], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: portable(build(Roles(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_roles(roles, sql)
        return build

    return register


def with_roles(roles: str, sql: str) -> str:
    tables = ", ".join(f"{name} AS ({ROLE_SQL[name]})" for name in roles.split())
    body = sql.strip()
    if not tables:
        return f"WITH {body[1:]}" if body.startswith(",") else body
    return f"WITH {tables} {body}"


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as double, so that two engines return the same values."""

    def plain(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])
