"""Three ways to join name parts; they differ only in how NULL parts count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_empty_nulls(*parts: Column) -> Column:
    """NULL counts as the empty string; separators stay ('Ann ' for a missing last name)."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def concat_any_null(*parts: Column) -> Column:
    """NULL if any part is NULL."""
    return F.concat(*parts)


def concat_present(separator: str, *parts: Column) -> Column:
    """NULL parts are left out together with their separator."""
    return F.concat_ws(separator, *parts)


def full_name(first: str = "first_name", last: str = "last_name", nulls: str = "skip") -> Column:
    """First and last name; ``nulls`` is 'skip', 'empty' or 'any'."""
    a, b = F.col(first), F.col(last)
    if nulls == "skip":
        return concat_present(" ", a, b)
    if nulls == "empty":
        return concat_empty_nulls(a, F.lit(" "), b)
    if nulls == "any":
        return concat_any_null(a, F.lit(" "), b)
    raise ValueError(f"nulls must be 'skip', 'empty' or 'any', not {nulls!r}")


def or_default(column: str, default) -> Column:
    """The column with NULL replaced, under its own name."""
    return F.coalesce(F.col(column), F.lit(default)).alias(column)
