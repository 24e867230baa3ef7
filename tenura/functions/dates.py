"""Date arithmetic. ``as_of`` stands for "today" and is explicit everywhere."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: date | str | Column | None = None) -> Column:
    """The evaluation date as a column; the current date if none is given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def parse_date(value: Column) -> Column:
    """Text or timestamp to date; NULL where it does not parse."""
    return value.try_cast("date")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` up to, not including, ``end``."""
    return F.datediff(end, start)


def tenure_years(hired: Column, as_of: Column, half_even: bool = False) -> Column:
    """Days / 365 to two decimals, ties away from zero or to the even digit."""
    rounding = F.bround if half_even else F.round
    return rounding(F.datediff(as_of, hired) / 365, 2)


def whole_years(start: Column, end: Column) -> Column:
    """Completed 365-day years."""
    return F.floor(F.datediff(end, start) / 365).cast("int")


def date_key(day: Column) -> Column:
    """20240315 for 15 March 2024."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def quarter_label(day: Column) -> Column:
    """'Q1 2024'."""
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"), F.lit(" "), F.year(day).cast("string"))


def iso_weekday(day: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(day) + 1).cast("int")
