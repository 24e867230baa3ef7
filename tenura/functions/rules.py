"""Rule scores, level ladders and keyword bands as plain CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def points(condition: Column, score: int) -> Column:
    """``score`` where the condition holds; 0 where it does not or is unknown."""
    return F.when(condition, F.lit(score)).otherwise(F.lit(0))


def rule_score(rules: list[tuple[Column, int]]) -> Column:
    """Sum of the points of all rules that hold."""
    total = F.lit(0)
    for condition, score in rules:
        total = total + points(condition, score)
    return total


def level_of(score: Column, steps: list[tuple[int, str]], lowest: str) -> Column:
    """Name of the first step whose threshold ``score`` reaches; steps in falling order."""
    return _first_case([(score >= at, name) for at, name in steps], F.lit(lowest))


def equals_flag(column: str, value) -> Column:
    """True where the column equals ``value``, False elsewhere, also for NULL."""
    return F.coalesce(F.col(column) == value, F.lit(False))


def keyword_band(text: Column, bands: dict[str, tuple[int, int]], default: tuple[int, int]) -> Column:
    """(band_min, band_max) of the first keyword, in the given order, contained in ``text``.

    Case does not matter. The list is part of the rule set and short, so it
    becomes one CASE expression instead of a join.
    """
    lowered = F.lower(text)
    cases = [(lowered.contains(word.lower()), _band(limits)) for word, limits in bands.items()]
    return _first_case(cases, _band(default))


def _band(limits: tuple[int, int]) -> Column:
    return F.struct(F.lit(limits[0]).alias("band_min"), F.lit(limits[1]).alias("band_max"))


def _first_case(cases, otherwise):
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)
