"""Surrogate keys, key lookups, unique names and group leaders."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tenura.llm.components import components
from tenura.llm.shipping import ship
from tenura.operators.ordered import RowNumber, RunningMax, number_rows, over_groups
from tenura.operators.skew import KeyProfile, count_hot
from tenura.settings import Limits, materialize, session_limits


def surrogate_keys(
    df: DataFrame, natural: list[str], key: str, limits: Limits | None = None
) -> DataFrame:
    """(natural key, dense 1..n surrogate key) in natural-key order.

    Works on the key columns alone, so that only narrow rows are sorted.
    """
    return number_rows(df.select(*natural), natural, key, limits)


def attach_key(df: DataFrame, key_map: DataFrame, natural: list[str]) -> DataFrame:
    """Look up the surrogate key of every row; unmatched rows get NULL."""
    return df.join(key_map, natural, "left")


def uniquify(
    df: DataFrame,
    base: str,
    order: list[str],
    out: str,
    with_suffix=None,
    limits: Limits | None = None,
) -> DataFrame:
    """Make ``base`` unique: in ``order``, each row takes its base or, while that is taken, counts on from 1.

    ``with_suffix(base, n)`` builds the suffixed value (default: appended);
    it must give another value for each ``n``. ``order`` must be unique. NULL
    stays NULL. The result equals going through all rows one by one, also where
    a suffixed value meets another base (a, a, a1 gives a, a1, a11).

    A base whose names no other base reaches numbers its rows by their place.
    Bases that meet are grouped, and each group is gone through in order by one
    task, which keeps only the names that two bases of the group may take: of a
    row it needs the base and the place, of a base the next number. How far a
    base reaches is a guess at first; where a row goes beyond it, it is widened
    and the groups are made again. Groups over the row limit are numbered in
    rounds instead (``_number_in_rounds``), which spread over all tasks.
    """
    spark = df.sparkSession
    counted = limits or Limits(session_limits(spark).max_group_rows)
    make = with_suffix or (lambda value, n: F.concat(value, n))

    def name(number: Column) -> Column:
        return F.when(number == 0, F.col("_base")).otherwise(make(F.col("_base"), number.cast("string")))

    named = df.filter(F.col(base).isNotNull())
    spans = named.groupBy(F.col(base).alias("_base")).agg(F.count(F.lit(1)).alias("_rows"))
    spans = spans.withColumn("_span", F.col("_rows"))
    met = _met_names(spans, name)
    if met.isEmpty():
        numbered = over_groups(df, [base], order, [RowNumber("_n")], counted).withColumn("_n", F.col("_n") - 1)
        return numbered.withColumn("_base", F.col(base)).withColumn(out, name(F.col("_n"))).drop("_n", "_base")

    places = [f"_o{i}" for i in range(len(order))]
    narrow = named.select(F.col(base).alias("_base"), *[F.col(c).alias(o) for c, o in zip(order, places, strict=True)])
    # a base keeps its rows in all that follows, so its share is counted once
    if counted.profile is None:
        found = frozenset(count_hot(df, [base], counted.max_group_rows))
        hot = KeyProfile({(base,): (df.select(base).schema, found)})
        counted = Limits(counted.max_group_rows, hot | hot.renamed(**{base: "_base"}))
    ranked = materialize(over_groups(narrow, ["_base"], places, [RowNumber("_nth")], counted), "names")
    reached = met.select("_base", (F.lit(4) * F.col("_rows")).alias("_reached")).distinct()
    while True:
        spans = materialize(_widened(spans, reached), "name-spans")
        met = materialize(_met_names(spans, name), "met-names")
        groups, large = _groups(spans, met, counted.max_group_rows)
        moved = materialize(_number_one_by_one(ranked, met, groups.filter(~F.col("_large")), places), "moved-names")
        reached = _beyond(moved, spans)
        if large and reached.isEmpty():
            crowded = ranked.join(groups.filter("_large").select("_base"), "_base", "left_semi")
            state = _number_in_rounds(crowded, places, name, counted)
            shifted = state.filter(F.col("_n") != F.col("_nth") - 1).select("_base", "_nth", "_n")
            moved = materialize(moved.unionByName(shifted), "moved-names")
            reached = _beyond(moved, spans)
        if reached.isEmpty():
            break
    numbered = over_groups(df, [base], order, [RowNumber("_nth")], counted).withColumn("_base", F.col(base))
    joined = numbered.join(moved, ["_base", "_nth"], "left")
    return joined.withColumn(out, name(F.coalesce("_n", F.col("_nth") - 1))).drop("_base", "_nth", "_n")


def _met_names(spans: DataFrame, name) -> DataFrame:
    """(_name, _base, _n, _rows) of each name that several bases have among their first ``_span`` ones."""
    names = spans.select("_base", "_rows", F.explode(F.sequence(F.lit(0), F.col("_span") - 1)).alias("_n"))
    names = names.withColumn("_name", name(F.col("_n")))
    several = names.groupBy("_name").agg(F.count(F.lit(1)).alias("_bases")).filter("_bases > 1").select("_name")
    return names.join(several, "_name", "left_semi").select("_name", "_base", "_n", "_rows")


def _widened(spans: DataFrame, reached: DataFrame) -> DataFrame:
    """The spans, those of bases in ``reached`` at least as wide as it says."""
    return spans.join(reached, "_base", "left").select(
        "_base", "_rows", F.greatest("_span", F.coalesce(F.col("_reached") + 1, F.lit(0))).alias("_span")
    )


def _beyond(moved: DataFrame, spans: DataFrame) -> DataFrame:
    """(_base, _reached): how far the bases should reach of which a row has a number outside the span."""
    most = moved.groupBy("_base").agg(F.max("_n").alias("_most")).join(spans, "_base").filter("_most >= _span")
    return most.select("_base", (F.lit(4) * F.col("_most")).alias("_reached"))


def _groups(spans: DataFrame, met: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """(_base, _group, _large) of the bases linked by names in ``met``, and whether a group has more rows or names than ``limit``."""
    ids = met.select("_name", "_base", F.xxhash64("_base").alias("b"))
    first = ids.groupBy("_name").agg(F.min("b").alias("a"))
    # bases of equal hash share a group, which does no harm
    roots = components(ids.join(first, "_name").select("a", "b"))
    named = met.groupBy("_base").agg(F.count(F.lit(1)).alias("_names")).join(spans.select("_base", "_rows"), "_base")
    bases = named.join(roots, F.xxhash64("_base") == F.col("node"), "left").select(
        "_base", "_rows", "_names", F.coalesce("root", F.xxhash64("_base")).alias("_group")
    )
    bases = materialize(bases, "name-groups")
    sizes = bases.groupBy("_group").agg(F.greatest(F.sum("_rows"), F.sum("_names")).alias("_size"))
    large = sizes.filter(F.col("_size") > limit).select("_group", F.lit(True).alias("_large"))
    marked = bases.join(large, "_group", "left").select("_base", "_group", F.coalesce("_large", F.lit(False)).alias("_large"))
    return marked, not large.isEmpty()


def _number_one_by_one(ranked: DataFrame, met: DataFrame, groups: DataFrame, places: list[str]) -> DataFrame:
    """(_base, _nth, _n) of the rows whose number is not their place, going through each group in order."""
    chosen = groups.select("_base", "_group")
    rows = ranked.join(chosen, "_base").withColumn("_name", F.lit(None).cast("string"))
    names = met.join(chosen, "_base").select("_group", "_name", "_base", F.col("_n").cast("bigint").alias("_nth"))
    events = names.unionByName(rows, allowMissingColumns=True)
    # the names come first, those of one name together, then the rows in order
    ordered = events.repartition("_group").sortWithinPartitions(
        "_group", F.col("_name").asc_nulls_last(), *places, "_base", "_nth"
    )
    ship(ranked.sparkSession)
    return ordered.select("_group", "_name", "_base", "_nth").mapInArrow(_take_names, "_base string, _nth bigint, _n bigint")


def _take_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each group the names that several bases may take, then its rows; each row takes its base's next free name."""
    group = name = None
    for batch in batches:
        rows: list[tuple[str, int, int]] = []
        for of_group, met, base, nth in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if of_group != group:
                group, name, taken = of_group, None, bytearray()
                numbers, ids = {}, {}  # by base: the numbers of its met names, and which names these are
                free, at = {}, {}  # by base: the next number, and the place of the next met name
            if met is not None:
                if met != name:
                    name = met
                    taken.append(0)
                numbers.setdefault(base, array("q")).append(nth)
                ids.setdefault(base, array("q")).append(len(taken) - 1)
                continue
            if base not in free:
                by_number = np.argsort(numbers[base])
                numbers[base] = array("q", np.asarray(numbers[base])[by_number].tobytes())
                ids[base] = array("q", np.asarray(ids[base])[by_number].tobytes())
                free[base] = at[base] = 0
            n, k, own, which = free[base], at[base], numbers[base], ids[base]
            while k < len(own) and own[k] == n and taken[which[k]]:
                n, k = n + 1, k + 1
            if k < len(own) and own[k] == n:
                taken[which[k]] = 1
                k += 1
            free[base], at[base] = n + 1, k
            if n != nth - 1:
                rows.append((base, nth, n))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        types = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["_base", "_nth", "_n"]
        )


def _number_in_rounds(ranked: DataFrame, places: list[str], name, counted: Limits) -> DataFrame:
    """``ranked`` (_base, order, _nth) with the number ``_n`` of each row, for groups too large for one task.

    Each row first asks for the name its place among the rows of its base
    gives. Of the rows that ask for one name the first in order holds it; the
    others go on to their next name that no earlier row holds, and the rows of
    their base behind them move up. A name once lost stays lost, so rounds are
    repeated until no name is asked for twice; the search ahead doubles each
    round. Only (base, order) and the number are kept between rounds.
    """
    place = F.struct(*[F.col(o) for o in places], F.col("_base"), F.col("_nth"))
    state = materialize(ranked.withColumn("_n", F.col("_nth") - 1), "names")
    ahead = 16
    while True:
        asked = state.withColumns({"_name": name(F.col("_n")), "_place": place})
        holders = asked.groupBy("_name").agg(F.min("_place").alias("_holder"), F.count(F.lit(1)).alias("_asking"))
        lost = (
            asked.join(holders.filter("_asking > 1").select("_name", "_holder"), "_name")
            .filter(F.col("_place") > F.col("_holder"))
            .select("_base", "_place", "_nth", "_n")
        )
        lost = materialize(lost, "lost-names")
        if lost.isEmpty():
            return state
        tried = lost.withColumn("_try", F.explode(F.sequence(F.col("_n") + 1, F.col("_n") + ahead)))
        tried = tried.withColumn("_name", name(F.col("_try")))
        # the names that someone earlier holds are passed, the first other one is asked for
        free = tried.join(holders.select("_name", "_holder"), "_name", "left").withColumn(
            "_free", F.col("_holder").isNull() | (F.col("_holder") >= F.col("_place"))
        )
        moved = free.groupBy("_base", "_nth").agg(
            F.coalesce(F.min(F.when(F.col("_free"), F.col("_try"))), F.max("_try") + 1).alias("_moved")
        )
        behind = state.join(lost.select("_base").distinct(), "_base", "left_semi").join(moved, ["_base", "_nth"], "left")
        behind = behind.withColumn("_lead", F.coalesce("_moved", "_n") - F.col("_nth"))
        pushed = over_groups(behind, ["_base"], places, [RunningMax("_lead", "_most")], counted)
        pushed = pushed.select("_base", *places, "_nth", (F.col("_nth") + F.col("_most")).alias("_n"))
        others = state.join(lost.select("_base").distinct(), "_base", "left_anti")
        state = materialize(others.unionByName(pushed), "names")
        ahead = min(2 * ahead, 1 << 16)


def suffix_before_at(value: Column, n: Column) -> Column:
    """john.doe@site -> john.doe1@site."""
    return F.concat(F.substring_index(value, "@", 1), n, F.lit("@"), F.substring_index(value, "@", -1))


def group_leaders(
    df: DataFrame,
    group: str,
    member: str,
    leader: str,
    first_n: int | None = None,
    min_members: int = 2,
    limits: Limits | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The lowest member id leads its group; the others, or the next ones up to ``first_n``, report to it.

    Returns (group, leader) for groups with at least ``min_members`` members
    and (member, leader) for the reporting members. The leaders are a partial
    aggregate. A short ``first_n`` is cut per map task before the shuffle (up
    to spark.sql.optimizer.windowGroupLimitThreshold), so a hot group sends
    ``first_n`` rows per task; a longer one numbers the members hot-key safe.
    """
    present = df.filter(F.col(group).isNotNull()).select(group, member)
    groups = present.groupBy(group).agg(F.min(member).alias(leader), F.count(member).alias("_members"))
    leaders = groups.filter(F.col("_members") >= min_members).select(group, leader)
    if first_n is not None and first_n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        numbered = present.withColumn("_nth", F.row_number().over(W.partitionBy(group).orderBy(member)))
    else:
        numbered = over_groups(present, [group], [member], [RowNumber("_nth")], limits)
    chosen = numbered if first_n is None else numbered.filter(F.col("_nth") <= first_n)
    first = chosen.filter(F.col("_nth") > 1)
    return leaders, first.join(leaders, group).select(member, leader)
