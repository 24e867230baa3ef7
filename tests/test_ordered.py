"""Ordered operators: the plain window and the split way must agree with brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tenura.operators import keys, ordered
from tenura.operators.history import close_history
from tenura.operators.keys import surrogate_keys, uniquify
from tenura.operators.ordered import Neighbour, Rank, RowNumber, RunningMax, hot_keys, number_rows, over_groups
from tenura.operators.skew import KeyProfile, profile_keys, surely_found
from tenura.settings import Limits, materialize, use_profile

SPLIT = Limits(max_group_rows=20)
SPLIT_ALL = Limits(max_group_rows=0)
PLAIN = Limits()


@pytest.fixture(scope="module", autouse=True)
def many_slices(spark):
    """Keep all shuffle partitions, so that the small input has several sort slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def rows():
    """Key 1 holds a third of the rows, NULL is a key, days tie, values have NULLs."""
    rng = random.Random(7)
    out = []
    for i in range(900):
        key = 1 if i % 3 == 0 else rng.choice([None, *range(2, 60)])
        out.append((i, key, rng.randrange(12), rng.choice([None, 1, 2, 3, 4, 5])))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, key bigint, day int, value int").repartition(5).cache()


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    result = {}
    for members in groups.values():
        members.sort(key=lambda r: (r[2], r[0]))
        for i, (row_id, _, day, _) in enumerate(members):
            before = members[i - 1][3] if i else None
            after = members[i + 1][2] if i + 1 < len(members) else None
            rank = 1 + sum(m[2] < day for m in members)
            result[row_id] = (before, after, i + 1, rank)
    return result


@pytest.mark.parametrize("limits", [PLAIN, SPLIT, SPLIT_ALL], ids=["plain", "split hot", "split all"])
def test_over_groups_matches_brute_force(frame, rows, limits):
    columns = [
        Neighbour("value", "before", -1),
        Neighbour("day", "after", 1),
        RowNumber("nth"),
        Rank("rank", ("day",)),
    ]
    df = over_groups(frame, ["key"], ["day", "id"], columns, limits)
    actual = {r["id"]: (r["before"], r["after"], r["nth"], r["rank"]) for r in df.collect()}
    assert actual == expected(rows)
    assert df.columns == ["id", "key", "day", "value", "before", "after", "nth", "rank"]


def test_split_over_several_slices(frame):
    """The hot key really spans several slices of the sort."""
    sliced = ordered._sorted_slices(frame.filter("key = 1"), ["key", "day", "id"])
    assert sliced.select("_slice").distinct().count() > 1


def test_two_column_keys(frame, rows):
    plain = over_groups(frame, ["key", "day"], ["id"], [RowNumber("nth")], PLAIN)
    split = over_groups(frame, ["key", "day"], ["id"], [RowNumber("nth")], Limits(0))
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_hot_keys_finds_only_large_groups(frame):
    found = hot_keys(frame, ["key"], Limits(max_group_rows=100))
    assert [r["key"] for r in found.collect()] == [1]
    assert hot_keys(frame, ["key"], Limits(max_group_rows=10_000)) is None


@pytest.mark.parametrize("limits", [PLAIN, SPLIT], ids=["window", "slices"])
def test_number_rows_is_dense_in_order(frame, rows, limits):
    df = number_rows(frame.select("day", "id"), ["day", "id"], "n", limits)
    actual = [(r["day"], r["id"]) for r in sorted(df.collect(), key=lambda r: r["n"])]
    assert actual == sorted((r[2], r[0]) for r in rows)
    assert sorted(r["n"] for r in df.collect()) == list(range(1, len(rows) + 1))


def test_surrogate_keys_agree(frame):
    small = surrogate_keys(frame, ["id"], "k", PLAIN).collect()
    large = surrogate_keys(frame, ["id"], "k", SPLIT).collect()
    assert sorted(small) == sorted(large)


@pytest.mark.parametrize("limits", [PLAIN, SPLIT_ALL], ids=["plain", "split"])
def test_close_history(spark, limits):
    history = spark.createDataFrame(
        [(1, 1, "2020-01-01"), (2, 1, "2021-01-01"), (3, 1, "2021-01-01"), (4, 2, "2024-02-29")],
        "id bigint, key bigint, day string",
    ).withColumn("day", F.to_date("day"))
    closed = close_history(history, "key", "day", "id", limits=limits)
    ends = {r["id"]: str(r["end_date"]) for r in closed.collect()}
    assert ends == {1: "2020-12-31", 2: "2020-12-31", 3: "None", 4: "None"}


@pytest.mark.parametrize("limits", [PLAIN, SPLIT], ids=["plain", "split"])
def test_uniquify_one_base_for_a_third(frame, rows, limits):
    named = frame.select("id", F.concat(F.lit("k"), F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit("_")).alias("base"))
    unique = uniquify(named, "base", ["id"], "name", limits=limits).collect()
    assert len({r["name"] for r in unique}) == len(rows)
    hot = sorted((r for r in unique if r["base"] == "k1_"), key=lambda r: r["id"])
    assert [r["name"] for r in hot] == ["k1_"] + [f"k1_{i}" for i in range(1, len(hot))]


def one_by_one(rows, make=lambda base, n: f"{base}{n}"):
    """(order, base) -> name, as a loop with a set of taken names gives them."""
    taken, names = set(), {}
    for order, base in sorted(rows):
        if base is None:
            continue
        name, n = base, 0
        while name in taken:
            n += 1
            name = make(base, n)
        taken.add(name)
        names[order] = name
    return names


def colliding(seed):
    rng = random.Random(seed)
    bases = ["a", "a1", "a11", "a2", "a12", "b", "b1", None, "c"]
    rows = [(i, rng.choices(bases, [30, 8, 4, 3, 2, 5, 5, 2, 1])[0]) for i in range(220)]
    run = [(1000 + i, f"d{i}" if i else "d") for i in range(90)] + [(2000, "d"), (2001, "d"), (2002, "d5"), (2003, "d90")]
    return rows + run + [(-5, "d7"), (-6, "d")]


@pytest.mark.parametrize("limits", [PLAIN, SPLIT, SPLIT_ALL], ids=["plain", "split", "split all"])
@pytest.mark.parametrize("rows", [[(1, "a"), (2, "a"), (3, "a1")], [(1, "a1"), (2, "a"), (3, "a")], colliding(1)], ids=["late", "early", "many"])
def test_uniquify_equals_one_by_one(spark, rows, limits):
    frame = spark.createDataFrame(rows, "id bigint, base string").repartition(3)
    got = {r["id"]: r["name"] for r in uniquify(frame, "base", ["id"], "name", limits=limits).collect()}
    want = one_by_one(rows)
    assert {k: v for k, v in got.items() if v is not None} == want and len(set(want.values())) == len(want)
    assert len(got) == len(rows)


def test_uniquify_goes_through_a_group_once(spark, monkeypatch):
    """The tables written do not grow with the rows; before, each round of moved names wrote two."""
    written = []
    keep = lambda df, label: written.append(label) or materialize(df, label)
    monkeypatch.setattr(keys, "materialize", keep)
    counts = []
    for n in (300, 1500):
        rows = [(i, f"s{i % 4}" + (str(i % 5) if i % 3 == 0 else "")) for i in range(n)]
        written.clear()
        frame = spark.createDataFrame(rows, "id bigint, base string").repartition(3)
        got = {r["id"]: r["name"] for r in uniquify(frame, "base", ["id"], "name", limits=PLAIN).collect()}
        assert got == one_by_one(rows)
        counts.append(len(written))
    assert max(counts) <= 1 + 4 * 3


@pytest.mark.parametrize("limits", [PLAIN, SPLIT_ALL], ids=["plain", "split"])
def test_uniquify_names_rows_of_equal_or_no_order(spark, limits):
    """One name for each row; before, a null order never moved on and equal ones multiplied rows."""
    rows = [(None, "a"), (None, "a"), (1, "a1"), (1, "a1"), (2, "a"), (2, "a"), (3, None)]
    frame = spark.createDataFrame(rows, "id bigint, base string")
    got = uniquify(frame, "base", ["id"], "name", limits=limits).collect()
    assert [r for r in got if r["base"] is None] == [(3, None, None)]
    assert sorted(r["name"] for r in got if r["base"]) == ["a", "a1", "a11", "a12", "a2", "a3"]
    assert sorted(r["name"] for r in got if r["base"] and r["id"] is None) == ["a", "a1"]


def test_uniquify_of_nothing(spark):
    empty = spark.createDataFrame([], "id bigint, base string")
    assert uniquify(empty, "base", ["id"], "name").collect() == []


@pytest.mark.parametrize("limits", [PLAIN, SPLIT, SPLIT_ALL], ids=["plain", "split hot", "split all"])
def test_running_max(frame, rows, limits):
    got = {r["id"]: r["most"] for r in over_groups(frame, ["key"], ["day", "id"], [RunningMax("value", "most")], limits).collect()}
    for row_id, key, day, _ in rows:
        before = [r[3] for r in rows if r[1] == key and (r[2], r[0]) <= (day, row_id) and r[3] is not None]
        assert got[row_id] == max(before, default=None)


def test_profile_finds_the_hot_keys_of_all_sets(frame, rows):
    profile = profile_keys(frame, [["key"], ["key", "day"], ["id"]], 100)
    assert {k: {tuple(r) for r in values} for k, (_, values) in profile.hot.items()} == {("key",): {(1,)}, ("key", "day"): set(), ("id",): set()}
    # a limit too fine for any sketch is counted
    for limit in (0, 3, 20):
        counts = {}
        for r in rows:
            counts[r[1]] = counts.get(r[1], 0) + 1
        found = profile_keys(frame, [["key"]], limit, tracked=8).hot[("key",)][1]
        assert {r["key"] for r in found} == {k for k, n in counts.items() if n > limit}


def test_sketch_does_not_miss_a_hot_key(spark):
    """Two hot keys among a hundred thousand cold ones, with a sketch much smaller than the keys."""
    keys = spark.range(300_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 50 = 1 THEN -2 ELSE id % 100000 END AS k")
    assert surely_found(300_000, 1000) < 3000
    assert {r["k"] for r in profile_keys(keys, [["k"]], 3000, tracked=1000).hot[("k",)][1]} == {-1, -2}


def test_no_job_while_a_query_is_built(spark, frame):
    """The profile is made once; operators that use it run nothing until their result is asked for."""
    use_profile(spark, profile_keys(frame, [["key"]], 100).renamed(key="other") | KeyProfile())
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    built = over_groups(frame, ["key"], ["day", "id"], [RowNumber("nth")])
    assert list(jobs.getJobIdsForGroup("building")) == []
    use_profile(spark, profile_keys(frame, [["key"]], 100))
    assert hot_keys(frame, ["key"]).collect()[0]["key"] == 1 and hot_keys(frame, ["id"]) is None
    split = over_groups(frame, ["key"], ["day", "id"], [RowNumber("nth")])
    use_profile(spark, KeyProfile())
    assert sorted(map(str, built.collect())) == sorted(map(str, split.collect()))


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id bigint, key bigint, day int, value int")
    assert over_groups(empty, ["key"], ["day", "id"], [RowNumber("n")], SPLIT).count() == 0
    assert number_rows(empty, ["id"], "n", SPLIT).count() == 0


@pytest.mark.parametrize("column", [Neighbour("value", "other", -2), Rank("rank", ("value",))])
def test_refused_alike_in_every_way(spark, column):
    frame = spark.createDataFrame([(1, 1, 1)], "key int, day int, value int")
    for limits in (None, SPLIT, SPLIT_ALL):
        with pytest.raises(ValueError):
            over_groups(frame, ["key"], ["day"], [column], limits)


def test_hot_key_is_found_whatever_the_estimate(spark, tmp_path):
    spark.range(200_000).selectExpr("1 AS key", "id").write.parquet(str(tmp_path / "hot"))
    frame = spark.read.parquet(str(tmp_path / "hot"))
    found = hot_keys(frame, ["key"], Limits(max_group_rows=100_000))
    assert [r["key"] for r in found.collect()] == [1]
