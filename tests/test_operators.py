"""Functions, joins, keys, history and quality checks on edge frames."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenura import schemas
from tenura.functions import dates, names, rules
from tenura.operators import aggregates, history, joins, keys, quality
from tenura.settings import Limits, materialize, shared_folder
from tenura.sources.stored_history import StoredHistory

SPLIT = Limits(max_group_rows=2)


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))


def test_concat_variants(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "b"), (None, None)], "first_name string, last_name string")
    rows = df.select(
        names.full_name().alias("s"), names.full_name(nulls="empty").alias("e"), names.full_name(nulls="any").alias("n")
    ).collect()
    assert [tuple(r) for r in rows] == [("a b", "a b", "a b"), ("a", "a ", None), ("b", " b", None), ("", " ", None)]
    with pytest.raises(ValueError):
        names.full_name(nulls="other")


def test_rounding_half_up_and_half_even(spark):
    hired = spark.createDataFrame([("0.125",), ("0.135",)], "x string").select(F.col("x").cast("decimal(5,3)").alias("x"))
    rounded = hired.select(F.round("x", 2).alias("up"), F.bround("x", 2).alias("even")).collect()
    assert [(str(r["up"]), str(r["even"])) for r in rounded] == [("0.13", "0.12"), ("0.14", "0.14")]


def test_dates(spark):
    df = spark.createDataFrame([("2020-02-29",), ("2021-01-03",)], "t string").select(F.to_date("t").alias("d"))
    day = F.col("d")
    as_of = dates.as_of_date("2024-02-28")
    row = df.select(
        dates.date_key(day).alias("k"),
        dates.iso_weekday(day).alias("w"),
        dates.quarter_label(day).alias("q"),
        dates.whole_years(day, as_of).alias("y"),
        dates.days_between(day, as_of).alias("n"),
    ).collect()
    assert tuple(row[0]) == (20200229, 6, "Q1 2020", 4, 1460)
    assert tuple(row[1])[:2] == (20210103, 7)
    parsed = spark.createDataFrame([("2024-01-05",), ("soon",), (None,)], "t string").select(dates.parse_date(F.col("t")))
    assert [r[0] for r in parsed.collect()] == [date(2024, 1, 5), None, None]
    assert df.select(dates.as_of_date()).first()[0] is not None


def test_rules(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "id int, rating double")
    score = rules.rule_score([(F.col("rating") < 3, 2), (F.col("id") > 1, 1)])
    scored = df.select("id", score.alias("s")).withColumn("l", rules.level_of(F.col("s"), [(2, "HIGH"), (1, "MEDIUM")], "LOW"))
    assert values(scored, "id", "s", "l") == [(1, 2, "HIGH"), (2, 1, "MEDIUM"), (3, 1, "MEDIUM")]


def test_keyword_band_takes_the_first_in_declared_order(spark):
    titles = spark.createDataFrame(
        [("Senior Engineer",), ("junior manager",), ("Clerk",), (None,)], "t string"
    )
    band = rules.keyword_band(F.col("t"), schemas.SALARY_BANDS, schemas.DEFAULT_SALARY_BAND)
    rows = titles.select("t", band.alias("b")).select("t", "b.*").collect()
    assert [tuple(r)[1:] for r in rows] == [(90000, 140000), (55000, 80000), (60000, 100000), (60000, 100000)]


@pytest.mark.parametrize("limits", [Limits(), SPLIT], ids=["plain", "split"])
def test_fan_out_left_keeps_every_row(spark, limits):
    left = spark.createDataFrame([(i, f"n{i}") for i in range(10)] + [(None, "x")], "k int, name string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7), (77, 8), (None, 9)] + [(None, i) for i in range(9)], "k int, v int")
    joined = joins.fan_out_left(left, right, ["k"], limits)
    assert joined.columns == ["k", "name", "v"]
    want = [(1, "n1", i) for i in range(50)] + [(2, "n2", 7)] + [(i, f"n{i}", None) for i in (0, *range(3, 10))]
    want.append((None, "x", None))
    assert values(joined, "k", "name", "v") == sorted(want, key=lambda t: tuple(str(x) for x in t))


def test_fan_out_left_counted_by_part_of_the_key(spark):
    left = spark.createDataFrame([(k, m) for k in (1, 2, None) for m in range(4)], "k int, m int")
    right = spark.createDataFrame([(1, m % 3, m) for m in range(30)] + [(2, 1, 5)], "k int, m int, v int")
    plain = joins.fan_out_left(left, right, ["k", "m"])
    split = joins.fan_out_left(left, right, ["k", "m"], SPLIT, right.select("k"), ["k"])
    assert split.columns == plain.columns
    assert values(split, "k", "m", "v") == values(plain, "k", "m", "v")
    assert split.count() == 30 + 1 + 3 + 4 + 1  # the fourth month of key 1 and the NULL key stay


def test_update_by_key(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, None, 0)], "k int, v string, z int")
    updates = spark.createDataFrame([(2, "B"), (3, "C"), (9, "Z"), (1, None)], "k int, v string")
    assert values(joins.update_by_key(df, updates, "k", "v"), "k", "v", "z") == [(1, None, 0), (2, "B", 0), (3, "C", 0)]


def test_lookup_rows(spark):
    few = spark.createDataFrame([(1, 5), (2, None), (3, 5)], "k int, m int")
    many = spark.range(10).select(F.col("id").cast("int").alias("e"))
    assert values(joins.lookup_rows(few, many, "m", "e"), "e") == [(5,)]


def test_group_leaders_first_n_and_minimum(spark):
    members = [(1, i) for i in range(100, 130)] + [(2, 7)] + [(3, 9), (3, 8)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(members, "g int, e int")
    leaders, reporting = keys.group_leaders(df, "g", "e", "m", first_n=20)
    assert values(leaders, "g", "m") == [(1, 100), (3, 8)]
    assert values(reporting, "e", "m") == sorted(
        [(i, 100) for i in range(101, 120)] + [(9, 8)], key=lambda t: tuple(map(str, t))
    )


def test_group_leaders_beyond_the_group_limit(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id").alias("e"))
    for limits in (Limits(), Limits(max_group_rows=100)):
        _, reporting = keys.group_leaders(df, "g", "e", "m", first_n=1200, limits=limits)
        rows = reporting.collect()
        assert len(rows) == 2 * 1199 and max(r["e"] for r in rows) == 2 * 1200 - 1
        assert all(r["m"] == r["e"] % 2 for r in rows)


def test_suffix_before_at(spark):
    df = spark.createDataFrame([(1, "a.b@x"), (2, "a.b@x"), (3, "c@x"), (4, "a.b@x")], "id int, base string")
    unique = keys.uniquify(df, "base", ["id"], "email", keys.suffix_before_at)
    assert values(unique, "id", "email") == [(1, "a.b@x"), (2, "a.b1@x"), (3, "c@x"), (4, "a.b2@x")]


def test_latest_by_skips_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, 1, "2020-01-01", 3), (2, 1, "2020-01-01", 4), (3, 1, "2021-01-01", None), (4, 2, "2020-01-01", None)],
        "id int, k int, d string, v int",
    )
    assert values(history.latest_by(df, "k", "v", ["d", "id"], "last"), "k", "last") == [(1, 4)]


def test_distinct_pairs_keeps_the_first(spark):
    df = spark.createDataFrame([(3, 1, 1, "c"), (1, 1, 1, "a"), (2, 1, 2, "b")], "id int, p int, q int, v string")
    kept = aggregates.distinct_pairs(df, ["p", "q"], "id")
    assert kept.columns == df.columns and values(kept, "id", "v") == [(1, "a"), (2, "b")]


def test_distinct_pairs_split_and_with_nulls(spark):
    rows = [(4, 1, 1, "d"), (1, 1, 1, "a"), (2, 1, 2, "b"), (3, None, 1, "c"), (5, None, 1, "e"), (6, 2, None, None)]
    df = spark.createDataFrame(rows, "id int, p int, q int, v string")
    kept = [(1, 1, 1, "a"), (2, 1, 2, "b"), (3, None, 1, "c"), (6, 2, None, None)]
    for limits in (None, Limits(max_group_rows=0), Limits(max_group_rows=2)):
        pairs = aggregates.distinct_pairs(df, ["p", "q"], "id", limits)
        assert pairs.columns == df.columns and sorted(map(tuple, pairs.collect())) == kept


def test_counting_distinct_pairs_shuffles_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 AS p", "id % 5 AS q").write.parquet(str(tmp_path / "work"))
    pairs = aggregates.distinct_pairs(spark.read.parquet(str(tmp_path / "work")), ["p", "q"], "id")
    counts = pairs.groupBy("p").agg(F.count("q").alias("n"))
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted(map(tuple, counts.collect())) == [(p, 5) for p in range(7)]


def test_month_ends(spark):
    cases = [
        ("2024-01-15", "2024-03-31", ["2024-01-31", "2024-02-29", "2024-03-31"]),
        ("2024-01-31", "2024-02-28", ["2024-01-31"]),
        ("2024-02-01", "2024-01-31", []),
        ("2024-05-10", "2024-05-09", []),
        (None, "2024-05-09", None),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, b string")
    ends = df.select(history.month_ends(F.to_date("a"), F.to_date("b")).alias("e")).collect()
    # an unknown start gives no months: NULL or empty explode alike
    assert [[str(x) for x in r["e"]] if r["e"] else (None if r["e"] is None else []) for r in ends[:4]] == [c[2] for c in cases[:4]]
    assert not ends[4]["e"]


def test_month_ends_against_brute_force(spark):
    rng = random.Random(3)
    start = date(2019, 12, 28)
    cases = []
    for _ in range(400):
        first = start + timedelta(days=rng.randrange(500))
        cases.append((first, first + timedelta(days=rng.randrange(-5, 150))))
    rows = (
        spark.createDataFrame(cases, "a date, b date")
        .select("a", "b", history.month_ends(F.col("a"), F.col("b")).alias("e"))
        .collect()
    )
    for r in rows:
        days = [r["a"] + timedelta(days=n) for n in range((r["b"] - r["a"]).days + 1)]
        assert r["e"] == [x for x in days if (x + timedelta(days=1)).day == 1]


def test_tenure_against_exact_arithmetic(spark):
    as_of = date(2024, 1, 1)
    hired = [(as_of - timedelta(days=n),) for n in range(-400, 9000, 7)]
    rows = (
        spark.createDataFrame(hired, "h date")
        .select("h", dates.tenure_years(F.col("h"), dates.as_of_date(as_of)).alias("t"))
        .collect()
    )
    cent = Decimal("0.01")
    for r in rows:
        exact = (Decimal((as_of - r["h"]).days) / 365).quantize(cent, ROUND_HALF_UP)
        assert Decimal(str(r["t"])).quantize(cent) == exact


def test_scd2_merge_twice_changes_nothing(spark):
    first = spark.range(200).select("id", (F.col("id") % 7).alias("v"))
    second = spark.range(50, 250).select("id", (F.col("id") % 5).alias("v"))
    columns = ["id", "v", "effective_date", "expiry_date", "is_current"]
    opened = history.scd2_columns(first, dates.as_of_date("2020-01-01"))
    merged = history.scd2_merge(opened, second, "id", ["v"], dates.as_of_date("2021-01-01"))
    again = history.scd2_merge(merged, second, "id", ["v"], dates.as_of_date("2022-01-01"))
    assert values(merged, *columns) == values(again, *columns)
    current = values(merged.filter("is_current"), "id", "v")
    assert current == values(second, "id", "v")


def test_scd2_merge_on_the_day_of_a_version_replaces_it(spark):
    first, second = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(1, "c")], "k int, v string")
    day = dates.as_of_date("2024-01-01")
    opened = history.scd2_columns(first, day)
    merged = history.scd2_merge(opened, second, "k", ["v"], day)
    assert [(r.k, r.v, str(r.effective_date), r.is_current) for r in merged.collect()] == [(1, "c", "2024-01-01", True)]
    with pytest.raises(Exception, match="before the start"):
        history.scd2_merge(opened, second, "k", ["v"], dates.as_of_date("2023-12-31")).collect()


def test_latest_by_packed_order_matches_the_struct_order(spark):
    big = 2**63 - 1
    rows = [
        (1, 1, "1960-01-01", big), (1, 2, "1960-01-02", -big - 1), (1, 9, None, big),
        (2, 3, "2020-01-01", -5), (2, 4, "2020-01-01", 5), (2, 5, "2020-01-01", None),
        (3, 6, None, None), (3, None, "2024-01-01", 1), (4, None, "2024-01-01", 1),
    ]
    df = spark.createDataFrame(rows, "k int, v int, d string, i long").withColumn("d", F.to_date("d"))
    found = history.latest_by(df, "k", "v", ["d", "i"], "v")
    assert {tuple(r) for r in found.collect()} == {(1, 2), (2, 4), (3, 6)}
    plain = history.latest_by(df.withColumn("d", F.col("d").cast("string")), "k", "v", ["d", "i"], "v")
    assert {tuple(r) for r in plain.collect()} == {(1, 2), (2, 4), (3, 6)}
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("close_missing", [True, False])
def test_scd2_merge(spark, close_missing):
    old = spark.createDataFrame(
        [
            (1, "a", "2020-01-01", "2020-12-31", False),
            (1, "b", "2021-01-01", "9999-12-31", True),
            (2, "same", "2020-01-01", "9999-12-31", True),
            (3, None, "2020-01-01", "9999-12-31", True),
            (4, "gone", "2020-01-01", "9999-12-31", True),
        ],
        "k int, v string, effective_date string, expiry_date string, is_current boolean",
    ).withColumns({c: F.to_date(c) for c in ("effective_date", "expiry_date")})
    new = spark.createDataFrame([(1, "c"), (2, "same"), (3, None), (5, "new")], "k int, v string")
    merged = history.scd2_merge(old, new, "k", ["v"], dates.as_of_date("2024-01-01"), close_missing)
    got = {tuple(map(str, r)) for r in merged.collect()}
    gone = ("4", "gone", "2020-01-01", "2023-12-31", "False") if close_missing else ("4", "gone", "2020-01-01", "9999-12-31", "True")
    assert got == {
        ("1", "a", "2020-01-01", "2020-12-31", "False"),
        ("1", "b", "2021-01-01", "2023-12-31", "False"),
        ("1", "c", "2024-01-01", "9999-12-31", "True"),
        ("2", "same", "2020-01-01", "9999-12-31", "True"),
        ("3", "None", "2020-01-01", "9999-12-31", "True"),
        ("5", "new", "2024-01-01", "9999-12-31", "True"),
        gone,
    }


def test_stored_history_leaves_closed_versions_alone(spark, tmp_path, monkeypatch):
    columns = ["k", "v", "effective_date", "expiry_date", "is_current"]
    stored = StoredHistory(str(tmp_path / "history"), "k", StructType.fromDDL("k int, v string"))
    assert stored.versions(spark).columns == columns and stored.versions(spark).isEmpty()
    states = [
        ("2020-01-01", [(1, "a"), (2, "b"), (3, None)]),
        ("2021-01-01", [(1, "c"), (2, "b"), (4, "d")]),
        ("2021-01-01", [(1, "c"), (2, "e"), (4, "f")]),
        ("2022-01-01", []),
        ("2023-01-01", [(1, "c")]),
    ]
    whole = history.scd2_columns(spark.createDataFrame([], "k int, v string"), dates.as_of_date("2020-01-01"))
    before = {}
    for day, rows in states:
        state = spark.createDataFrame(rows, "k int, v string")
        stored.load(state, dates.as_of_date(day))
        whole = spark.createDataFrame(
            history.scd2_merge(whole, state, "k", ["v"], dates.as_of_date(day)).collect(), whole.schema
        )
        assert values(stored.versions(spark), *columns) == values(whole, *columns)
        files = {p: p.stat().st_mtime_ns for p in (tmp_path / "history").rglob("*.parquet")}
        assert before.items() <= files.items()
        before = files
    opened = stored.open_versions(spark)
    assert len(opened.inputFiles()) >= 1 and all("is_current=true" in f for f in opened.inputFiles())
    assert stored.load(spark.createDataFrame([(1, "c")], "k int, v string"), dates.as_of_date("2024-01-01")) == {"open": 1, "closed": 0}

    def dies(*_):
        raise OSError("lost")

    was = values(stored.versions(spark), *columns)
    monkeypatch.setattr("tenura.sources.stored_history.publish", dies)
    with pytest.raises(OSError):
        stored.load(spark.createDataFrame([(1, "z")], "k int, v string"), dates.as_of_date("2025-01-01"))
    assert values(stored.versions(spark), *columns) == was


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 6), (2, None, None), (None, "z", -1), (None, "z", 3)], "k int, s string, n int"
    )
    parent = spark.createDataFrame([(1,)], "id int")
    report = quality.combine(
        [
            quality.unique(df, "t", ["k"]),
            quality.primary_key(df, "t", ["k"]),
            quality.references(df, parent, "k", "id", "t"),
            quality.minimum_rows(df, "t", 7),
            quality.required_columns(df, "t", ["k", "x", "y"]),
            quality.row_checks(
                df,
                "t",
                [
                    quality.not_null("s"),
                    quality.accepted_values("s", ["a", "b"]),
                    quality.in_range("n", 1, 5),
                    quality.non_negative("n"),
                    quality.max_length("s", 0),
                    quality.implies(F.col("s") == "z", "n", [3]),
                ],
            ),
        ]
    )
    failing = {r["check"]: r["failing_rows"] for r in report.collect()}
    assert failing == {
        "unique": 1,
        "primary_key": 3,
        "references": 1,
        "minimum_rows": 2,
        "required_columns": 2,
        "not_null": 1,
        "accepted_values": 2,
        "in_range": 2,
        "non_negative": 1,
        "max_length": 4,
        "implies": 1,
    }
    with pytest.raises(ValueError, match="in_range"):
        quality.gate(report)
    quality.gate(report.filter("passed"))


def test_quality_on_empty_input(spark):
    empty = spark.createDataFrame([], "k int")
    report = quality.combine(
        [
            quality.unique(empty, "t", ["k"]),
            quality.primary_key(empty, "t", ["k"]),
            quality.references(empty, empty, "k", "k", "t"),
            quality.row_checks(empty, "t", [quality.not_null("k")]),
        ]
    )
    assert report.count() == 4
    quality.gate(report)


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    else:
        assert shared_folder(spark) == spark.sparkContext.getCheckpointDir()
        assert shared_folder(spark) == shared_folder(spark)


def test_materialize_is_read_back_from_files(spark):
    stored = materialize(spark.range(10).withColumn("x", F.rand()), "test")
    assert stored.inputFiles() and sorted(stored.collect()) == sorted(stored.collect())


class _Session:
    """A session without spark.checkpoint.dir."""

    def __init__(self, master):
        self.sparkContext, self.conf, self.master, self.folder = self, self, master, None

    def get(self, name, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))
    local = _Session("local[2]")
    assert shared_folder(local) == local.folder and shared_folder(local) == local.folder
