"""Extracts, dimensions, facts, models and the loaded warehouse on the small company."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from people import company
from tenura import schemas
from tenura.operators import aggregates, quality
from tenura.operators.keys import surrogate_keys
from tenura.plans import dimensions, extract, facts, models, staging, warehouse
from tenura.settings import Limits
from tenura.sources import appends, publish, readers, writers

AS_OF = "2024-01-01"
SPLIT = Limits(max_group_rows=0)


@pytest.fixture(scope="module")
def source(spark):
    return company(spark)


@pytest.fixture(scope="module")
def extracts(source):
    return extract.extract_all(source)


def by(df, key):
    rows = df.collect()
    result = {r[key]: r for r in rows}
    assert len(result) == len(rows)
    return result


def test_extract_joins_and_defaults(extracts):
    people = by(extracts["employees"], "employee_id")
    assert (people[1]["department_name"], people[1]["location"]) == ("Engineering", "NYC")
    assert people[4]["department_name"] is None and people[5]["department_name"] is None
    places = by(extracts["departments"], "department_id")
    assert [places[i]["manager_name"] for i in (1, 2, 3)] == ["Ann Lee", "Cyd Fox", None]
    leaves = by(extracts["leaves"], "leave_id")
    assert {k: r["leave_days"] for k, r in leaves.items()} == {1: 10, 2: 15, 4: 2}
    profile = {r["table"]: (r["row_count"], r["column_count"]) for r in extract.extract_profile(extracts).collect()}
    assert profile["employees"] == (5, 12) and profile["leaves"] == (3, 8)


def test_extracts_sort_on_request(source):
    ids = [r["employee_id"] for r in extract.employees(source["employees"], source["departments"], True).collect()]
    assert ids == sorted(ids)
    days = [(r["employee_id"], r["effective_date"]) for r in extract.salaries(source["salaries"], True).collect()]
    assert days == sorted(days)


def test_dim_employee_columns_names_and_nulls(extracts):
    dim = dimensions.dim_employee(extracts["employees"], AS_OF)
    required = ["employee_id", "full_name", "email", "job_title", "hire_date", "status", "tenure_years", "is_current"]
    assert quality.missing_columns(dim, required) == []
    rows = by(dim, "employee_id")
    assert rows[1]["full_name"] == "Ann Lee" and rows[2]["job_title"] == "Unknown"
    assert rows[4]["department_name"] == "Unknown"
    assert rows[1]["tenure_years"] == round((date(2024, 1, 1) - date(2020, 1, 1)).days / 365, 2)
    assert rows[1]["tenure_years"] >= 0 and rows[4]["tenure_years"] < 0
    assert rows[1]["effective_date"] == date(2015, 1, 1) and rows[1]["expiry_date"] == date(9999, 12, 31)
    assert dim.select(F.countDistinct("employee_id")).first()[0] == dim.count()


def test_dim_employee_null_name_part_gives_null(extracts):
    broken = extracts["employees"].withColumn("last_name", F.lit(None).cast("string"))
    assert {r["full_name"] for r in dimensions.dim_employee(broken, AS_OF).collect()} == {None}


def test_dim_date(spark):
    year = dimensions.dim_date(spark, 2024, 2024)
    assert year.count() == 366 and {r["year"] for r in year.select("year").distinct().collect()} == {2024}
    weekend = quality.implies(F.col("is_weekend"), "day_of_week", [6, 7])
    assert quality.row_checks(year, "dim_date", [weekend]).first()["passed"]
    assert dimensions.dim_date(spark).count() == 4383
    days = by(dimensions.dim_date(spark, 2021, 2021), "date_key")
    third = days[20210103]
    assert (third["week_of_year"], third["day_of_week"], third["day_name"]) == (53, 7, "Sunday")
    assert (third["quarter_name"], third["month_name"], third["is_weekend"]) == ("Q1 2021", "January", True)


def test_dim_leave_type(spark):
    rows = by(dimensions.dim_leave_type(spark), "leave_type")
    assert len(rows) == 5 and not rows["unpaid"]["is_paid"] and rows["sick"]["category"] == "medical"
    assert sorted(r["leave_type_key"] for r in rows.values()) == [1, 2, 3, 4, 5]


def test_dim_department_and_project(extracts):
    places = by(dimensions.dim_department(extracts["departments"]), "department_id")
    assert places[3]["manager_name"] == "Not Assigned" and places[2]["location"] == "Unknown"
    projects = by(dimensions.dim_project(extracts["projects"]), "project_id")
    assert projects[1]["duration_days"] == 60 and projects[2]["duration_days"] is None
    assert projects[2]["department_name"] == "Unknown"


def test_staged_dimensions(source):
    people = staging.stg_employees(source["employees"], AS_OF)
    places = staging.stg_departments(source["departments"])
    assert by(people, "employee_id")[1]["email"] == "ann@x.com"
    counted = by(dimensions.dim_departments(places, people, AS_OF), "department_id")
    assert {k: r["headcount"] for k, r in counted.items()} == {1: 2, 2: 1, 3: 0}
    assert counted[3]["manager_name"] == "Not Assigned" and counted[1]["manager_name"] == "Ann Lee"
    dim = by(dimensions.dim_employees(people, places, AS_OF), "employee_id")
    assert dim[3]["location"] == "Unknown" and dim[5]["location"] is None
    assert dim[1]["effective_date"] == date(2024, 1, 1)


def test_staging_filters(source):
    nameless = source["employees"].withColumn("email", F.when(F.col("employee_id") != 2, F.col("email")))
    assert 2 not in by(staging.stg_employees(nameless, AS_OF), "employee_id")
    paid = by(staging.stg_salaries(source["salaries"]), "salary_id")
    assert 6 not in paid and not paid[1]["is_current"] and paid[2]["is_current"]


@pytest.mark.parametrize("limits", [Limits(), SPLIT], ids=["plain", "split"])
def test_fact_measures_defaults_and_fan_out(source, extracts, limits):
    keys = surrogate_keys(source["employees"], ["employee_id"], "employee_key")
    places = surrogate_keys(source["departments"], ["department_id"], "department_key")
    fact = facts.fact_employee_snapshot(
        extracts["employees"], extracts["salaries"], extracts["reviews"], extracts["leaves"],
        extracts["emp_projects"], keys, places, AS_OF, limits=limits,
    )
    rows = sorted(fact.collect(), key=lambda r: (r["employee_key"], r["salary_amount"]))
    assert [r["employee_key"] for r in rows] == [1, 2, 2, 3, 4, 5]  # two open salaries fan out
    ann, bob, _, cyd, dee, eve = rows
    assert (float(ann["salary_amount"]), ann["performance_rating"], ann["leave_days_taken"]) == (120.0, 5.0, 25)
    assert ann["project_count"] == 2 and ann["is_active"] and ann["date_key"] == 20240101
    assert bob["performance_rating"] == 4.0  # equal dates: the higher review id is the latest
    assert cyd["performance_rating"] == 0.0 and not cyd["is_active"]
    assert dee["department_key"] is None and dee["project_count"] == 0 and dee["leave_days_taken"] == 0
    assert float(eve["salary_amount"]) == 0.0 and eve["is_active"] is False


def test_fact_average_rating(source, extracts):
    keys = surrogate_keys(source["employees"], ["employee_id"], "employee_key")
    places = surrogate_keys(source["departments"], ["department_id"], "department_key")
    args = [extracts[n] for n in ("employees", "salaries", "reviews", "leaves", "emp_projects")]
    fact = facts.fact_employee_snapshot(*args, keys, places, AS_OF, rating="avg")
    rated = {r["employee_key"]: r["performance_rating"] for r in fact.collect()}
    assert rated == {1: 3.5, 2: 3.5, 3: 0.0, 4: 4.0, 5: 0.0}
    with pytest.raises(ValueError):
        facts.fact_employee_snapshot(*args, keys, places, AS_OF, rating="best")


@pytest.mark.parametrize("limits", [Limits(), SPLIT], ids=["plain", "split"])
def test_staged_fact(source, limits):
    people, places = staging.stg_employees(source["employees"], AS_OF), staging.stg_departments(source["departments"])
    fact = facts.fct_employee_snapshot(
        people, places, staging.stg_salaries(source["salaries"]), source["performance_reviews"],
        source["leave_requests"], source["employee_projects"], AS_OF, limits,
    )
    rows = sorted(fact.collect(), key=lambda r: (r["employee_id"], r["current_salary"]))
    assert [r["employee_id"] for r in rows] == [1, 2, 2, 3, 4, 5]
    assert rows[0]["avg_performance_rating"] == 3.5 and str(rows[0]["last_review_date"]) == "2023-12-15"
    assert float(rows[4]["current_salary"]) == 0 and rows[4]["currency"] is None  # a zero salary is not staged
    assert rows[3]["total_leave_days"] == 0 and rows[0]["total_leave_days"] == 25


def test_monthly_snapshot(source):
    monthly = facts.monthly_snapshot(
        source["employees"], source["salaries"], source["leave_requests"], "2020-11-15", "2021-02-27"
    )
    ann = {r["date_key"]: r for r in monthly.filter("employee_id = 1").collect()}
    assert {k: float(r["salary_amount"]) for k, r in ann.items()} == {20201130: 100, 20201231: 100, 20210131: 120}
    bob = monthly.filter("employee_id = 2").collect()
    assert len(bob) == 6  # three months, two open salaries
    assert monthly.filter("employee_id = 4").count() == 0  # hired later


@pytest.mark.parametrize("limits", [Limits(), SPLIT], ids=["plain", "split"])
def test_warehouse_build_load_and_gate(spark, source, tmp_path, limits):
    loaded = warehouse.build_warehouse(
        spark, source, str(tmp_path / "wh"), AS_OF, 2024, 2024, minimum_rows={"dim_date": 365}, limits=limits
    )
    fact = loaded["fact_employee_snapshot"]
    assert fact.columns == [f.name for f in schemas.schema_of("fact_employee_snapshot")]
    assert sorted(r["snapshot_id"] for r in fact.collect()) == [1, 2, 3, 4, 5, 6]
    assert {r["source_system"] for r in fact.collect()} == {"hr_postgresql"}
    assert by(loaded["dim_employee"], "employee_key")[3]["employee_id"] == 3
    assert all(r["load_timestamp"] is not None for r in fact.collect())
    broken = warehouse.warehouse_checks(loaded).filter("not passed").collect()
    assert broken == []
    orphaned = {**loaded, "dim_department": loaded["dim_department"].filter("department_id <> 1")}
    failed = warehouse.warehouse_checks(orphaned).filter("not passed").collect()
    assert [(r["table"], r["columns"], r["failing_rows"]) for r in failed] == [
        ("fact_employee_snapshot", "department_key", 3)
    ]
    again = warehouse.build_warehouse(
        spark, source, str(tmp_path / "wh"), AS_OF, 2024, 2024, minimum_rows={"dim_date": 365}, limits=limits
    )
    assert again["fact_employee_snapshot"].count() == 6  # a full refresh, not an append
    with pytest.raises(ValueError, match="dim_employee"):
        quality.gate(warehouse.minimum_row_report(again, warehouse.MINIMUM_ROWS))


def test_fact_is_stored_before_it_is_sorted(spark, source, tmp_path, monkeypatch):
    number, plans = warehouse.number_rows, []

    def watched(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return number(df, *args)

    monkeypatch.setattr(warehouse, "number_rows", watched)
    warehouse.build_warehouse(spark, source, str(tmp_path / "w"), AS_OF, 2024, 2024, minimum_rows={})
    assert len(plans) == 1 and "Join" not in plans[0] and "Aggregate" not in plans[0]


def test_warehouse_of_empty_sources_reaches_the_gate(spark, tmp_path):
    empty = {table: schemas.empty_table(spark, table) for table in schemas.SOURCE_TABLES}
    with pytest.raises(ValueError, match="minimum_rows"):
        warehouse.build_warehouse(spark, empty, str(tmp_path / "w"), "2027-03-01")
    with pytest.raises(ValueError, match="no warehouse has been published"):
        warehouse.read_warehouse(spark, str(tmp_path / "w"))
    (version,) = [f.name for f in (tmp_path / "w" / "versions").iterdir()]
    loaded = publish.read_version(spark, str(tmp_path / "w"), version)
    assert loaded["fact_employee_snapshot"].isEmpty()
    assert loaded["dim_date"].filter("year = 2027").count() == 365


def rows_of(tables):
    return {name: sorted(map(str, df.drop("load_timestamp").collect())) for name, df in tables.items()}


def test_failing_gate_leaves_the_published_warehouse(spark, source, tmp_path):
    folder = str(tmp_path / "w")
    build = lambda tables, least: warehouse.build_warehouse(spark, tables, folder, AS_OF, 2024, 2024, minimum_rows=least)
    before = rows_of(build(source, {"dim_date": 365}))
    fewer = {**source, "employees": source["employees"].filter("employee_id < 3")}
    with pytest.raises(ValueError, match="dim_employee.minimum_rows"):
        build(fewer, {"dim_employee": 5})
    assert rows_of(warehouse.read_warehouse(spark, folder)) == before
    after = rows_of(build(fewer, {"dim_employee": 2}))
    assert rows_of(warehouse.read_warehouse(spark, folder)) == after != before
    log = publish.publications(spark, folder).orderBy("number").collect()
    assert [r["number"] for r in log] == [1, 2]
    assert {t["table"]: t["row_count"] for t in log[1]["tables"]} == {name: len(rows) for name, rows in after.items()}
    publish.publish(spark, folder, log[0]["version"], {})
    assert rows_of(warehouse.read_warehouse(spark, folder)) == before


def test_load_that_dies_between_two_tables(spark, source, tmp_path, monkeypatch):
    folder = str(tmp_path / "w")
    build = lambda: warehouse.build_warehouse(spark, source, folder, AS_OF, 2024, 2024, minimum_rows={})
    before = rows_of(build())
    write, written = publish.write_table, []

    def dies(df, path, **options):
        if len(written) == 3:
            raise KeyboardInterrupt
        written.append(path)
        return write(df, path, **options)

    monkeypatch.setattr(publish, "write_table", dies)
    with pytest.raises(KeyboardInterrupt):
        build()
    assert len(written) == 3 and rows_of(warehouse.read_warehouse(spark, folder)) == before
    monkeypatch.undo()
    assert rows_of(build()) == before and publish.publications(spark, folder).count() == 2


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    """Of two publications with the same number readers agree on one, and the other load is told."""
    folder = str(tmp_path / "w")
    publish.publish(spark, folder, "v-b", {})
    before = publish.publications(spark, folder).collect()
    real, calls = publish.publications, []

    def stale(spark, directory):
        calls.append(1)
        return spark.createDataFrame([], publish.MANIFEST_SCHEMA) if len(calls) == 1 else real(spark, directory)

    monkeypatch.setattr(publish, "publications", stale)
    with pytest.raises(RuntimeError, match="another load"):
        publish.publish(spark, folder, "v-a", {})
    monkeypatch.undo()
    assert publish.current_version(spark, folder) == "v-b" and len(before) == 1


def test_keys_go_on_counting(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(40)]), rng.choice("abc")) for _ in range(400)]
    frame = spark.createDataFrame(rows, "id int, kind string").repartition(5)
    batches = [frame.filter("kind = 'a'"), frame.filter("kind <> 'c'"), frame.filter("kind = 'a'"), frame, frame.limit(0)]
    path, known = str(tmp_path / "keys"), {}
    for batch in batches:
        found = appends.extend_key_map(batch, ["id", "kind"], "key", path).collect()
        keys = {(r["id"], r["kind"]): r["key"] for r in found}
        assert len(found) == len(keys) and sorted(keys.values()) == list(range(1, len(keys) + 1))
        assert keys.items() >= known.items() and {tuple(r) for r in batch.distinct().collect()} <= set(keys)
        known = keys
    assert set(known) == set(rows)


def test_appended_rows_are_numbered_behind_the_stored_ones(spark, tmp_path):
    path = str(tmp_path / "facts")
    for low in (0, 50, 100):
        appends.append_numbered(spark.range(low, low + 50).repartition(3), ["id"], "n", path)
    assert {r["id"]: r["n"] for r in spark.read.parquet(path).collect()} == {i: i + 1 for i in range(150)}


def test_refreshed_months(spark, tmp_path):
    """Only missing and touched months are computed, and the stored rows equal a full computation."""
    day = lambda text: date.fromisoformat(text)
    people = [(i, "active", day("2020-01-15"), day("2020-01-15"), day("2020-01-15")) for i in (1, 2)]
    pay = [(1, 100, day("2020-01-15"), None, day("2020-01-15")), (2, 70, day("2020-01-15"), None, day("2020-01-15"))]
    away = [(1, "approved", day("2020-02-03"), day("2020-02-06"), day("2020-02-03"))]

    def frames(people, pay, away):
        return (
            spark.createDataFrame(people, "employee_id int, status string, hire_date date, created_at date, updated_at date"),
            spark.createDataFrame(pay, "employee_id int, amount int, effective_date date, end_date date, created_at date"),
            spark.createDataFrame(away, "employee_id int, status string, start_date date, end_date date, created_at date"),
        )

    path = str(tmp_path / "m")

    def refresh(tables, last, taken):
        months = facts.refresh_monthly_snapshot(*tables, "2020-01-01", last, path, taken)
        stored = spark.read.parquet(f"{path}/rows")
        full = facts.monthly_snapshot(*tables, "2020-01-01", last)
        assert sorted(map(str, stored.select(full.columns).collect())) == sorted(map(str, full.collect()))
        return [str(m) for m in months]

    first = frames(people, pay, away)
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "m").rglob("*.parquet")}
    assert refresh(first, "2020-04-30", "2020-04-30") == ["2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30"]
    written = files()
    assert refresh(first, "2020-04-30", "2020-04-30") == [] and files() == written
    assert refresh(first, "2020-06-30", "2020-06-30") == ["2020-05-31", "2020-06-30"]
    raised = [(1, 100, day("2020-01-15"), day("2020-05-09"), day("2020-01-15")), pay[1], (1, 120, day("2020-05-10"), None, day("2020-07-01"))]
    later = [*away, (2, "approved", day("2020-03-01"), day("2020-03-09"), day("2020-07-02"))]
    before = files()
    assert refresh(frames(people, raised, later), "2020-06-30", "2020-07-05") == ["2020-03-31", "2020-05-31", "2020-06-30"]
    kept = {f for f in before if "date_key=20200131" in str(f) or "date_key=20200229" in str(f) or "date_key=20200430" in str(f)}
    assert len(kept) >= 3 and all(files()[f] == before[f] for f in kept)
    changed = [people[0], (2, "terminated", day("2020-01-15"), day("2020-01-15"), day("2020-07-06"))]
    assert len(refresh(frames(changed, raised, later), "2020-06-30", "2020-07-07")) == 6


def test_key_checks_in_one_scan(spark):
    rows = [(1, "a", None), (1, "b", 2), (None, "a", 2), (2, "b", 2), (3, None, 4)]
    frame = spark.createDataFrame(rows, "id int, name string, other int")
    checks = [("primary_key", ["id"]), ("unique", ["name"]), ("unique", ["name", "other"]), ("primary_key", ["other"]), ("unique", ["id"])]
    alone = {"primary_key": quality.primary_key, "unique": quality.unique}
    for df in (frame, frame.limit(0)):
        got = quality.key_checks(df, "t", checks)
        want = quality.combine([alone[check](df, "t", keys) for check, keys in checks])
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = quality.key_checks(frame, "t", checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_distinct_sketches_unite(spark):
    frame = spark.range(60_000).selectExpr("id % 20000 AS value", "id % 7 AS part").unionAll(spark.createDataFrame([(None, 1)], "value long, part long"))
    sketches = aggregates.distinct_sketches(frame, ["part"], "value")
    whole = aggregates.united_count(sketches).first()[0]
    assert abs(whole - 20_000) <= aggregates.sketch_error() * 20_000
    assert sketches.count() == 7 and aggregates.united_count(sketches, ["part"]).count() == 7


def test_warehouse_gates_the_keys_of_the_fact(spark, source, tmp_path):
    with pytest.raises(ValueError, match="references.date_key"):
        warehouse.build_warehouse(spark, source, str(tmp_path / "w"), "2024-01-01", 2015, 2020, minimum_rows={"dim_date": 1})


def test_models_as_views_tables_and_checks(spark, source, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    one_salary = source["salaries"].filter("salary_id <> 3")
    built = models.build_models(spark, {**source, "salaries": one_salary}, str(tmp_path / "m"), AS_OF, "mart")
    assert spark.table("mart.fct_employee_snapshot").count() == 5
    assert spark.sql("SELECT count(*) FROM stg_salaries").first()[0] == 4
    report = models.model_checks(built)
    assert report.count() == 13
    quality.gate(report.filter("columns <> 'status'"))
    fan_out = models.build_models(spark, source, str(tmp_path / "m2"), AS_OF)
    failed = {(r["table"], r["check"]) for r in models.model_checks(fan_out).filter("not passed").collect()}
    assert failed == {("fct_employee_snapshot", "unique")}


def test_source_checks_find_the_planted_errors(source):
    failed = {
        (r["table"], r["check"], r["columns"]): r["failing_rows"]
        for r in warehouse.source_checks(source).filter("not passed").collect()
    }
    assert failed == {
        ("employees", "references", "department_id"): 1,
        ("employees", "references", "manager_id"): 1,
        ("projects", "references", "department_id"): 1,
    }


def test_empty_schemas_and_defaults(spark, tmp_path):
    created = writers.create_source_schema(spark, "hr_source", str(tmp_path / "src"))
    writers.create_source_schema(spark, "hr_source", str(tmp_path / "src2"))
    writers.create_warehouse_schema(spark, "hr_wh", str(tmp_path / "wh"))
    writers.create_warehouse_schema(spark, "hr_wh", str(tmp_path / "wh"))
    assert len(created) == 7 and spark.table("hr_source.salaries").count() == 0
    assert spark.table("hr_wh.fact_employee_snapshot").schema["salary_amount"].dataType.simpleString() == "decimal(12,2)"
    one = spark.createDataFrame([(1, 7, "12.345", None)], "salary_id int, employee_id int, amount string, currency string")
    row = schemas.conform(one, "salaries").first()
    assert (float(row["amount"]), row["currency"], row["end_date"]) == (12.35, "USD", None)
    assert row["created_at"] is not None


def test_csv_round_trip_with_declared_schema(spark, source, tmp_path):
    paths = writers.export_tables(source, str(tmp_path / "csv"))
    for table, path in paths.items():
        back = readers.read_csv(spark, path, table)
        assert back.schema == schemas.schema_of(table)
        assert sorted(map(str, back.collect())) == sorted(map(str, source[table].collect()))


def test_single_file_report(spark, tmp_path):
    report = spark.range(100).repartition(4)
    one = writers.export_csv(report, str(tmp_path / "one"), one_file=True)
    many = writers.export_csv(report, str(tmp_path / "many"))
    parts = lambda p: len([f for f in __import__("os").listdir(p) if f.startswith("part")])
    assert parts(one) == 1 and parts(many) == 4


def test_read_source_tables(spark, source, tmp_path):
    for table, df in source.items():
        df.write.parquet(str(tmp_path / f"{table}.parquet"))
    tables = readers.read_source_tables(spark, str(tmp_path))
    assert tables["employees"].count() == 5 and tables["salaries"].schema == schemas.schema_of("salaries")


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:postgresql://h/db", "employees", {"user": "u"})
    assert plain["dbtable"] == "employees" and "numPartitions" not in plain
    split = readers.jdbc_options("jdbc:postgresql://h/db", "t", None, "employee_id", 1, 1000, 8)
    assert split["partitionColumn"] == "employee_id" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:postgresql://h/db", "t", None, "employee_id")
