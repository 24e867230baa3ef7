"""Scalar functions, filters, aggregates, history and key patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenura.functions import dates, names, rules
from tenura.operators import aggregates, history, joins, keys
from tenura.plans.dimensions import date_attributes
from tenura.settings import new_path
from tenura.sources.stored_history import StoredHistory
from workload.registry import query
from workload.roles import AS_OF

# a band list for the words that occur in part names
PART_BANDS = {"ring": (10, 20), "small": (20, 30), "Widget": (30, 40), "hot": (40, 50), "BOLT": (50, 60)}
PART_DEFAULT = (0, 10)


@query(
    "name_concat_variants",
    "employees",
    """SELECT employee_id, concat_ws(' ', first_name, last_name) AS skip_nulls,
    concat(first_name, ' ', last_name) AS empty_nulls, first_name || ' ' || last_name AS any_null FROM employees""",
)
def _(r):
    return r.employees.select(
        "employee_id",
        names.full_name().alias("skip_nulls"),
        names.full_name(nulls="empty").alias("empty_nulls"),
        names.full_name(nulls="any").alias("any_null"),
    )


@query(
    "rounding_variants",
    "",
    """, cents AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
    SELECT o_orderkey, CAST((c + 5) // 10 AS DOUBLE) / 10 AS half_up,
    CAST(CASE WHEN c % 10 = 5 THEN CASE WHEN (c // 10) % 2 = 0 THEN c // 10 ELSE c // 10 + 1 END
              ELSE (c + 5) // 10 END AS DOUBLE) / 10 AS half_even
    FROM cents""",
)
def _(r):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return r.table("orders").select(
        "o_orderkey", F.round(price, 1).alias("half_up"), F.bround(price, 1).alias("half_even")
    )


@query(
    "scalar_functions",
    "",
    """SELECT c_custkey, lower(c_name) AS lower_name, contains(lower(c_mktsegment), 'build') AS is_building,
    coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), 'Unknown') AS segment, CAST(floor(c_acctbal) AS INTEGER) AS whole,
    'N' || c_nationkey AS nation_label, c_acctbal >= 0 AS in_credit, least(c_nationkey + 1, 3) AS capped,
    CAST(strftime(DATE '2000-01-31' + c_nationkey, '%Y-%m-%d') AS VARCHAR) AS shifted
    FROM customer""",
)
def _(r):
    return r.table("customer").select(
        "c_custkey",
        F.lower("c_name").alias("lower_name"),
        F.lower("c_mktsegment").contains("build").alias("is_building"),
        F.coalesce(F.nullif("c_mktsegment", F.lit("HOUSEHOLD")), F.lit("Unknown")).alias("segment"),
        F.floor("c_acctbal").cast("int").alias("whole"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("nation_label"),
        (F.col("c_acctbal") >= 0).alias("in_credit"),
        F.least(F.col("c_nationkey") + 1, F.lit(3)).alias("capped"),
        F.date_add(F.lit("2000-01-31").cast("date"), F.col("c_nationkey")).alias("shifted"),
    )


@query(
    "date_functions",
    "",
    f"""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
    'Q' || quarter(o_orderdate) || ' ' || year(o_orderdate) AS quarter_name, isodow(o_orderdate) AS day_of_week,
    weekofyear(o_orderdate) AS week_of_year, monthname(o_orderdate) AS month_name,
    CAST(DATE '{AS_OF}' - CAST(o_orderdate AS DATE) AS INTEGER) AS age_days,
    CAST((DATE '{AS_OF}' - CAST(o_orderdate AS DATE)) // 365 AS INTEGER) AS age_years,
    round((DATE '{AS_OF}' - CAST(o_orderdate AS DATE)) / 365, 2) AS tenure_years
    FROM orders""",
)
def _(r):
    day = F.col("day")
    as_of = dates.as_of_date(AS_OF)
    rows = r.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return rows.select(
        "o_orderkey",
        dates.date_key(day).alias("date_key"),
        dates.quarter_label(day).alias("quarter_name"),
        dates.iso_weekday(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        dates.days_between(day, as_of).alias("age_days"),
        dates.whole_years(day, as_of).alias("age_years"),
        dates.tenure_years(day, as_of).alias("tenure_years"),
    )


@query(
    "date_attributes",
    "",
    """SELECT DISTINCT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(ts AS DATE) AS VARCHAR) AS full_date,
    year(ts) AS year, quarter(ts) AS quarter, 'Q' || quarter(ts) || ' ' || year(ts) AS quarter_name, month(ts) AS month,
    monthname(ts) AS month_name, weekofyear(ts) AS week_of_year, isodow(ts) AS day_of_week, dayname(ts) AS day_name,
    isodow(ts) > 5 AS is_weekend, false AS is_holiday FROM events""",
)
def _(r):
    days = r.table("events").select(F.col("ts").cast("date").alias("full_date")).distinct()
    return date_attributes(days)


@query(
    "parse_dates",
    "",
    """SELECT o_orderkey, CAST(try_cast(CASE WHEN o_orderstatus = 'P' THEN 'n/a ' ELSE '' END
      || strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS VARCHAR) AS parsed FROM orders""",
)
def _(r):
    prefix = F.when(F.col("o_orderstatus") == "P", "n/a ").otherwise("")
    text = F.concat(prefix, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return r.table("orders").select("o_orderkey", dates.parse_date(text).alias("parsed"))


@query(
    "filter_project",
    "employees",
    f"""SELECT employee_id AS id, coalesce(job_title, 'Unknown') AS job_title, coalesce(job_title = 'FURNITURE', false)
    AS in_furniture, DATE '{AS_OF}' - hire_date AS days_employed FROM employees
    WHERE employee_id IS NOT NULL AND email IS NOT NULL AND department_id IN (1, 2, 3, 5, 8, 13) AND status = 'active'""",
)
def _(r):
    kept = r.employees.filter(
        F.col("employee_id").isNotNull()
        & F.col("email").isNotNull()
        & F.col("department_id").isin(1, 2, 3, 5, 8, 13)
        & (F.col("status") == "active")
    )
    return kept.select(
        F.col("employee_id").alias("id"),
        names.or_default("job_title", "Unknown"),
        rules.equals_flag("job_title", "FURNITURE").alias("in_furniture"),
        dates.days_between(F.col("hire_date"), dates.as_of_date(AS_OF)).alias("days_employed"),
    )


@query(
    "whole_years",
    "employees",
    f"""SELECT employee_id, CAST((DATE '{AS_OF}' - hire_date) // 365 AS INTEGER) AS years,
    CAST(least((DATE '{AS_OF}' - hire_date) // 365 + 1, 3) AS INTEGER) AS pay_steps,
    CAST(least((DATE '{AS_OF}' - hire_date) // 365, 5) AS INTEGER) AS review_years FROM employees""",
)
def _(r):
    years = dates.whole_years(F.col("hire_date"), dates.as_of_date(AS_OF))
    return r.employees.select(
        "employee_id",
        years.alias("years"),
        F.least(years + 1, F.lit(3)).alias("pay_steps"),
        F.least(years, F.lit(5)).alias("review_years"),
    )


@query(
    "rule_score",
    "employees",
    """SELECT employee_id, score, CASE WHEN score >= 4 THEN 'HIGH' WHEN score >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS level
    FROM (SELECT employee_id, (CASE WHEN job_title = 'FURNITURE' THEN 3 ELSE 0 END)
      + (CASE WHEN department_id > 12 THEN 2 ELSE 0 END) + (CASE WHEN first_name < 'H' THEN 1 ELSE 0 END) AS score
    FROM employees)""",
)
def _(r):
    score = rules.rule_score(
        [(F.col("job_title") == "FURNITURE", 3), (F.col("department_id") > 12, 2), (F.col("first_name") < "H", 1)]
    )
    scored = r.employees.select("employee_id", score.alias("score"))
    return scored.withColumn("level", rules.level_of(F.col("score"), [(4, "HIGH"), (2, "MEDIUM")], "LOW"))


@query(
    "keyword_band",
    "",
    """, words AS (SELECT * FROM (VALUES (1, 'ring', 10, 20), (2, 'small', 20, 30), (3, 'widget', 30, 40),
      (4, 'hot', 40, 50), (5, 'bolt', 50, 60)) w(pos, word, band_min, band_max)),
    hits AS (SELECT p_partkey, min(pos) AS pos FROM part JOIN words ON contains(lower(p_name), word) GROUP BY 1)
    SELECT p_partkey, p_name, coalesce(band_min, 0) AS band_min, coalesce(band_max, 10) AS band_max
    FROM part LEFT JOIN hits USING (p_partkey) LEFT JOIN words USING (pos)""",
)
def _(r):
    band = rules.keyword_band(F.col("p_name"), PART_BANDS, PART_DEFAULT)
    return r.table("part").select("p_partkey", "p_name", band.alias("band")).select("p_partkey", "p_name", "band.*")


@query("last_review_date", "reviews", "SELECT employee_id, CAST(max(review_date) AS VARCHAR) AS last_review_date FROM reviews GROUP BY 1")
def _(r):
    return r.reviews.groupBy("employee_id").agg(F.max("review_date").alias("last_review_date"))


@query("count_rows", "", "SELECT count(*) AS row_count FROM lineitem")
def _(r):
    return r.table("lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "distinct_count",
    "",
    "SELECT count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_count FROM lineitem",
)
def _(r):
    return aggregates.distinct_count(r.table("lineitem"), "l_orderkey")


@query(
    "filtered_aggregate",
    "leaves",
    """SELECT leave_type, count(*) AS requests, count(*) FILTER (WHERE status = 'approved') AS approved,
    CAST(coalesce(sum(end_date - start_date) FILTER (WHERE status = 'approved'), 0) AS BIGINT) AS approved_days
    FROM leaves GROUP BY 1""",
)
def _(r):
    approved = F.col("status") == "approved"
    return r.leaves.groupBy("leave_type").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count(F.when(approved, True)).alias("approved"),
        aggregates.sum_or_zero(F.when(approved, F.datediff("end_date", "start_date"))).alias("approved_days"),
    )


@query(
    "leave_days_by_employee",
    "leaves",
    """SELECT employee_id, CAST(sum(end_date - start_date) AS BIGINT) AS total_leave_days
    FROM leaves WHERE status = 'approved' GROUP BY 1""",
)
def _(r):
    return aggregates.leave_days(r.leaves)


@query(
    "sort_limit",
    "",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def _(r):
    return aggregates.top_n(
        r.table("orders").select("o_orderkey", "o_totalprice"), 20, F.desc("o_totalprice"), "o_orderkey"
    )


@query(
    "current_rows",
    "salaries",
    """SELECT salary_id, employee_id, CAST(amount AS DOUBLE) AS amount FROM salaries WHERE end_date IS NULL""",
)
def _(r):
    return history.current_rows(r.salaries).select("salary_id", "employee_id", "amount")


@query(
    "close_history",
    "",
    """SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS effective_date,
    CAST(CAST(min(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS DATE) - 1 AS VARCHAR) AS end_date FROM orders""",
)
def _(r):
    rows = r.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("effective_date"))
    return history.close_history(rows, "o_custkey", "effective_date", "o_orderkey")


@query(
    "group_leader",
    "employees",
    """, numbered AS (
      SELECT employee_id, department_id, row_number() OVER in_department AS nth,
             min(employee_id) OVER (PARTITION BY department_id) AS leader,
             count(*) OVER (PARTITION BY department_id) AS members
      FROM employees WINDOW in_department AS (PARTITION BY department_id ORDER BY employee_id))
    SELECT employee_id, leader AS manager_id FROM numbered WHERE members >= 2 AND nth BETWEEN 2 AND 20""",
)
def _(r):
    _, reporting = keys.group_leaders(r.employees.drop("manager_id"), "department_id", "employee_id", "manager_id", first_n=20)
    return reporting


@query(
    "department_leader",
    "employees departments",
    """SELECT d.department_id, department_name,
    CASE WHEN members >= 2 THEN leader ELSE manager_id END AS manager_id
    FROM departments d LEFT JOIN (SELECT department_id, min(employee_id) AS leader, count(*) AS members
      FROM employees GROUP BY 1) USING (department_id)""",
)
def _(r):
    leaders, _ = keys.group_leaders(r.employees.drop("manager_id"), "department_id", "employee_id", "manager_id", first_n=20)
    places = r.departments.select("department_id", "department_name", "manager_id")
    return joins.update_by_key(places, leaders, "department_id", "manager_id")


@query(
    "update_by_key",
    "employees",
    """, numbered AS (
      SELECT employee_id, row_number() OVER (PARTITION BY department_id ORDER BY employee_id) AS nth,
             min(employee_id) OVER (PARTITION BY department_id) AS leader FROM employees)
    SELECT e.employee_id, CASE WHEN nth BETWEEN 2 AND 20 THEN leader ELSE e.manager_id END AS manager_id, e.job_title
    FROM employees e JOIN numbered USING (employee_id)""",
)
def _(r):
    _, reporting = keys.group_leaders(r.employees.drop("manager_id"), "department_id", "employee_id", "manager_id", first_n=20)
    people = r.employees.select("employee_id", "manager_id", "job_title")
    return joins.update_by_key(people, reporting, "employee_id", "manager_id")


@query(
    "uniquify",
    "",
    """, named AS (SELECT c_custkey, c_nationkey,
      lower(c_mktsegment) || '.' || lower(n_name) || 'x@hr.com' AS base FROM customer JOIN nation ON c_nationkey = n_nationkey),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY c_custkey) - 1 AS n FROM named)
    SELECT c_custkey, base, CASE WHEN n = 0 THEN base ELSE replace(base, '@', n || '@') END AS email FROM numbered""",
)
def _(r):
    customers, nations = r.table("customer"), r.table("nation")
    base = F.concat(F.lower("c_mktsegment"), F.lit("."), F.lower("n_name"), F.lit("x@hr.com"))
    named = customers.join(nations, customers.c_nationkey == nations.n_nationkey).select("c_custkey", base.alias("base"))
    return keys.uniquify(named, "base", ["c_custkey"], "email", keys.suffix_before_at)


@query(
    "uniquify_colliding",
    "",
    """WITH RECURSIVE named AS (
      SELECT c_custkey, lower(c_mktsegment) || '.' || lower(n_name)
             || CASE WHEN c_custkey % 3 = 0 THEN (c_custkey % 5)::VARCHAR ELSE '' END AS base,
             row_number() OVER (ORDER BY c_custkey) AS turn FROM customer JOIN nation ON c_nationkey = n_nationkey),
    given AS (
      SELECT 0::BIGINT AS turn, NULL::BIGINT AS c_custkey, NULL::VARCHAR AS base, NULL::VARCHAR AS name, []::VARCHAR[] AS taken
      UNION ALL
      SELECT n.turn, n.c_custkey, n.base, free.name, list_append(g.taken, free.name)
      FROM given g JOIN named n ON n.turn = g.turn + 1,
      LATERAL (SELECT list_filter(
        [n.base] || list_transform(range(1, len(list_filter(g.taken, lambda t: starts_with(t, n.base))) + 1), lambda i: n.base || i),
        lambda t: NOT list_contains(g.taken, t))[1] AS name) free)
    SELECT c_custkey, base, name FROM given WHERE turn > 0""",
)
def _(r):
    """Names whose suffixed forms are themselves the base of other rows."""
    customers, nations = r.table("customer"), r.table("nation")
    digits = F.when(F.col("c_custkey") % 3 == 0, (F.col("c_custkey") % 5).cast("string")).otherwise("")
    base = F.concat(F.lower("c_mktsegment"), F.lit("."), F.lower("n_name"), digits)
    named = customers.join(nations, customers.c_nationkey == nations.n_nationkey).select("c_custkey", base.alias("base"))
    return keys.uniquify(named, "base", ["c_custkey"], "name")


@query(
    "distinct_pairs",
    "assignments",
    "SELECT employee_id, project_id, emp_project_id, role, CAST(assigned_date AS VARCHAR) AS assigned_date FROM assignments",
)
def _(r):
    return r.assignments


def priorities_before(r, day):
    """Each customer's latest order priority before a day, and how that order ended."""
    before = r.table("orders").filter(F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz"))
    newest = F.max_by(F.struct("o_orderpriority", "o_orderstatus"), F.struct("o_orderdate", "o_orderkey")).alias("last")
    return before.groupBy("o_custkey").agg(newest).select("o_custkey", "last.*")


def priorities_since(r, day):
    """Each customer's latest order priority from a day on, and how that order ended."""
    later = r.table("orders").filter(F.col("o_orderdate") >= F.lit(day).cast("timestamp_ntz"))
    newest = F.max_by(F.struct("o_orderpriority", "o_orderstatus"), F.struct("o_orderdate", "o_orderkey")).alias("last")
    return later.groupBy("o_custkey").agg(newest).select("o_custkey", "last.*")


SCD2_SQL = """, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
      FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
    old AS (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p,
                   arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s
            FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1),
    new AS (SELECT o_custkey, o_orderpriority AS p, o_orderstatus AS s FROM ranked WHERE nth = 1),
    pairs AS (SELECT old.o_custkey AS old_key, new.o_custkey AS new_key, old.p AS old_p, old.s AS old_s, new.p, new.s,
                     old.p IS DISTINCT FROM new.p OR old.s IS DISTINCT FROM new.s AS changed
              FROM old FULL JOIN new ON old.o_custkey = new.o_custkey)
    SELECT old_key AS o_custkey, old_p AS o_orderpriority, old_s AS o_orderstatus, '1996-01-01' AS effective_date,
           CASE WHEN changed THEN '2001-12-31' ELSE '9999-12-31' END AS expiry_date, NOT changed AS is_current
    FROM pairs WHERE old_key IS NOT NULL
    UNION ALL
    SELECT new_key, p, s, '2002-01-01', '9999-12-31', true FROM pairs
    WHERE new_key IS NOT NULL AND (old_key IS NULL OR changed)"""


@query("scd2_merge", "", SCD2_SQL)
def _(r):
    versions = history.scd2_columns(priorities_before(r, "1996-01-01"), dates.as_of_date("1996-01-01"))
    incoming = priorities_since(r, "1996-01-01")
    return history.scd2_merge(
        versions, incoming, "o_custkey", ["o_orderpriority", "o_orderstatus"], dates.as_of_date(AS_OF)
    )


@query("stored_history", "", SCD2_SQL)
def _(r):
    """The same history loaded into files, the last state twice."""
    first = priorities_before(r, "1996-01-01")
    stored = StoredHistory(new_path(r.spark, "history"), "o_custkey", first.schema)
    stored.load(first, dates.as_of_date("1996-01-01"))
    for _ in range(2):
        stored.load(priorities_since(r, "1996-01-01"), dates.as_of_date(AS_OF))
    return stored.versions(r.spark)
