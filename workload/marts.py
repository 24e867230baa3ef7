"""Dimensions, facts and surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenura.operators import aggregates, history
from tenura.operators.keys import attach_key, surrogate_keys
from tenura.plans import dimensions, extract, facts, staging
from tenura.settings import materialize, new_path
from workload.registry import query
from workload.roles import AS_OF

SCD2 = "'{effective}' AS effective_date, '9999-12-31' AS expiry_date, true AS is_current"
STAR_SCD2 = SCD2.format(effective="2015-01-01")
BUILD_SCD2 = SCD2.format(effective=AS_OF)

FACT = """
  SELECT employee_key, department_key, 20020101 AS date_key, 1 AS project_key,
         CAST(coalesce(amount, 0) AS DOUBLE) AS salary_amount, coalesce(rating, 0) AS performance_rating,
         CAST(coalesce(days, 0) AS INTEGER) AS leave_days_taken, CAST(coalesce(n, 0) AS INTEGER) AS project_count,
         status = 'active' AS is_active
  FROM employees
  LEFT JOIN (SELECT employee_id, row_number() OVER (ORDER BY employee_id) AS employee_key FROM employees)
    USING (employee_id)
  LEFT JOIN (SELECT department_id, row_number() OVER (ORDER BY department_id) AS department_key FROM departments)
    USING (department_id)
  LEFT JOIN (SELECT employee_id, amount FROM {salaries} WHERE end_date IS NULL) USING (employee_id)
  LEFT JOIN ({ratings}) USING (employee_id)
  LEFT JOIN (SELECT employee_id, sum(end_date - start_date) AS days FROM leaves
             WHERE status = 'approved' GROUP BY 1) USING (employee_id)
  LEFT JOIN (SELECT employee_id, count(project_id) AS n FROM assignments GROUP BY 1) USING (employee_id)"""
LATEST = """SELECT employee_id, CAST(arg_max(rating, (review_date, review_id)) AS DOUBLE) AS rating
  FROM reviews WHERE rating IS NOT NULL GROUP BY 1"""
MEAN = """SELECT employee_id, CAST(round(CAST(avg(rating) AS DECIMAL(28,12)), 1) AS DOUBLE) AS rating
  FROM reviews GROUP BY 1"""


def staged(r):
    return (
        staging.stg_employees(r.employees, AS_OF),
        staging.stg_departments(r.departments),
        staging.stg_salaries(r.salaries),
    )


def fact(r, salaries, rating):
    return facts.fact_employee_snapshot(
        r.employees,
        salaries,
        r.reviews,
        extract.approved_leaves(r.leaves),
        r.assignments,
        surrogate_keys(r.employees, ["employee_id"], "employee_key"),
        surrogate_keys(r.departments, ["department_id"], "department_key"),
        AS_OF,
        rating,
    )


@query(
    "dim_date",
    "",
    """, days AS (
      SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 DAY) t(d)),
    used AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS full_date, year(d) AS year,
           quarter(d) AS quarter, 'Q' || quarter(d) || ' ' || year(d) AS quarter_name, month(d) AS month,
           monthname(d) AS month_name, weekofyear(d) AS week_of_year, isodow(d) AS day_of_week,
           dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend, false AS is_holiday,
           coalesce(n, 0) AS salary_changes
    FROM days LEFT JOIN used USING (d)""",
)
def _(r):
    changes = r.salary_rows.groupBy(F.col("effective_date").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return (
        dimensions.dim_date(r.spark, 1995, 2002)
        .join(changes, "full_date", "left")
        .withColumn("salary_changes", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


@query(
    "dim_department",
    "departments employees",
    f"""SELECT d.department_id, department_name, coalesce(location, 'Unknown') AS location,
    CASE WHEN e.employee_id IS NULL THEN 'Not Assigned' ELSE concat(first_name, ' ', last_name) END AS manager_name,
    {STAR_SCD2}
    FROM departments d LEFT JOIN employees e ON d.manager_id = e.employee_id""",
)
def _(r):
    return dimensions.dim_department(extract.departments(r.departments, r.employees))


@query(
    "dim_employee",
    "employees departments",
    f"""SELECT employee_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email,
    coalesce(job_title, 'Unknown') AS job_title, coalesce(department_name, 'Unknown') AS department_name,
    CAST(hire_date AS VARCHAR) AS hire_date, status,
    round((DATE '{AS_OF}' - hire_date) / 365, 2) AS tenure_years, {STAR_SCD2}
    FROM employees LEFT JOIN departments USING (department_id)""",
)
def _(r):
    return dimensions.dim_employee(extract.employees(r.employees, r.departments), AS_OF)


@query(
    "dim_project",
    "projects departments",
    """SELECT project_id, project_name, coalesce(department_name, 'Unknown') AS department_name, status,
    CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
    CAST(budget AS DOUBLE) AS budget, CAST(end_date - start_date AS INTEGER) AS duration_days
    FROM projects LEFT JOIN departments USING (department_id)""",
)
def _(r):
    return dimensions.dim_project(extract.projects(r.projects, r.departments))


@query(
    "dim_leave_type",
    "leaves",
    """, kinds AS (
      SELECT * FROM (VALUES (1, 'annual', 'personal', true), (2, 'sick', 'medical', true),
        (3, 'maternity', 'parental', true), (4, 'paternity', 'parental', true), (5, 'unpaid', 'personal', false))
      k(leave_type_key, leave_type, category, is_paid))
    SELECT leave_type_key, leave_type, category, is_paid, count(leave_id) AS requests
    FROM kinds LEFT JOIN leaves USING (leave_type) GROUP BY ALL""",
)
def _(r):
    used = r.leaves.groupBy("leave_type").agg(F.count(F.lit(1)).alias("n"))
    types = dimensions.dim_leave_type(r.spark).join(used, "leave_type", "left")
    return types.withColumn("requests", F.coalesce("n", F.lit(0))).drop("n")


@query(
    "dim_employees_staged",
    "employees departments",
    f"""SELECT employee_id, first_name, last_name, concat(first_name, ' ', last_name) AS full_name,
    lower(email) AS email, job_title, CAST(hire_date AS VARCHAR) AS hire_date, status,
    round((DATE '{AS_OF}' - hire_date) / 365, 2) AS tenure_years, department_name,
    coalesce(location, 'Unknown') AS location, {BUILD_SCD2}
    FROM employees LEFT JOIN departments USING (department_id) WHERE email IS NOT NULL""",
)
def _(r):
    people, places, _ = staged(r)
    return dimensions.dim_employees(people, places, AS_OF)


@query(
    "dim_departments_headcount",
    "employees departments",
    f""", people AS (SELECT * FROM employees WHERE email IS NOT NULL)
    SELECT d.department_id, department_name, coalesce(d.location, 'Unknown') AS location,
    CASE WHEN m.employee_id IS NULL THEN 'Not Assigned' ELSE concat(m.first_name, ' ', m.last_name) END
      AS manager_name,
    count(e.employee_id) AS headcount, {BUILD_SCD2}
    FROM departments d LEFT JOIN people m ON d.manager_id = m.employee_id
    LEFT JOIN people e ON d.department_id = e.department_id
    GROUP BY d.department_id, department_name, d.location, m.employee_id, m.first_name, m.last_name""",
)
def _(r):
    people, places, _ = staged(r)
    return dimensions.dim_departments(places, people, AS_OF)


@query(
    "surrogate_keys",
    "work",
    """SELECT employee_id, project_id, row_number() OVER (ORDER BY employee_id, project_id) AS work_key
    FROM (SELECT DISTINCT employee_id, project_id FROM work)""",
)
def _(r):
    pairs = r.work.select("employee_id", "project_id").distinct()
    return surrogate_keys(pairs, ["employee_id", "project_id"], "work_key")


@query(
    "key_lookup",
    "salaries employees",
    """, keyed AS (SELECT employee_id, row_number() OVER (ORDER BY employee_id) AS employee_key FROM employees)
    SELECT salary_id, employee_id, employee_key FROM salaries LEFT JOIN keyed USING (employee_id)""",
)
def _(r):
    keys = surrogate_keys(r.employees, ["employee_id"], "employee_key")
    return attach_key(r.salary_rows.select("salary_id", "employee_id"), keys, ["employee_id"]).select(
        "salary_id", "employee_id", "employee_key"
    )


@query("latest_rating", "reviews", LATEST.replace("CAST(", "").replace(" AS DOUBLE) AS rating", " AS rating"))
def _(r):
    return facts.latest_rating(r.reviews, out="rating")


@query(
    "total_leave_days",
    "leaves",
    """SELECT employee_id, CAST(sum(end_date - start_date) AS BIGINT) AS leave_days_taken
    FROM leaves WHERE status = 'approved' GROUP BY 1""",
)
def _(r):
    return facts.total_leave_days(extract.approved_leaves(r.leaves))


@query(
    "project_count",
    "assignments",
    "SELECT employee_id, count(*) AS project_count FROM assignments GROUP BY 1",
)
def _(r):
    return facts.project_count(r.assignments)


@query(
    "fact_snapshot",
    "employees departments salaries reviews leaves assignments",
    FACT.format(salaries="salaries", ratings=LATEST),
)
def _(r):
    return fact(r, r.salaries, "latest")


@query(
    "fact_snapshot_avg_rating",
    "employees departments loose_salaries reviews leaves assignments",
    FACT.format(salaries="loose_salaries", ratings=MEAN),
)
def _(r):
    return fact(r, r.loose_salaries, "avg")


@query(
    "fct_employee_snapshot",
    "employees departments salaries reviews leaves assignments",
    f"""SELECT e.employee_id, concat(first_name, ' ', last_name) AS full_name, job_title,
    CAST(hire_date AS VARCHAR) AS hire_date, round((DATE '{AS_OF}' - hire_date) / 365, 2) AS tenure_years, status,
    e.department_id, department_name, coalesce(location, 'Unknown') AS location,
    CAST(coalesce(amount, 0) AS DOUBLE) AS current_salary, currency,
    coalesce(rating, 0) AS avg_performance_rating, CAST(last_day AS VARCHAR) AS last_review_date,
    CAST(coalesce(days, 0) AS BIGINT) AS total_leave_days, coalesce(n, 0) AS project_count,
    status = 'active' AS is_active, '{AS_OF}' AS snapshot_date
    FROM employees e LEFT JOIN departments d USING (department_id)
    LEFT JOIN (SELECT employee_id, amount, currency FROM salaries WHERE end_date IS NULL AND amount > 0) s
      USING (employee_id)
    LEFT JOIN (SELECT employee_id, max(review_date) AS last_day,
                      CAST(round(CAST(avg(rating) AS DECIMAL(28,12)), 1) AS DOUBLE) AS rating
               FROM reviews GROUP BY 1) r USING (employee_id)
    LEFT JOIN (SELECT employee_id, sum(end_date - start_date) AS days FROM leaves
               WHERE status = 'approved' GROUP BY 1) l USING (employee_id)
    LEFT JOIN (SELECT employee_id, count(project_id) AS n FROM assignments GROUP BY 1) p USING (employee_id)
    WHERE email IS NOT NULL""",
)
def _(r):
    people, places, pay = staged(r)
    return facts.fct_employee_snapshot(people, places, pay, r.reviews, r.leaves, r.assignments, AS_OF)


MONTHLY = """, months AS (
      SELECT last_day(CAST(d AS DATE)) AS month_end
      FROM generate_series(DATE '1997-01-01', DATE '1999-12-01', INTERVAL 1 MONTH) t(d))
    SELECT e.employee_id, CAST(strftime(m.month_end, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(coalesce(amount, 0) AS DOUBLE) AS salary_amount,
           CAST(coalesce(days, 0) AS INTEGER) AS leave_days_taken, status = 'active' AS is_active
    FROM employees e JOIN months m ON hire_date <= m.month_end
    LEFT JOIN salaries s ON s.employee_id = e.employee_id AND s.effective_date <= m.month_end
         AND coalesce(s.end_date, DATE '9999-12-31') >= m.month_end
    LEFT JOIN (SELECT employee_id, last_day(start_date) AS month_end, sum(end_date - start_date) AS days
               FROM leaves WHERE status = 'approved' GROUP BY 1, 2) l
      ON l.employee_id = e.employee_id AND l.month_end = m.month_end"""


@query("monthly_snapshot", "employees salaries leaves", MONTHLY)
def _(r):
    return facts.monthly_snapshot(r.employees, r.salaries, r.leaves, "1997-01-01", "1999-12-31")


@query("monthly_refresh", "employees salaries leaves", MONTHLY)
def _(r):
    """The stored snapshot after a first run on what was known in June 1998 and a second one on everything."""
    path, day = new_path(r.spark, "monthly"), "1998-06-30"
    known = r.salary_rows.filter(F.col("created_at") <= day)
    before = history.close_history(known, "employee_id", "effective_date", "salary_id")
    people, away = (df.filter(F.col("created_at") <= day) for df in (r.employees, r.leaves))
    months = ("1997-01-01", "1999-12-31", path)
    facts.refresh_monthly_snapshot(people, before, away, *months, f"{day} 00:00:00")
    facts.refresh_monthly_snapshot(r.employees, r.salaries, r.leaves, *months, f"{AS_OF} 00:00:00")
    stored = r.spark.read.parquet(f"{path}/rows")
    return stored.select("employee_id", "date_key", "salary_amount", "leave_days_taken", "is_active")


@query(
    "approx_distinct",
    "",
    """SELECT o_orderpriority, count(DISTINCT o_custkey) AS exact_count, true AS within_bound FROM orders GROUP BY 1
    UNION ALL SELECT 'all', count(DISTINCT o_custkey), true FROM orders""",
)
def _(r):
    """Distinct customers from stored sketches per day and priority, united per priority and over all, beside the exact counts."""
    orders = r.table("orders")
    daily = orders.withColumn("day", F.col("o_orderdate").cast("date"))
    sketches = materialize(aggregates.distinct_sketches(daily, ["day", "o_orderpriority"], "o_custkey"), "sketches")
    estimates = aggregates.united_count(sketches, ["o_orderpriority"], "estimate").unionAll(
        aggregates.united_count(sketches, out="estimate").select(F.lit("all").alias("o_orderpriority"), "estimate")
    )
    exact = orders.groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("exact_count"))
    exact = exact.unionAll(orders.agg(F.lit("all"), F.countDistinct("o_custkey")))
    allowed = F.col("exact_count") * aggregates.sketch_error()
    within = F.abs(F.col("estimate") - F.col("exact_count")) <= allowed
    return exact.join(estimates, "o_orderpriority").select("o_orderpriority", "exact_count", within.alias("within_bound"))
