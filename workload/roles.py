"""The workforce tables, derived from the test tables.

Every role reads its whole table. ``ROLE_SQL`` states the same derivation in
SQL, independently of the library.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenura.operators.aggregates import distinct_pairs
from tenura.operators.history import close_history
from tenura.operators.skew import KeyProfile, profile_keys
from tenura.settings import session_limits, use_profile
from tenura.sources.readers import read_parquet

AS_OF = "2002-01-01"

_SCHEMAS: dict[tuple[str, str], StructType] = {}
_PROFILES: dict[tuple[str, int], KeyProfile] = {}

#: the columns that stand for an employee in the tables with many rows per employee
EMPLOYEE_COLUMNS = {"orders": "o_custkey", "events": "user_id", "lineitem": "l_suppkey"}


class Roles:
    """Role tables by attribute; reads lazily. The hot keys of a folder are found once, by a pass over each table."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        limit = session_limits(spark).max_group_rows
        if (directory, limit) not in _PROFILES:
            profile = KeyProfile()
            for table, column in EMPLOYEE_COLUMNS.items():
                profile |= profile_keys(self.table(table), [[column]], limit).renamed(**{column: "employee_id"})
            _PROFILES[directory, limit] = profile
        use_profile(spark, _PROFILES[directory, limit])

    def table(self, name: str) -> DataFrame:
        """A test table; its schema is inferred once per folder, not by a job per read."""
        key = (self.directory, name)
        df = read_parquet(self.spark, self.directory, name, _SCHEMAS.get(key))
        _SCHEMAS[key] = df.schema
        return df

    @cached_property
    def employees(self) -> DataFrame:
        hired = F.date_add(F.lit("1995-01-01").cast("date"), F.floor(F.abs("c_acctbal")).cast("int") % 2400)
        return self.table("customer").select(
            F.col("c_custkey").alias("employee_id"),
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(F.col("c_acctbal") <= 9500, F.concat("c_name", F.lit("@X.COM"))).alias("email"),
            hired.alias("hire_date"),
            F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("job_title"),
            F.col("c_nationkey").alias("department_id"),
            F.nullif(F.floor(F.col("c_custkey") / 10), F.lit(0)).alias("manager_id"),
            F.when(F.col("c_acctbal") < 0, "terminated").otherwise("active").alias("status"),
            hired.alias("created_at"),
            hired.alias("updated_at"),
        )

    @cached_property
    def departments(self) -> DataFrame:
        regions = self.table("region")
        nations = self.table("nation")
        return nations.join(regions, nations.n_regionkey == regions.r_regionkey, "left").select(
            F.col("n_nationkey").alias("department_id"),
            F.col("n_name").alias("department_name"),
            F.nullif("r_name", F.lit("ASIA")).alias("location"),
            F.when(F.col("n_nationkey") % 5 != 0, F.col("n_nationkey")).cast("bigint").alias("manager_id"),
            F.lit("1995-01-01").cast("date").alias("created_at"),
        )

    @cached_property
    def salary_rows(self) -> DataFrame:
        """Salary changes without end dates; the employee is declared not null."""
        start = F.col("o_orderdate").cast("date")
        return self.table("orders").filter(F.col("o_custkey").isNotNull()).select(
            F.col("o_orderkey").alias("salary_id"),
            F.col("o_custkey").alias("employee_id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
            F.lit("USD").alias("currency"),
            start.alias("effective_date"),
            start.alias("created_at"),
        )

    @cached_property
    def salaries(self) -> DataFrame:
        """Salary history closed by the next change: one open row per employee."""
        return self._closed_salaries()

    def _closed_salaries(self) -> DataFrame:
        return close_history(self.salary_rows, "employee_id", "effective_date", "salary_id")

    @cached_property
    def loose_salaries(self) -> DataFrame:
        """A history with any number of open rows per employee, also none."""
        end = F.when(F.col("o_orderstatus") != "O", F.date_add(F.col("o_orderdate").cast("date"), 365))
        return self.table("orders").select(
            F.col("o_orderkey").alias("salary_id"),
            F.col("o_custkey").alias("employee_id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
            end.alias("end_date"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        day = F.col("ts").cast("date")
        rating = F.when(F.col("event_type") != "error", 1 + F.floor("value") % 5)
        return self.table("events").select(
            F.col("event_id").alias("review_id"),
            F.col("user_id").alias("employee_id"),
            F.nullif(F.floor(F.col("user_id") / 10), F.lit(0)).alias("reviewer_id"),
            rating.cast("int").alias("rating"),
            day.alias("review_date"),
            F.col("event_type").alias("comments"),
            day.alias("created_at"),
        )

    @cached_property
    def leaves(self) -> DataFrame:
        start = F.col("l_shipdate").cast("date")
        types = F.array(*[F.lit(t) for t in ("annual", "sick", "maternity", "paternity", "unpaid")])
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("leave_id"),
            F.col("l_suppkey").alias("employee_id"),
            F.element_at(types, F.col("l_linenumber") % 5 + 1).alias("leave_type"),
            start.alias("start_date"),
            F.date_add(start, F.col("l_quantity").cast("int")).alias("end_date"),
            F.when(F.col("l_linestatus") == "F", "approved").otherwise("pending").alias("status"),
            start.alias("created_at"),
        )

    @cached_property
    def projects(self) -> DataFrame:
        start = F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size"))
        return self.table("part").select(
            F.col("p_partkey").alias("project_id"),
            F.col("p_name").alias("project_name"),
            (F.col("p_size") % 30).alias("department_id"),
            start.alias("start_date"),
            F.date_add(start, (F.col("p_partkey") % 540).cast("int")).alias("end_date"),
            F.when(F.col("p_type") == "PROMO", "on_hold").otherwise("active").alias("status"),
            F.col("p_retailprice").cast("decimal(15,2)").alias("budget"),
            start.alias("created_at"),
        )

    @cached_property
    def work(self) -> DataFrame:
        """Every piece of work of an employee on a project; pairs repeat."""
        orders, lines = self.table("orders"), self.table("lineitem")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("emp_project_id"),
            F.col("o_custkey").alias("employee_id"),
            F.col("l_partkey").alias("project_id"),
            F.col("o_orderpriority").alias("role"),
            F.col("o_orderdate").cast("date").alias("assigned_date"),
        )

    @cached_property
    def assignments(self) -> DataFrame:
        """One row per pair; a query that only counts pairs plans as a plain distinct."""
        return distinct_pairs(self.work, ["employee_id", "project_id"], "emp_project_id")

    @property
    def source(self) -> dict[str, DataFrame]:
        """All role tables under the names of the declared source tables."""
        return {
            "departments": self.departments,
            "employees": self.employees,
            "salaries": self.salaries,
            "performance_reviews": self.reviews,
            "projects": self.projects,
            "employee_projects": self.assignments,
            "leave_requests": self.leaves,
        }


ROLE_SQL = {
    "employees": """
        SELECT c_custkey AS employee_id, nullif(c_mktsegment, 'BUILDING') AS first_name, c_name AS last_name,
               CASE WHEN c_acctbal <= 9500 THEN c_name || '@X.COM' END AS email,
               DATE '1995-01-01' + CAST(floor(abs(c_acctbal)) AS INTEGER) % 2400 AS hire_date,
               nullif(c_mktsegment, 'HOUSEHOLD') AS job_title, c_nationkey AS department_id,
               nullif(c_custkey // 10, 0) AS manager_id,
               CASE WHEN c_acctbal < 0 THEN 'terminated' ELSE 'active' END AS status,
               hire_date AS created_at, hire_date AS updated_at
        FROM customer""",
    "departments": """
        SELECT n_nationkey AS department_id, n_name AS department_name, nullif(r_name, 'ASIA') AS location,
               CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey END AS manager_id,
               DATE '1995-01-01' AS created_at
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "salaries": """
        SELECT o_orderkey AS salary_id, o_custkey AS employee_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               'USD' AS currency, CAST(o_orderdate AS DATE) AS effective_date,
               CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) - 1
                 AS end_date,
               CAST(o_orderdate AS DATE) AS created_at
        FROM orders""",
    "loose_salaries": """
        SELECT o_orderkey AS salary_id, o_custkey AS employee_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 365 END AS end_date
        FROM orders""",
    "reviews": """
        SELECT event_id AS review_id, user_id AS employee_id, nullif(user_id // 10, 0) AS reviewer_id,
               CASE WHEN event_type <> 'error' THEN 1 + CAST(floor(value) AS INTEGER) % 5 END AS rating,
               CAST(ts AS DATE) AS review_date, event_type AS comments, CAST(ts AS DATE) AS created_at
        FROM events""",
    "leaves": """
        SELECT l_orderkey * 10 + l_linenumber AS leave_id, l_suppkey AS employee_id,
               CASE l_linenumber % 5 WHEN 0 THEN 'annual' WHEN 1 THEN 'sick' WHEN 2 THEN 'maternity'
                    WHEN 3 THEN 'paternity' ELSE 'unpaid' END AS leave_type,
               CAST(l_shipdate AS DATE) AS start_date,
               CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS end_date,
               CASE WHEN l_linestatus = 'F' THEN 'approved' ELSE 'pending' END AS status,
               CAST(l_shipdate AS DATE) AS created_at
        FROM lineitem""",
    "projects": """
        SELECT p_partkey AS project_id, p_name AS project_name, p_size % 30 AS department_id,
               DATE '1995-01-01' + p_size AS start_date,
               DATE '1995-01-01' + p_size + CAST(p_partkey % 540 AS INTEGER) AS end_date,
               CASE WHEN p_type = 'PROMO' THEN 'on_hold' ELSE 'active' END AS status,
               CAST(p_retailprice AS DECIMAL(15,2)) AS budget, DATE '1995-01-01' + p_size AS created_at
        FROM part""",
    "work": """
        SELECT l_orderkey * 10 + l_linenumber AS emp_project_id, o_custkey AS employee_id,
               l_partkey AS project_id, o_orderpriority AS role, CAST(o_orderdate AS DATE) AS assigned_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "assignments": """
        SELECT emp_project_id, employee_id, project_id, role, assigned_date FROM (
          SELECT l_orderkey * 10 + l_linenumber AS emp_project_id, o_custkey AS employee_id,
                 l_partkey AS project_id, o_orderpriority AS role, CAST(o_orderdate AS DATE) AS assigned_date,
                 row_number() OVER (PARTITION BY o_custkey, l_partkey
                                    ORDER BY l_orderkey * 10 + l_linenumber) AS nth
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        WHERE nth = 1""",
}
