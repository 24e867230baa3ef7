"""Scans, sinks, schemas, models and the warehouse build."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tenura import schemas
from tenura.plans import analytics, dimensions, models, warehouse
from tenura.plans.extract import extract_all
from tenura.settings import new_path
from tenura.sources import appends, publish, readers, writers
from workload.registry import query
from workload.reports import staff
from workload.roles import AS_OF

ORDERS = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"
)
ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, "
    "o_orderpriority string"
)


def orders(r):
    return r.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("table_scan", "", "SELECT l_returnflag, l_linestatus, l_quantity, l_shipdate::DATE::VARCHAR AS l_shipdate FROM lineitem")
def _(r):
    return r.table("lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", F.col("l_shipdate").cast("date").alias("l_shipdate")
    )


@query(
    "sql_scan",
    "",
    """SELECT n_name, count(*) AS customers, count(DISTINCT c_mktsegment) AS segments
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def _(r):
    readers.register_views({"sql_scan_customer": r.table("customer"), "sql_scan_nation": r.table("nation")})
    return readers.read_sql(
        r.spark,
        """SELECT n_name, count(*) AS customers, count(DISTINCT c_mktsegment) AS segments
        FROM sql_scan_customer JOIN sql_scan_nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    )


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
COLUMN_COUNTS = dict(zip(TABLES.split(), [2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4], strict=True))


@query(
    "table_profile",
    "",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS row_count, {n} AS column_count FROM {t}"
        for t, n in COLUMN_COUNTS.items()
    ),
)
def _(r):
    return readers.profile_tables({t: r.table(t) for t in TABLES.split()})


@query(
    "total_rows",
    "",
    f"SELECT CAST(sum(n) AS BIGINT) AS total_rows FROM ({' UNION ALL '.join(f'SELECT count(*) AS n FROM {t}' for t in TABLES.split())})",
)
def _(r):
    return writers.total_rows(readers.profile_tables({t: r.table(t) for t in TABLES.split()}))


@query(
    "current_schema",
    "",
    "SELECT 'default' AS current_schema, count(*) AS row_count FROM orders",
)
def _(r):
    return readers.current_schema(r.spark).select("current_schema", readers.count_rows(orders(r)).scalar().alias("row_count"))


@query(
    "schema_catalogue",
    "departments employees salaries reviews projects assignments leaves",
    " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", count(*) AS row_count, {n} AS column_count FROM {role}"
        for table, role, n in [
            ("departments", "departments", 5),
            ("employees", "employees", 11),
            ("salaries", "salaries", 7),
            ("performance_reviews", "reviews", 7),
            ("projects", "projects", 8),
            ("employee_projects", "assignments", 5),
            ("leave_requests", "leaves", 7),
        ]
    ),
)
def _(r):
    return readers.profile_tables({name: schemas.conform(df, name) for name, df in r.source.items()})


@query(
    "conform_schema",
    "loose_salaries",
    """SELECT salary_id, employee_id, CAST(amount AS DOUBLE) AS amount, 'USD' AS currency,
    CAST(NULL AS VARCHAR) AS effective_date, CAST(end_date AS VARCHAR) AS end_date FROM loose_salaries""",
)
def _(r):
    return schemas.conform(r.loose_salaries, "salaries").drop("created_at")


@query(
    "apply_defaults",
    "employees",
    """SELECT employee_id, coalesce(first_name, 'n/a') AS first_name, coalesce(job_title, 'Specialist') AS job_title,
    'hr_postgresql' AS source_system, true AS is_current FROM employees""",
)
def _(r):
    people = r.employees.select("employee_id", "first_name", "job_title")
    return schemas.apply_defaults(
        people,
        {"first_name": "n/a", "job_title": "Specialist", "source_system": "hr_postgresql", "is_current": True},
    )


@query("drop_keys", "", "SELECT o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _(r):
    return writers.drop_columns(r.table("orders"), ["o_orderkey", "o_custkey", "o_orderdate", "employee_key"])


@query("top_n_show", "", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 10")
def _(r):
    return writers.show_rows(r.table("supplier").select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey"), 10)


@query("roundtrip_parquet", "", ORDERS)
def _(r):
    path = new_path(r.spark, "orders-parquet")
    writers.write_table(orders(r), path)
    return r.spark.read.parquet(path)


@query("append_parquet", "", f"{ORDERS} UNION ALL {ORDERS}")
def _(r):
    path = new_path(r.spark, "orders-append")
    writers.write_table(orders(r), path)
    writers.write_table(orders(r), path, mode="append")
    return r.spark.read.parquet(path)


@query("roundtrip_csv", "", ORDERS)
def _(r):
    path = writers.export_csv(orders(r), new_path(r.spark, "orders-csv"))
    return readers.read_csv(r.spark, path, schema=ORDERS_SCHEMA)


@query(
    "report_csv",
    "employees",
    """SELECT employee_id, concat_ws(' ', first_name, last_name) AS full_name,
    round((DATE '2002-01-01' - hire_date) / 365, 2) AS tenure_years FROM employees""",
)
def _(r):
    report = staff(r).select("employee_id", "full_name", "tenure_years")
    path = writers.export_csv(report, new_path(r.spark, "report-csv"))
    return readers.read_csv(r.spark, path, schema=report.schema)


@query(
    "view_vs_table",
    "",
    """SELECT o_orderstatus, count(*) AS view_rows, count(*) AS table_rows FROM orders GROUP BY 1""",
)
def _(r):
    base = orders(r)
    readers.register_views({"orders_view": base})
    path = new_path(r.spark, "orders-table")
    stored = writers.save_as_table(base, f"orders_table_{path[-32:]}", path)
    by_view = readers.read_sql(r.spark, "SELECT o_orderstatus, count(*) AS view_rows FROM orders_view GROUP BY 1")
    by_table = stored.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("table_rows"))
    return by_view.join(by_table, "o_orderstatus")


@query(
    "warehouse_build",
    "employees departments salaries reviews leaves assignments",
    """SELECT employee_id, department_id, CAST(year(d) AS INTEGER) AS year,
    CAST(coalesce(amount, 0) AS DOUBLE) AS salary_amount,
    coalesce(rating, 0) AS performance_rating, CAST(coalesce(days, 0) AS INTEGER) AS leave_days_taken,
    CAST(coalesce(n, 0) AS INTEGER) AS project_count, status = 'active' AS is_active, 'hr_postgresql' AS source_system
    FROM (SELECT *, DATE '2002-01-01' AS d FROM employees)
    LEFT JOIN (SELECT employee_id, amount FROM salaries WHERE end_date IS NULL) USING (employee_id)
    LEFT JOIN (SELECT employee_id, CAST(arg_max(rating, (review_date, review_id)) AS DOUBLE) AS rating
               FROM reviews WHERE rating IS NOT NULL GROUP BY 1) USING (employee_id)
    LEFT JOIN (SELECT employee_id, sum(end_date - start_date) AS days FROM leaves
               WHERE status = 'approved' GROUP BY 1) USING (employee_id)
    LEFT JOIN (SELECT employee_id, count(project_id) AS n FROM assignments GROUP BY 1) USING (employee_id)""",
)
def _(r):
    """The loaded fact read back through its dimensions."""
    loaded = warehouse.build_warehouse(
        r.spark, r.source, new_path(r.spark, "warehouse"), AS_OF, 1995, 2002, minimum_rows={"dim_date": 365}
    )
    return (
        loaded["fact_employee_snapshot"]
        .join(loaded["dim_employee"].select("employee_key", "employee_id"), "employee_key")
        .join(loaded["dim_department"].select("department_key", "department_id"), "department_key")
        .join(loaded["dim_date"].select("date_key", "year"), "date_key")
        .select(
            "employee_id", "department_id", "year", "salary_amount", "performance_rating", "leave_days_taken",
            "project_count", "is_active", "source_system",
        )
    )


@query(
    "warehouse_versions",
    "employees departments projects",
    """SELECT * FROM (VALUES ('dim_date', 2922::BIGINT), ('dim_leave_type', 5::BIGINT)) t("table", row_count)
    UNION ALL SELECT 'dim_employee', count(*) FROM employees UNION ALL SELECT 'dim_department', count(*) FROM departments
    UNION ALL SELECT 'dim_project', count(*) FROM projects UNION ALL SELECT 'fact_employee_snapshot', count(*) FROM employees""",
)
def _(r):
    """What readers see after a second load without departments has failed its gate, counted from the tables."""
    folder = new_path(r.spark, "warehouse")
    warehouse.build_warehouse(r.spark, r.source, folder, AS_OF, 1995, 2002, minimum_rows={"dim_date": 365})
    broken = {**r.source, "departments": r.departments.limit(0)}
    try:
        warehouse.build_warehouse(r.spark, broken, folder, AS_OF, 1995, 2002, minimum_rows={"dim_department": 5})
    except ValueError:
        return readers.profile_tables(warehouse.read_warehouse(r.spark, folder)).select("table", "row_count")


@query(
    "published_counts",
    "departments employees projects",
    """SELECT 'dim_department' AS "table", count(*) AS row_count FROM departments
    UNION ALL SELECT 'dim_employee', count(*) FROM employees UNION ALL SELECT 'dim_project', count(*) FROM projects""",
)
def _(r):
    """The counts in the manifest, taken while the tables were written."""
    folder, tables = new_path(r.spark, "staged"), {}
    extracts = extract_all(r.source)
    tables["dim_department"] = dimensions.dim_department(extracts["departments"])
    tables["dim_employee"] = dimensions.dim_employee(extracts["employees"], AS_OF)
    tables["dim_project"] = dimensions.dim_project(extracts["projects"])
    version, counts = publish.stage(tables, folder, list(tables))
    publish.publish(r.spark, folder, version, counts)
    return publish.publications(r.spark, folder).select(F.explode("tables").alias("t")).select("t.table", "t.row_count")


@query(
    "append_keys",
    "",
    """SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal >= 0, c_custkey) AS customer_key FROM customer""",
)
def _(r):
    """Customers in debt are loaded first, then all of them."""
    customers, path = r.table("customer"), new_path(r.spark, "customer-keys")
    appends.extend_key_map(customers.filter("c_acctbal < 0"), ["c_custkey"], "customer_key", path)
    return appends.extend_key_map(customers, ["c_custkey"], "customer_key", path)


@query(
    "append_facts",
    "",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderstatus = 'O', o_orderkey) AS snapshot_id FROM orders""",
)
def _(r):
    """Closed orders first, open ones appended with numbers that go on."""
    facts, path = r.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), new_path(r.spark, "facts")
    for batch in (facts.filter("o_orderstatus <> 'O'"), facts.filter("o_orderstatus = 'O'")):
        appends.append_numbered(batch.drop("o_orderstatus"), ["o_orderkey"], "snapshot_id", path)
    return r.spark.read.parquet(path)


@query(
    "export_tables",
    "employees departments",
    """SELECT 'employees' AS "table", count(*) AS row_count, sum(employee_id)::BIGINT AS id_sum FROM employees
    UNION ALL SELECT 'departments', count(*), sum(department_id)::BIGINT FROM departments""",
)
def _(r):
    """Source tables exported as CSV folders and read back by their declared schemas."""
    tables = {"employees": schemas.conform(r.employees, "employees"), "departments": schemas.conform(r.departments, "departments")}
    paths = writers.export_tables(tables, new_path(r.spark, "exports"))
    parts = [
        readers.read_csv(r.spark, path, name).agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("row_count"),
            F.sum("employee_id" if name == "employees" else "department_id").cast("bigint").alias("id_sum"),
        )
        for name, path in paths.items()
    ]
    return parts[0].unionAll(parts[1])


def _loaded_into(r, create, tables):
    """Row counts of ``tables`` after they went into the catalog tables that ``create`` makes."""
    database = f"schema_{uuid.uuid4().hex[:12]}"
    folder = new_path(r.spark, database)
    create(r.spark, database, folder)
    for name, df in tables.items():
        schemas.conform(df, name).write.mode("append").insertInto(f"{database}.{name}")
    known = [t.name for t in r.spark.catalog.listTables(database) if not t.isTemporary]
    return readers.profile_tables({name: r.spark.table(f"{database}.{name}") for name in sorted(known)})


@query(
    "source_schema",
    "departments employees projects",
    """SELECT 'departments' AS "table", count(*) AS row_count, 5 AS column_count FROM departments
    UNION ALL SELECT 'employees', count(*), 11 FROM employees UNION ALL SELECT 'projects', count(*), 8 FROM projects
    UNION ALL SELECT * FROM (VALUES ('employee_projects', 0::BIGINT, 5), ('leave_requests', 0, 7),
                             ('performance_reviews', 0, 7), ('salaries', 0, 7))""",
)
def _(r):
    """The source tables created empty in the catalog, three of them loaded."""
    loaded = {"departments": r.departments, "employees": r.employees, "projects": r.projects}
    return _loaded_into(r, writers.create_source_schema, loaded)


@query(
    "warehouse_schema",
    "departments",
    """SELECT 'dim_department' AS "table", count(*) AS row_count FROM departments
    UNION ALL SELECT * FROM (VALUES ('dim_date', 0::BIGINT), ('dim_employee', 0), ('dim_project', 0),
                             ('dim_leave_type', 0), ('fact_employee_snapshot', 0))""",
)
def _(r):
    """The warehouse tables created in the catalog, a dimension loaded."""
    loaded = {"dim_department": dimensions.dim_department(extract_all(r.source)["departments"])}
    return _loaded_into(r, writers.create_warehouse_schema, loaded).select("table", "row_count")


@query(
    "model_build",
    "employees departments",
    """, people AS (SELECT * FROM employees WHERE email IS NOT NULL)
    SELECT department_name, coalesce(headcount, 0) AS headcount, coalesce(snapshot_rows, 0) AS snapshot_rows
    FROM departments LEFT JOIN (SELECT department_id, count(*) AS headcount, count(*) AS snapshot_rows
      FROM people GROUP BY 1) USING (department_id)""",
)
def _(r):
    """Models built as views and tables, then queried by name."""
    models.build_models(r.spark, r.source, new_path(r.spark, "models"), AS_OF)
    return readers.read_sql(
        r.spark,
        """SELECT d.department_name, d.headcount, coalesce(s.snapshot_rows, 0) AS snapshot_rows
        FROM dim_departments d LEFT JOIN (
          SELECT department_id, count(*) AS snapshot_rows FROM fct_employee_snapshot GROUP BY department_id) s
        ON d.department_id = s.department_id""",
    )


@query(
    "analytics_exports",
    "employees salaries departments",
    """SELECT department_name, count(employee_id) AS headcount,
    CAST(round(CAST(avg(amount) AS DECIMAL(28,6)), 2) AS DOUBLE) AS avg_salary
    FROM employees LEFT JOIN (SELECT employee_id, amount FROM salaries WHERE end_date IS NULL) USING (employee_id)
    LEFT JOIN departments USING (department_id) GROUP BY 1""",
)
def _(r):
    """A report saved as one CSV file and read back."""
    report = analytics.salary_distribution(r.employees, r.salaries, r.departments)
    path = writers.export_csv(report, new_path(r.spark, "salary-csv"), one_file=True)
    return readers.read_csv(r.spark, path, schema=report.schema).select("department_name", "headcount", "avg_salary")
