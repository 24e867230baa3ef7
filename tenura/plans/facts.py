"""Employee snapshot facts.

Each measure is aggregated per employee before it is joined, so all joins run
on one hash partitioning of employee_id; only open salaries may fan out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenura.functions.dates import as_of_date, date_key
from tenura.functions.rules import equals_flag
from tenura.operators.aggregates import average_rating, leave_days, sum_or_zero
from tenura.operators.history import current_rows, latest_by, month_ends
from tenura.operators.joins import fan_out_left
from tenura.settings import Limits
from tenura.sources.appends import stored_or_empty


def latest_rating(reviews: DataFrame, out: str = "performance_rating") -> DataFrame:
    return latest_by(reviews, "employee_id", "rating", ["review_date", "review_id"], out)


def total_leave_days(leaves: DataFrame, out: str = "leave_days_taken") -> DataFrame:
    """Sum of the extracted ``leave_days``; 0 when all are NULL."""
    return leaves.groupBy("employee_id").agg(sum_or_zero(F.col("leave_days")).alias(out))


def project_count(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("employee_id").agg(F.count("project_id").alias("project_count"))


def fact_employee_snapshot(
    employees: DataFrame,
    salaries: DataFrame,
    reviews: DataFrame,
    leaves: DataFrame,
    assignments: DataFrame,
    employee_keys: DataFrame,
    department_keys: DataFrame,
    as_of=None,
    rating: str = "latest",
    project_key: int = 1,
    limits: Limits | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per employee and open salary, keyed by the dimension keys.

    ``leaves`` are the extracted approved leaves; ``rating`` is 'latest' or
    'avg'. The key maps hold (employee_id, employee_key) and (department_id,
    department_key). ``carry`` names salary columns to keep beside the fact's.
    """
    if rating == "latest":
        ratings = latest_rating(reviews)
    elif rating == "avg":
        ratings = average_rating(reviews, out="performance_rating")
    else:
        raise ValueError(f"rating must be 'latest' or 'avg', not {rating!r}")
    open_salaries = current_rows(salaries).select("employee_id", F.col("amount").alias("salary_amount"), *carry)
    per_employee = (
        employees.select("employee_id", "department_id", "status")
        .join(ratings, "employee_id", "left")
        .join(total_leave_days(leaves), "employee_id", "left")
        .join(project_count(assignments), "employee_id", "left")
        .join(employee_keys, "employee_id", "left")
    )
    rows = fan_out_left(per_employee, open_salaries, ["employee_id"], limits)
    return rows.join(department_keys, "department_id", "left").select(
        "employee_key",
        "department_key",
        date_key(as_of_date(as_of)).alias("date_key"),
        F.lit(project_key).alias("project_key"),
        F.coalesce("salary_amount", F.lit(0)).alias("salary_amount"),
        F.coalesce(F.col("performance_rating").cast("double"), F.lit(0.0)).alias("performance_rating"),
        F.coalesce("leave_days_taken", F.lit(0)).cast("int").alias("leave_days_taken"),
        F.coalesce("project_count", F.lit(0)).cast("int").alias("project_count"),
        equals_flag("status", "active").alias("is_active"),
        *carry,
    )


def fct_employee_snapshot(
    stg_employees: DataFrame,
    stg_departments: DataFrame,
    stg_salaries: DataFrame,
    reviews: DataFrame,
    leaves: DataFrame,
    assignments: DataFrame,
    as_of=None,
    limits: Limits | None = None,
) -> DataFrame:
    """Wide snapshot from the staging views: attributes, measures and flags."""
    salaries = stg_salaries.filter("is_current").select("employee_id", "salary_amount", "currency")
    rated = reviews.groupBy("employee_id").agg(
        F.round(F.avg("rating"), 1).alias("avg_rating"), F.max("review_date").alias("last_review_date")
    )
    per_employee = (
        stg_employees.join(rated, "employee_id", "left")
        .join(leave_days(leaves), "employee_id", "left")
        .join(project_count(assignments), "employee_id", "left")
    )
    places = stg_departments.select("department_id", "department_name", "location")
    rows = fan_out_left(per_employee, salaries, ["employee_id"], limits).join(places, "department_id", "left")
    return rows.select(
        "employee_id",
        "full_name",
        "job_title",
        "hire_date",
        "tenure_years",
        "status",
        "department_id",
        "department_name",
        "location",
        F.coalesce("salary_amount", F.lit(0)).alias("current_salary"),
        "currency",
        F.coalesce("avg_rating", F.lit(0)).alias("avg_performance_rating"),
        "last_review_date",
        F.coalesce("total_leave_days", F.lit(0)).alias("total_leave_days"),
        F.coalesce("project_count", F.lit(0)).alias("project_count"),
        equals_flag("status", "active").alias("is_active"),
        as_of_date(as_of).alias("snapshot_date"),
    )


def monthly_snapshot(
    employees: DataFrame,
    salaries: DataFrame,
    leaves: DataFrame,
    first,
    last,
    limits: Limits | None = None,
    months: list | None = None,
) -> DataFrame:
    """One row per employee and month end in [first, last] from the hire month on.

    ``months`` names the month ends to compute, by default all of them.

    Salary valid at the month end and approved leave days started in the month.
    Every interval is expanded to the month ends it covers, so the joins are
    equi-joins on (employee_id, month_end): hot employees spread over months
    and nothing is compared by range.
    """
    first, last = as_of_date(first), as_of_date(last)

    def covered(low, high):
        ends = month_ends(low, high)
        return ends if months is None else F.array_intersect(ends, F.array(*[F.lit(m) for m in months]).cast("array<date>"))

    staff = employees.select(
        "employee_id", "status", F.explode(covered(F.greatest(first, F.col("hire_date")), last)).alias("month_end")
    )
    until = F.least(last, F.coalesce(F.col("end_date"), last))
    paid = salaries.select(
        "employee_id",
        F.col("amount").alias("salary_amount"),
        F.explode(covered(F.greatest(first, F.col("effective_date")), until)).alias("month_end"),
    )
    away = (
        leaves.filter((F.col("status") == "approved") & F.col("start_date").between(first, last))
        .groupBy("employee_id", F.last_day("start_date").alias("month_end"))
        .agg(F.sum(F.datediff("end_date", "start_date")).alias("leave_days_taken"))
    )
    on = ["employee_id", "month_end"]
    # an interval gives at most one row per month: counting the intervals of an employee is enough
    measured = staff.join(away, on, "left")
    return fan_out_left(measured, paid, on, limits, salaries, ["employee_id"]).select(
        "employee_id",
        date_key(F.col("month_end")).alias("date_key"),
        F.coalesce("salary_amount", F.lit(0)).alias("salary_amount"),
        F.coalesce("leave_days_taken", F.lit(0)).cast("int").alias("leave_days_taken"),
        equals_flag("status", "active").alias("is_active"),
    )


def changed_months(
    employees: DataFrame, salaries: DataFrame, leaves: DataFrame, first, last, since: DataFrame
) -> DataFrame:
    """(month_end) whose rows may differ since the stored snapshot, read off the rows that are newer than ``since``.

    ``since`` holds one row with ``taken_at``. A changed employee touches all
    months, a new one those from the hire on, a salary those from its start on
    (the one before it ends there), a leave the month it starts in.
    """
    first, last = as_of_date(first), as_of_date(last)
    newer = lambda df, column: df.filter(F.col(column).cast("timestamp") > since.scalar())
    spans = [
        newer(employees, "updated_at").select(
            F.when(F.col("created_at").cast("timestamp") > since.scalar(), F.greatest(first, F.col("hire_date")))
            .otherwise(first)
            .alias("start"),
            last.alias("end"),
        ),
        newer(salaries, "created_at").select(F.greatest(first, F.col("effective_date")).alias("start"), last.alias("end")),
        newer(leaves.filter(F.col("start_date").between(first, last)), "created_at").select(
            F.trunc("start_date", "month").alias("start"), F.last_day("start_date").alias("end")
        ),
    ]
    earliest = spans[0].unionAll(spans[1]).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return earliest.unionAll(spans[2].distinct()).select(F.explode(month_ends(F.col("start"), F.col("end"))).alias("month_end")).distinct()


def refresh_monthly_snapshot(
    employees: DataFrame,
    salaries: DataFrame,
    leaves: DataFrame,
    first,
    last,
    path: str,
    taken_at,
    limits: Limits | None = None,
) -> list:
    """Bring the stored snapshot at ``path`` up to date and return the month ends that were computed.

    The snapshot is partitioned by ``date_key``; beside it one row per month
    tells as of when it was computed. Only months that are missing there, or
    that rows newer than the last run touch, are computed, and replace their
    partition; the others are not read or written. ``taken_at`` is the time up
    to which the sources have been loaded. Running again without new rows
    writes nothing; a run that died is repeated, since a month is only noted
    after its rows are there. Rows deleted from a source need a full refresh,
    and so does a month that loses its last row.
    """
    spark = employees.sparkSession
    noted = stored_or_empty(spark, f"{path}/taken", StructType.fromDDL("month_end date, taken_at timestamp"))
    wanted = spark.range(1).select(F.explode(month_ends(as_of_date(first), as_of_date(last))).alias("month_end"))
    missing = wanted.join(noted, "month_end", "left_anti")
    latest = noted.groupBy("month_end").agg(F.max("taken_at").alias("taken_at"))
    oldest = latest.agg(F.min("taken_at").alias("taken_at"))
    touched = changed_months(employees, salaries, leaves, first, last, oldest).join(wanted, "month_end", "left_semi")
    # at most one row per month
    months = sorted(r["month_end"] for r in missing.unionAll(touched).distinct().collect())
    if months:
        rows = monthly_snapshot(employees, salaries, leaves, first, last, limits, months)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_key").parquet(f"{path}/rows")
    done = noted.select("month_end").distinct().unionAll(missing).distinct()
    if months or not latest.filter(F.col("taken_at") < F.lit(taken_at).cast("timestamp")).isEmpty():
        done.select("month_end", F.lit(taken_at).cast("timestamp").alias("taken_at")).coalesce(1).write.mode("append").parquet(
            f"{path}/taken"
        )
    return months
