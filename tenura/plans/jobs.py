"""The runnable jobs: warehouse refresh, analytics exports, models with their tests, source checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenura.operators import quality
from tenura.plans import analytics, models, warehouse
from tenura.sources.writers import export_csv, export_tables


def run_warehouse(
    spark: SparkSession, source: dict[str, DataFrame], target: str, as_of=None, start_year=2015, end_year=None
) -> dict[str, DataFrame]:
    """Full refresh of the star schema under ``target``; fails if a table is too small or a key has no parent."""
    return warehouse.build_warehouse(spark, source, target, as_of, start_year, end_year)


def run_analytics(source: dict[str, DataFrame], target: str, as_of=None, one_file: bool = False) -> dict[str, str]:
    """Write the three reports as CSV under ``target``; each as one file if ``one_file``."""
    staff = analytics.enrich_employees(source["employees"], as_of)
    salaries, reviews = source["salaries"], source["performance_reviews"]
    reports = {
        "salary_distribution": analytics.salary_distribution(staff, salaries, source["departments"]),
        "performance_trends": analytics.performance_trends(staff, reviews),
        "attrition_risk": analytics.attrition_risk(staff, salaries, reviews, source["leave_requests"]),
    }
    return {name: export_csv(df, f"{target}/{name}", one_file) for name, df in reports.items()}


def run_models(
    spark: SparkSession, source: dict[str, DataFrame], target: str, as_of=None, database: str | None = None
) -> DataFrame:
    """Build all models, then run their tests; raises if one fails, else returns the report."""
    report = models.model_checks(models.build_models(spark, source, target, as_of, database))
    quality.gate(report)
    return report


def run_checks(source: dict[str, DataFrame]) -> DataFrame:
    """The declared constraints of the source tables as a report."""
    return warehouse.source_checks(source)


def run_export(source: dict[str, DataFrame], target: str) -> dict[str, str]:
    """Every source table as CSV under ``target``."""
    return export_tables(source, target)
