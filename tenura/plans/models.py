"""Named models over the source views, each kept as a view or as a table.

The list is in build order: a model only uses sources and models above it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tenura.operators import quality
from tenura.plans import dimensions, facts, staging
from tenura.sources.readers import register_views
from tenura.sources.writers import save_as_table


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[[dict[str, DataFrame], object], DataFrame]
    table: bool = False


MODELS = [
    Model("stg_employees", lambda t, as_of: staging.stg_employees(t["employees"], as_of)),
    Model("stg_salaries", lambda t, as_of: staging.stg_salaries(t["salaries"])),
    Model("stg_departments", lambda t, as_of: staging.stg_departments(t["departments"])),
    Model(
        "dim_employees",
        lambda t, as_of: dimensions.dim_employees(t["stg_employees"], t["stg_departments"], as_of),
        table=True,
    ),
    Model(
        "dim_departments",
        lambda t, as_of: dimensions.dim_departments(t["stg_departments"], t["stg_employees"], as_of),
        table=True,
    ),
    Model(
        "fct_employee_snapshot",
        lambda t, as_of: facts.fct_employee_snapshot(
            t["stg_employees"],
            t["stg_departments"],
            t["stg_salaries"],
            t["performance_reviews"],
            t["leave_requests"],
            t["employee_projects"],
            as_of,
        ),
        table=True,
    ),
]

# fixed values: the checks declared on the models
MODEL_STATUS_VALUES = ["active", "terminated", "inactive"]


def build_models(
    spark: SparkSession, source: dict[str, DataFrame], directory: str, as_of=None, database: str | None = None
) -> dict[str, DataFrame]:
    """Register the sources and all models as views, writing the table models under ``directory``.

    With ``database`` the table models also become catalog tables of it.
    """
    register_views(source)
    known = dict(source)
    for model in MODELS:
        df = model.build(known, as_of)
        if model.table and database:
            df = save_as_table(df, f"{database}.{model.name}", f"{directory}/{model.name}")
        elif model.table:
            df.write.mode("overwrite").parquet(f"{directory}/{model.name}")
            df = spark.read.schema(df.schema).parquet(f"{directory}/{model.name}")
        df.createOrReplaceTempView(model.name)
        known[model.name] = df
    return {model.name: known[model.name] for model in MODELS}


def model_checks(models: dict[str, DataFrame]) -> DataFrame:
    """The declared tests of the three table models as one report."""
    people, places, snapshot = (models[n] for n in ("dim_employees", "dim_departments", "fct_employee_snapshot"))
    return quality.combine(
        [
            quality.unique(people, "dim_employees", ["employee_id"]),
            quality.unique(people, "dim_employees", ["email"]),
            quality.row_checks(
                people,
                "dim_employees",
                [
                    quality.not_null("employee_id"),
                    quality.not_null("email"),
                    quality.accepted_values("status", MODEL_STATUS_VALUES),
                    quality.not_null("tenure_years"),
                ],
            ),
            quality.unique(places, "dim_departments", ["department_id"]),
            quality.row_checks(
                places, "dim_departments", [quality.not_null("department_id"), quality.not_null("department_name")]
            ),
            quality.unique(snapshot, "fct_employee_snapshot", ["employee_id"]),
            quality.row_checks(
                snapshot,
                "fct_employee_snapshot",
                [quality.not_null("employee_id"), quality.not_null("current_salary"), quality.not_null("is_active")],
            ),
        ]
    )
