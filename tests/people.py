"""A small hand-written company with the edge cases the operators must handle."""

from __future__ import annotations

from datetime import date, datetime

from tenura.schemas import schema_of

T0 = datetime(2015, 1, 1)


def d(text):
    return date.fromisoformat(text) if text else None



DATA = {
    "departments": [
        (1, "Engineering", "NYC", 1, T0),
        (2, "Analytics", None, 3, T0),
        (3, "Legal", "LA", None, T0),
    ],
    "employees": [
        (1, "Ann", "Lee", "Ann@x.com", d("2020-01-01"), "Engineer", 1, None, "active", T0, T0),
        (2, "Bob", "Ray", "bob@x.com", d("2012-02-29"), None, 1, 1, "active", T0, T0),
        (3, "Cyd", "Fox", "cyd@x.com", d("2019-03-15"), "Manager", 2, None, "terminated", T0, T0),
        (4, "Dee", "Elm", "dee@x.com", d("2030-01-01"), "Junior Analyst", None, 3, "active", T0, T0),
        (5, "Eve", "Oak", "eve@x.com", d("2021-06-01"), "VP", 9, 99, None, T0, T0),
    ],
    "salaries": [
        (1, 1, "100.00", "USD", d("2020-01-01"), d("2020-12-31"), T0),
        (2, 1, "120.00", "USD", d("2021-01-01"), None, T0),
        (3, 2, "200.00", "USD", d("2012-02-29"), None, T0),
        (4, 2, "210.00", "USD", d("2013-01-01"), None, T0),
        (5, 3, "50.00", "USD", d("2019-03-15"), None, T0),
        (6, 4, "0.00", "USD", d("2030-01-01"), None, T0),
    ],
    "performance_reviews": [
        (1, 1, 2, 2, d("2021-12-15"), "a", T0),
        (2, 1, 2, 5, d("2022-12-15"), "b", T0),
        (3, 1, 2, None, d("2023-12-15"), "c", T0),
        (4, 2, 1, 3, d("2021-12-15"), "d", T0),
        (5, 2, 1, 4, d("2021-12-15"), "e", T0),
        (6, 3, 1, None, d("2021-12-15"), "f", T0),
        (7, 4, 1, 4, d("2021-12-15"), "g", T0),
    ],
    "projects": [
        (1, "Alpha", 1, d("2020-01-01"), d("2020-03-01"), "completed", "1000.00", T0),
        (2, "Beta", 9, d("2021-01-01"), None, "active", None, T0),
    ],
    "employee_projects": [
        (1, 1, 1, "Lead", d("2020-01-01")),
        (2, 1, 2, "Lead", d("2021-01-01")),
        (3, 2, 1, "Reviewer", d("2020-01-01")),
    ],
    "leave_requests": [
        (1, 1, "annual", d("2022-01-01"), d("2022-01-11"), "approved", T0),
        (2, 1, "sick", d("2022-02-01"), d("2022-02-16"), "approved", T0),
        (3, 1, "sick", d("2022-03-01"), d("2022-03-31"), "rejected", T0),
        (4, 2, "unpaid", d("2024-02-28"), d("2024-03-01"), "approved", T0),
    ],
}


def company(spark):
    from pyspark.sql import functions as F

    tables = {}
    for table, rows in DATA.items():
        declared = schema_of(table)
        loose = ", ".join(
            f"{f.name} {'string' if f.dataType.typeName() == 'decimal' else f.dataType.simpleString()}"
            for f in declared.fields
        )
        df = spark.createDataFrame(rows, loose)
        tables[table] = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields])
    return tables
