"""spark-submit entry point: python -m tenura <job> --source DIR [--target DIR] [--as-of DATE]."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tenura.plans import jobs
from tenura.sources.readers import read_source_tables


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tenura")
    p.add_argument("job", choices=["warehouse", "analytics", "models", "checks", "export"])
    p.add_argument("--source", required=True, help="folder of the source tables")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--target", help="folder to write to")
    p.add_argument("--as-of", help="evaluation date, default today")
    p.add_argument("--start-year", type=int, default=2015, help="first year of the calendar")
    p.add_argument("--end-year", type=int, help="last year of the calendar, default 2026 or the year of --as-of if later")
    p.add_argument("--one-file", action="store_true", help="one CSV file for each report")
    p.add_argument("--database", help="catalog database of the table models")
    return p


def main(arguments: list[str] | None = None) -> None:
    p = parser()
    args = p.parse_args(arguments)
    if args.job != "checks" and not args.target:
        p.error(f"{args.job} needs --target")
    spark = SparkSession.builder.appName(f"tenura-{args.job}").getOrCreate()
    source = read_source_tables(spark, args.source, args.format)
    if args.job == "warehouse":
        jobs.run_warehouse(spark, source, args.target, args.as_of, args.start_year, args.end_year)
    elif args.job == "analytics":
        jobs.run_analytics(source, args.target, args.as_of, args.one_file)
    elif args.job == "models":
        jobs.run_models(spark, source, args.target, args.as_of, args.database)
    elif args.job == "export":
        jobs.run_export(source, args.target)
    else:
        report = jobs.run_checks(source).cache()
        report.show(report.count(), truncate=False)
        if not report.filter("not passed").isEmpty():
            raise SystemExit(1)


if __name__ == "__main__":
    main()
