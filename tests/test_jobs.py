"""The jobs end to end on the small company."""

from __future__ import annotations

import pytest

from people import company
from tenura.__main__ import main, parser
from tenura.plans import jobs, warehouse


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("company")
    for table, df in company(spark).items():
        df.write.parquet(str(path / f"{table}.parquet"))
    return str(path)


def test_analytics_job_writes_three_reports(spark, folder, tmp_path):
    main(["analytics", "--source", folder, "--target", str(tmp_path), "--as-of", "2024-01-01"])
    for name, rows in {"salary_distribution": 3, "performance_trends": 5, "attrition_risk": 4}.items():
        back = spark.read.csv(str(tmp_path / name), header=True)
        assert back.count() == rows
    order = [float(r["avg_salary"] or -1) for r in spark.read.csv(str(tmp_path / "salary_distribution"), header=True).collect()]
    assert order == sorted(order, reverse=True)


def test_warehouse_job(spark, folder, tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="minimum_rows"):
        main(["warehouse", "--source", folder, "--target", str(tmp_path / "small"), "--as-of", "2024-01-01"])
    monkeypatch.setattr(warehouse, "MINIMUM_ROWS", {"dim_date": 365})
    main(["warehouse", "--source", folder, "--target", str(tmp_path / "wh"), "--as-of", "2024-01-01"])
    assert warehouse.read_warehouse(spark, str(tmp_path / "wh"))["dim_date"].count() == 4383


def test_models_job_fails_on_a_broken_test(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="fct_employee_snapshot.unique"):
        main(["models", "--source", folder, "--target", str(tmp_path), "--as-of", "2024-01-01"])


def test_export_and_checks(spark, folder, tmp_path, capsys):
    main(["export", "--source", folder, "--target", str(tmp_path / "csv")])
    assert spark.read.csv(str(tmp_path / "csv" / "employees"), header=True).count() == 5
    with pytest.raises(SystemExit, match="1"):
        main(["checks", "--source", folder])
    assert "references" in capsys.readouterr().out
    assert jobs.run_checks(company(spark)).filter("not passed").count() == 3


def test_arguments():
    assert parser().parse_args(["checks", "--source", "x"]).as_of is None
    with pytest.raises(SystemExit):
        main(["models", "--source", "x"])
