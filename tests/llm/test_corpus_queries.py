"""The bound corpus queries against their SQL or against brute force, and the pipeline stage by stage."""

from __future__ import annotations

import contextlib
import io

import duckdb
import pytest

import corpus_pipeline
from tenura.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, name):
    got = QUERIES[name](spark, FOLDER)
    with duckdb.connect() as db:
        for table in ("documents", "pages"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
        columns = ", ".join(got.columns)
        want = db.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_all_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_no_cross_joins_and_no_python_in_native_plans(spark):
    for name, query in QUERIES.items():
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            query(spark, FOLDER).explain("simple")
        plan = text.getvalue()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
        if name in ("op1_pseudonyms", "op3_line_dedup", "op9_mixing"):
            for node in ("Python", "Pandas", "MapInArrow", "MapPartitions"):
                assert node not in plan, (name, node)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    sizes = [docs.count()]
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["quality classifier", "line dedup", "MinHash near-dedup", "mixing sources", "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns
        if name == "quality classifier":
            kept = {r["doc_id"] for r in after.collect()}
            assert all((k in kept) == bool(q) for k, q in labels.items())
        docs = after.cache()
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, FOLDER).count() == packed.count()
