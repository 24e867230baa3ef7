"""Inputs that used to give wrong, incomplete or endless results."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tenura.llm import ann, near_dedup, packing, quality

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefgh", k=5)) for _ in range(n)]


def text_of(seed, n=200, change=0):
    out = words(seed, n)
    for i in range(change):
        out[i * n // max(change, 1)] = f"changed{i}"
    return " ".join(out)


def test_many_repeats_of_two_near_copies(spark):
    rows = [(1, text_of(1)), (2, text_of(1, change=2))] * 300 + [(3, text_of(3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_dedup.near_components(docs).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in found) == {(1, 1, True): 300, (2, 1, False): 300, (3, 3, True): 1}


def test_repeated_ids_and_null_ids_are_told_apart_by_content(spark):
    rows = [
        (7, text_of(1)), (7, text_of(2)), (5, text_of(1, change=1)), (8, text_of(2, change=1)), (9, text_of(4)),
        (None, text_of(4, change=1)), (None, text_of(5)), (None, text_of(5)), (None, text_of(5, change=1)), (None, None), (None, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(((r["doc_id"], r["component_id"]) for r in near_dedup.near_components(docs).collect()), key=str)
    assert found == sorted([(7, 5), (7, 7), (5, 5), (8, 7), (9, 9), (None, 9)] + [(None, None)] * 5, key=str)
    left = Counter((r["doc_id"], r["text"] if r["doc_id"] is None and not r["text"] else r["doc_id"]) for r in near_dedup.keep_one(docs).collect())
    # id 7 names two documents; one of them is a copy of 5, so its rows go together
    assert left == {(5, 5): 1, (9, 9): 1, (None, None): 2, (None, ""): 1}


def sequences(spark, sizes, capacity=4096):
    lengths = spark.createDataFrame(list(enumerate(sizes)), "key long, size int").repartition(4)
    placed = packing.place(lengths, capacity).collect()
    by_sequence = {}
    for r in placed:
        by_sequence.setdefault(r["seq"], []).append((r["offset"], sizes[r["key"]]))
    for members in by_sequence.values():
        at = 0
        for offset, size in sorted(members):
            assert offset == at
            at += size
        assert at <= capacity
    assert sorted(r["key"] for r in placed) == list(range(len(sizes)))
    return len(by_sequence)


def best_fit_decreasing(sizes, capacity=4096):
    room = []
    for size in sorted(sizes, reverse=True):
        fits = [(gap, i) for i, gap in enumerate(room) if gap >= size]
        if fits:
            gap, i = min(fits)
            room[i] = gap - size
        else:
            room.append(capacity - size)
    return len(room)


@pytest.mark.parametrize(
    "sizes",
    [[1500] * 200 + [1000] * 200, [700] * 150 + [600] * 150 + [1100] * 90, [2000] * 50 + [130] * 900],
    ids=["two sizes", "three sizes", "long and short"],
)
def test_as_few_sequences_as_best_fit(spark, sizes):
    assert sequences(spark, sizes) <= best_fit_decreasing(sizes) * 1.01 + 1


def test_query_far_from_all_others(spark):
    """Every query has its k candidates, whatever the buckets hold; the ranks are those of all rows."""
    draw = np.random.default_rng(1)
    vectors = np.ones(16) + 0.05 * draw.normal(size=(600, 16))
    vectors[0] = -vectors[0]
    vectors[50] *= 1e200
    vectors[100] *= 1e-200
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.nearest(table, table["vec_id"] % 50 == 0).collect()
    assert Counter(r["query_id"] for r in found) == {i: 5 for i in range(0, 600, 50)}
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    near = unit @ unit[0]
    near[0] = -2
    own = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == 0)
    assert [v for _, v in own] == np.argsort(-near, kind="stable")[:5].tolist()


def test_no_labels_give_no_evidence(spark):
    docs = spark.createDataFrame([(1, "some words", "en", "a/b", 10), (2, None, "en", "a/c", 0)], COLUMNS)
    for labels in ([], [(1, None)], [(1, 7)], [(99, 1)]):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert set(model.weights) == {0.0} and model.intercept == model.base == 0.0
        judged = quality.quality_posterior(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert {r["evidence"] for r in judged} == {0.0}


def test_stages_of_the_pipeline_on_awkward_rows(spark, tmp_path):
    rows = [(1, text_of(1), "en", "a", 9), (2, text_of(1), "en", "a", 9), (None, text_of(1), None, None, None), (4, None, "en", "b", 0), (5, "", None, "b", 0)]
    rows += [(6, "\n".join(["same line"] * 3 + [text_of(6)]), "de", "c", 9)] * 2
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (spark.createDataFrame(rows, COLUMNS), spark.createDataFrame([], COLUMNS)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
            assert stage(spark, docs, str(tmp_path)).count() >= 0
        one = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()
        assert Counter(r["doc_id"] for r in one) == ({1: 1, 4: 1, 5: 1, 6: 2} if docs.count() else {})
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
