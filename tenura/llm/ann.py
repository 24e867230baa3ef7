"""Approximate nearest neighbours by multiprobe p-stable hashing.

Unit vectors are hashed by Gaussian projections cut into cells of a fixed
width; a table's bucket is the cell numbers of its projections. A query visits
not only its own bucket: the cells around it are ordered by the estimated
probability that a neighbour at the usual distance lies there, over all tables
together, until the probability of having met it in some table reaches the
target. Candidates of all buckets are merged and ranked by the exact cosine.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.text import bounded, mix
from tenura.settings import materialize

TABLES, TARGET, WIDTH, SEED = 3, 0.97, 2.2, 20240229

#: vectors, at most, on which the usual distance of a neighbour is estimated, and queries among them
SAMPLE, SAMPLE_QUERIES = 20_000, 256

#: rows of a bucket that one part of it holds
PART = 8192

_ROWS = "query_id long, rep long, score double"


class Index:
    """Projections of ``tables`` tables and the distance that a neighbour is expected at."""

    def __init__(self, dimension: int, rows: int, distance: float, tables: int = TABLES, width: float = WIDTH, target: float = TARGET):
        rng = np.random.default_rng(SEED)
        #: comparing a bucket's vectors as one matrix costs far less than visiting another bucket, so
        #: projections grow slowly with the vectors: far neighbours then need tens of buckets, not thousands
        self.projections = max(4, round(math.log2(max(rows, 2)) / 4))
        self.tables, self.width, self.target, self.distance = tables, width, target, max(distance, 0.05)
        self.directions = rng.normal(size=(dimension, tables * self.projections))
        self.shifts = rng.uniform(0, width, tables * self.projections)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Position in cells, (vector, table, projection)."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return ((unit @ self.directions + self.shifts) / self.width).reshape(len(vectors), self.tables, self.projections)

    def buckets(self, cells: np.ndarray, table: int | np.ndarray) -> np.ndarray:
        """A 64-bit number for each row of cell numbers."""
        value = np.zeros(len(cells), np.uint64) + np.asarray(table, np.uint64)
        for column in cells.T:
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.int64).view(np.uint64))
        return value.view(np.int64)

    def _table_probes(self, place: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(probability, cells) of a table's buckets, the most probable first.

        Each projection's cells are sorted by probability. A state counts the
        loss against the best cells; its successors take the next cell of one
        projection, from the last one changed on, so none comes up twice.
        """
        cell = np.floor(place)
        step = np.arange(-4, 5)
        edges = (np.arange(-4, 6)[None, :] + (cell - place)[:, None]) * self.width / self.distance
        below = 0.5 * (1 + np.vectorize(math.erf)(edges / math.sqrt(2)))
        chance = np.maximum(np.diff(below, axis=1), 1e-300)
        order = np.argsort(-chance, axis=1, kind="stable")
        loss = -np.log(np.take_along_axis(chance, order, 1))
        base = loss[:, 0].sum()
        states: list[tuple[float, tuple[int, ...], int]] = [(base, (0,) * len(place), 0)]
        while states:
            cost, ranks, changed = heapq.heappop(states)
            cells = cell + step[order[np.arange(len(place)), ranks]]
            yield math.exp(-cost), cells
            for k in range(changed, len(place)):
                if ranks[k] + 1 < len(step):
                    more = (*ranks[:k], ranks[k] + 1, *ranks[k + 1 :])
                    heapq.heappush(states, (cost + loss[k, ranks[k] + 1] - loss[k, ranks[k]], more, k))

    def probes(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(table, cells) to visit for one query, in the order of estimated success, until the target is reached."""
        streams = [self._table_probes(p) for p in place]
        heads = [(-p, t, c) for t, s in enumerate(streams) for p, c in [next(s)]]
        queue = [(p, t) for p, t, _ in heads]
        cells = {t: c for _, t, c in heads}
        heapq.heapify(queue)
        missed = np.ones(self.tables)
        tables, visited = [], []
        while queue and 1 - missed.prod() < self.target:
            p, t = heapq.heappop(queue)
            missed[t] = max(missed[t] + p, 0.0)
            tables.append(t)
            visited.append(cells[t])
            if (after := next(streams[t], None)) is not None:
                cells[t] = after[1]
                heapq.heappush(queue, (-after[0], t))
        return np.array(tables), np.array(visited)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    return (
        vector.isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def _vectors(column: pa.Array) -> np.ndarray:
    """The vectors in double precision, each times a power of two that brings its largest component near 1."""
    rows = len(column)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    _, exponents = np.frexp(np.abs(x).max(1, initial=0.0))
    return np.ldexp(x, -exponents[:, None])


def _rows(column: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, d = column.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * d, d, dtype=np.int32), pa.array(column.ravel(), kind))


def _hashed(index: Index, as_query: bool, kind: pa.DataType):
    """Rows (bucket, is_query, id, vector): the own bucket of each table, or all buckets a query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64 if as_query else 4096):
                part = batch.slice(at, 64 if as_query else 4096)
                vectors = _vectors(part.column(1))
                places = index.places(vectors)
                ids = part.column(0).to_numpy()
                if as_query:
                    found = [index.probes(p) for p in places]
                    which = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
                    buckets = np.concatenate([index.buckets(c, t) for t, c in found])
                else:
                    which = np.tile(np.arange(len(ids)), index.tables)
                    buckets = np.concatenate(
                        [index.buckets(np.floor(places[:, t]), t) for t in range(index.tables)]
                    )
                for low in range(0, len(which), 8192):
                    own = which[low : low + 8192]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(buckets[low : low + 8192]), pa.array(ids[own]), _rows(vectors[own], kind)],
                        names=["bucket", "id", "vector"],
                    )

    return run


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact cosines in double precision; equal vectors get equal values wherever they stand."""
    return (vectors * query).sum(1) / np.sqrt((vectors * vectors).sum(1) * (query * query).sum())


def _ranked(k: int):
    """Of a bucket's vectors, the best k + 1 classes for each query that visits it; rows come sorted by bucket part."""

    def best(members: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, queries: np.ndarray) -> list[tuple]:
        names = np.concatenate([m[0] for m in members])
        vectors = np.concatenate([m[1] for m in members])
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        out = []
        for low in range(0, len(ids), 256):
            scores = (queries[low : low + 256] / np.linalg.norm(queries[low : low + 256], axis=1, keepdims=True)) @ unit.T
            for query, vector, row in zip(ids[low : low + 256], queries[low : low + 256], scores, strict=True):
                at = np.arange(len(row))
                if len(row) > k + 1:
                    # all within rounding of the last place stay, so that ties are settled exactly
                    at = np.flatnonzero(row >= np.partition(row, -(k + 1))[-(k + 1)] - 1e-12)
                out += zip([query] * len(at), names[at], cosines(vector, vectors[at]), strict=True)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            bucket, one, other, is_query, ids = columns
            vectors = _vectors(batch.column(5))
            changes = np.flatnonzero(
                (bucket[1:] != bucket[:-1]) | (one[1:] != one[:-1]) | (other[1:] != other[:-1]) | (is_query[1:] != is_query[:-1])
            )
            out = []
            for low, high in zip([0, *(changes + 1)], [*(changes + 1), len(ids)], strict=True):
                here = (bucket[low], one[low], other[low])
                if here != key:
                    key, members = here, []
                if not is_query[low]:
                    members.append((ids[low:high], vectors[low:high]))
                elif members:
                    out += best(members, ids[low:high], vectors[low:high])
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(c, t)) for c, t in zip(columns, (np.int64, np.int64, np.float64), strict=True)],
                    names=["query_id", "rep", "score"],
                )

    return run


def _expected_distance(vectors: DataFrame, k: int) -> float:
    """Distance within which nine of ten sampled vectors have their k-th neighbour; on a bounded sample."""
    sample = vectors.orderBy(F.xxhash64("rep")).limit(SAMPLE).select("vector").toArrow()
    x = _vectors(sample.column(0).combine_chunks()) if sample.num_rows > 1 else np.ones((1, 1))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    if len(x) < 2:
        return 1.0
    cosine = np.sort(x[:SAMPLE_QUERIES] @ x.T, axis=1)[:, ::-1]
    return float(np.percentile(np.sqrt(np.maximum(2 - 2 * cosine[:, min(k, len(x) - 1)], 0)), 90))


def _parts(rows: DataFrame, name: str) -> DataFrame:
    """(bucket, parts) of the buckets with more than PART rows."""
    return bounded(
        rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias(name)).where(F.col(name) > 1)
    )


def _scored(indexed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, rep, score) of the best vectors of each bucket, (bucket, id, vector), for each query that visits it.

    Large buckets are dealt in parts, each met by all parts of their queries.
    """
    rows_of, asked_of = _parts(indexed.select("bucket"), "rows_parts"), _parts(asked.select("bucket"), "query_parts")

    def dealt(part: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
        place = F.pmod(F.xxhash64("id"), F.coalesce(own, F.lit(1))).cast("int").alias("place")
        met = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)).alias("met")
        both = part.join(rows_of, "bucket", "left").join(asked_of, "bucket", "left")
        chosen = both.select("bucket", place, met, F.lit(is_query).alias("is_query"), "id", "vector")
        one, two = ("met", "place") if is_query else ("place", "met")
        return chosen.select("bucket", F.col(one).alias("one"), F.col(two).alias("other"), "is_query", "id", "vector")

    met = dealt(indexed, "rows_parts", "query_parts", False).unionAll(dealt(asked, "query_parts", "rows_parts", True))
    order = ["bucket", "one", "other", "is_query"]
    return met.repartition("bucket", "one", "other").sortWithinPartitions(*order).mapInArrow(_ranked(k), _ROWS)


def nearest(
    table: DataFrame,
    queries: Column,
    k: int = 5,
    tables: int = TABLES,
    target: float = TARGET,
    width: float = WIDTH,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row chosen by ``queries``.

    ``queries`` is a condition on ``table``'s columns. Nearness is the cosine,
    in double precision; ties go to the smaller id. A row is no candidate of
    its own; with fewer candidates than ``k`` there are fewer rows. A query
    whose buckets hold fewer than ``k`` candidates is compared with all rows.
    Very large and very small components neither over- nor underflow. All
    vectors must have the same length.

    Vectors that are null, zero, empty, of another length than most, or hold
    null or non-finite components take no part, neither do rows with a null
    id. Rows repeating an id and a vector count once. Equal vectors are held
    once with their k + 1 smallest ids, which is all that a result can need.
    An empty table, or one without queries, gives an empty table.
    """
    rows = table.select(
        table[f"`{id}`"].cast("long").alias("id"), table[f"`{vector}`"].alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = materialize(rows.distinct(), "vectors")
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return table.sparkSession.createDataFrame([], empty)
    rows = rows.where(F.size("vector") == common["d"])
    equal = Window.partitionBy("vector").orderBy("id")
    classes = materialize(
        rows.select("id", "vector")
        .withColumn("place", F.row_number().over(equal))
        .where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("ids")),
        "classes",
    )
    index = Index(common["d"], classes.count(), _expected_distance(classes, k), tables, width, target)
    kind = pa.float32() if dict(rows.dtypes)["vector"] == "array<float>" else pa.float64()
    schema = f"bucket long, id long, vector array<{'float' if kind == pa.float32() else 'double'}>"
    indexed = classes.select("rep", "vector").mapInArrow(_hashed(index, False, kind), schema)
    # a given number of partitions: few bytes, much work, so they are not to be coalesced
    partitions = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.where("asked").select("id", "vector").repartition(partitions, "id")
    asked = spread.mapInArrow(_hashed(index, True, kind), schema)
    asked = materialize(asked, "probes")
    scored = _scored(indexed, asked, k)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def named(scored: DataFrame) -> DataFrame:
        ids = scored.distinct().join(classes.select("rep", "ids"), "rep").select("query_id", "score", F.explode("ids").alias("vec_id"))
        ranked = ids.where("vec_id <> query_id").distinct().withColumn("rank", F.row_number().over(by_query))
        return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    ranked = materialize(named(scored), "ranked")
    # queries whose buckets held too few candidates meet all vectors, block by block
    complete = ranked.groupBy("query_id").agg(F.max("rank").alias("most")).where(F.col("most") == k)
    short = materialize(spread.join(complete, F.col("id") == F.col("query_id"), "left_anti").select("id", "vector"), "short")
    if short.isEmpty():
        return ranked
    everywhere = F.lit(0).cast("long").alias("bucket")
    all_rows = classes.select(everywhere, F.col("rep").alias("id"), "vector")
    exact = named(_scored(all_rows, short.select(everywhere, "id", "vector"), k))
    return ranked.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(exact)
