"""Which keys hold many rows, found once per table and shared by all operators.

One map-side pass over a table keeps a mergeable frequent-items sketch per key
set. It can not miss a key whose share lies above the sketch's error, so only
its candidates are counted exactly. Operators look their keys up in the
profile and run no job of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: items that a sketch tracks at first and at most
TRACKED, MOST_TRACKED = 10_000, 1_000_000


@dataclass(frozen=True)
class KeyProfile:
    """Hot values by key columns. A key set that is not in it has none."""

    hot: dict[tuple[str, ...], tuple[StructType, frozenset[Row]]] = field(default_factory=dict)

    def frame(self, spark: SparkSession, keys: list[str]) -> DataFrame | None:
        """The hot values of ``keys`` as a frame, None without any."""
        schema, rows = self.hot.get(tuple(keys), (None, frozenset()))
        return spark.createDataFrame(list(rows), schema) if rows else None

    def renamed(self, **names: str) -> KeyProfile:
        """The same values under other column names, given as old=new."""
        out = {}
        for keys, (schema, rows) in self.hot.items():
            fresh = StructType([type(f)(names.get(f.name, f.name), f.dataType, f.nullable) for f in schema])
            out[tuple(names.get(k, k) for k in keys)] = (fresh, rows)
        return KeyProfile(out)

    def __or__(self, other: KeyProfile) -> KeyProfile:
        """Hot in either. A key that is hot in one table only is split in the other without need, but rightly."""
        out = dict(self.hot)
        for keys, (schema, rows) in other.hot.items():
            out[keys] = (out[keys][0], out[keys][1] | rows) if keys in out else (schema, rows)
        return KeyProfile(out)


def sketch_size(tracked: int) -> int:
    """Slots of a sketch of so many tracked items: a power of two, three quarters of it in use."""
    return 1 << max(3, (4 * tracked // 3 - 1).bit_length())


def surely_found(rows: int, tracked: int) -> float:
    """The row count from which a key can not be missed: twice the error of 3.5 rows per slot."""
    return 7 * rows / sketch_size(tracked)


def count_hot(df: DataFrame, keys: list[str], limit: int) -> list[Row]:
    """The keys with more than ``limit`` rows, by an exact count; at most (rows / limit) of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > limit).select(*keys).collect()


def profile_keys(df: DataFrame, key_sets: list[list[str]], limit: int, tracked: int = TRACKED) -> KeyProfile:
    """The keys of each set with more than ``limit`` rows, from one pass and exact counts of the candidates.

    If the sketch is too coarse for the limit, it is made again with more
    items, and where no sketch is fine enough the keys are counted. NULL is a
    key like any other.
    """
    hashes = [F.xxhash64(*keys, F.lit(len(keys))).alias(f"_h{i}") for i, keys in enumerate(key_sets)]
    while True:
        found = (
            df.select(*hashes)
            .agg(
                F.count(F.lit(1)).alias("rows"),
                *[F.call_function("approx_top_k", f"_h{i}", F.lit(tracked), F.lit(tracked)).alias(f"top{i}") for i in range(len(key_sets))],
            )
            .first()
        )
        rows = found["rows"]
        if rows <= limit or surely_found(rows, tracked) <= limit or tracked >= MOST_TRACKED:
            break
        wanted = 7 * rows // max(limit, 1)
        if wanted > sketch_size(MOST_TRACKED):
            break
        tracked = min(MOST_TRACKED, max(2 * tracked, wanted))
    hot = {}
    for i, keys in enumerate(key_sets):
        if rows <= limit:
            values = []
        elif surely_found(rows, tracked) > limit:
            values = count_hot(df, keys, limit)
        else:
            # the estimate never lies under the true count by more than the error
            error = surely_found(rows, tracked) / 2
            likely = [item["item"] for item in found[f"top{i}"] if item["count"] + error > limit]
            values = count_hot(df.filter(F.xxhash64(*keys, F.lit(len(keys))).isin(likely)), keys, limit) if likely else []
        hot[tuple(keys)] = (df.select(*keys).schema, frozenset(values))
    return KeyProfile(hot)
