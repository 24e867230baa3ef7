"""A stored history of versions (SCD Type 2) of which a load rewrites the open ones only.

A load reads the open versions, merges the new state into them, and writes one
folder: the versions that are open now, and the ones it closed. Closed versions
are never read or written again. The manifest line published at the end makes
the folder count; a load that dies before leaves the history as it was, and is
simply repeated.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tenura.operators.history import scd2_merge
from tenura.sources.appends import stored_or_empty
from tenura.sources.publish import publications, publish


@dataclass(frozen=True)
class StoredHistory:
    """A history in ``directory``: its key column and the schema of the key and the tracked columns."""

    directory: str
    key: str
    schema: StructType

    @property
    def tracked(self) -> list[str]:
        return [c for c in self.schema.names if c != self.key]

    @property
    def stored_schema(self) -> StructType:
        dates = [StructField(c, DateType()) for c in ("effective_date", "expiry_date")]
        return StructType([*self.schema.fields, *dates])

    def _path(self, version: str, is_current: bool) -> str:
        return f"{self.directory}/rows/{version}/is_current={str(is_current).lower()}"

    def _published(self, spark: SparkSession) -> list[tuple[str, int]]:
        """(version, versions it closed) of each load, oldest first; one row a load."""
        lines = publications(spark, self.directory).groupBy("number").agg(F.max_by(F.struct("version", "tables"), "version").alias("v"))
        rows = lines.orderBy("number").select("v.*").collect()
        return [(r["version"], dict(map(tuple, r["tables"]))["closed"]) for r in rows]

    def open_versions(self, spark: SparkSession) -> DataFrame:
        """The current state; only the files of the last load are read."""
        published = self._published(spark)
        rows = (
            stored_or_empty(spark, self._path(published[-1][0], True), self.stored_schema)
            if published
            else spark.createDataFrame([], self.stored_schema)
        )
        return rows.withColumn("is_current", F.lit(True))

    def closed_versions(self, spark: SparkSession) -> DataFrame:
        """All closed versions. The files of one load end on one day, so a filter on ``expiry_date`` skips the others."""
        paths = [self._path(version, False) for version, closed in self._published(spark) if closed]
        reader = spark.read.schema(self.stored_schema)
        rows = reader.parquet(*paths) if paths else spark.createDataFrame([], self.stored_schema)
        return rows.withColumn("is_current", F.lit(False))

    def versions(self, spark: SparkSession) -> DataFrame:
        return self.closed_versions(spark).unionByName(self.open_versions(spark))

    def load(self, incoming: DataFrame, as_of: Column, close_missing: bool = True) -> dict[str, int]:
        """Make ``incoming`` (one row per key) the current state as of a day; the number of open and newly closed versions.

        Same rules as ``scd2_merge``. Loading the same state again closes and
        opens nothing. One load at a time: it fails if another one has been
        published since it began.
        """
        spark = incoming.sparkSession
        before = self._published(spark)
        names = self.schema.names
        merged = scd2_merge(self.open_versions(spark), incoming.select(*names), self.key, self.tracked, as_of, close_missing)
        version = f"v-{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        seen = Observation("versions")
        counted = merged.observe(
            seen, F.count_if(F.col("is_current")).alias("open"), F.count_if(~F.col("is_current")).alias("closed")
        )
        counted.select(*self.stored_schema.names, "is_current").write.partitionBy("is_current").parquet(
            f"{self.directory}/rows/{version}"
        )
        counts = {name: seen.get[name] for name in ("open", "closed")}
        if self._published(spark) != before:
            raise RuntimeError(f"another load has been published while {version} was written")
        publish(spark, self.directory, version, counts)
        return counts
