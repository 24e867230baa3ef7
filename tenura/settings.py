"""Size limits, known hot keys and the shared working folder.

The operators leave the physical plan to Catalyst. Only where one key could
put an unbounded number of rows into one task do they look whether it is hot;
the keys over the limit take a way that splits them. Which keys are hot comes
from the session's key profile, made once per table. Limits given without a
profile ask the operator to count the keys itself, by a job of its own.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tenura.operators.skew import KeyProfile


@dataclass(frozen=True)
class Limits:
    """When to split.

    max_group_rows: rows of one key that a single task may sort; keys with
        more rows are split over many tasks.
    profile: the keys known to be hot; None to count them.
    """

    max_group_rows: int = 5_000_000
    profile: KeyProfile | None = None


_PROFILES: weakref.WeakKeyDictionary[SparkSession, KeyProfile] = weakref.WeakKeyDictionary()


def use_profile(spark: SparkSession, profile: KeyProfile) -> None:
    """Let operators called without limits split the keys of ``profile``."""
    _PROFILES[spark] = profile


def session_limits(spark: SparkSession) -> Limits:
    """The row limit set in the session, as spark.tenura.maxGroupRows, and its key profile, empty if none is in use."""
    rows = int(spark.conf.get("spark.tenura.maxGroupRows", str(Limits().max_group_rows)))
    return Limits(rows, _PROFILES.get(spark, KeyProfile()))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tenura-"))
            folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, under one folder per application to clear afterwards."""
    return f"{shared_folder(spark)}/tenura-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    Cuts the lineage like a checkpoint, survives lost executors, and keeps
    column pruning and size statistics for the readers.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
