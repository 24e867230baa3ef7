"""Send this package to the Python workers of a session that can not import it by itself."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> SparkSession:
    """The session; its workers can import the package afterwards.

    Nothing is sent if the package's folder is on PYTHONPATH or is the working
    folder, which workers inherit. Otherwise a zip file goes through Spark's
    own file distribution, once for each session's context.
    """
    root, context = PACKAGE.parent, spark.sparkContext
    there = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    name = f"{PACKAGE.name}-package.zip"
    if root not in there and not any(f.endswith(name) for f in context.listFiles):
        path = Path(tempfile.mkdtemp()) / name
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(PACKAGE.rglob("*.py")):
                archive.write(file, file.relative_to(root))
        context.addPyFile(str(path))
    return spark
