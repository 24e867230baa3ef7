"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.settings import materialize


def _pairs(a, b) -> list:
    return [F.greatest(a, b).alias("high"), F.least(a, b).alias("low")]


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are hung to the smallest of the node and its neighbours."""
    both = links.select(F.col("high").alias("node"), F.col("low").alias("to")).unionAll(
        links.select(F.col("low").alias("node"), F.col("high").alias("to"))
    )
    least = both.groupBy("node").agg(F.min("to").alias("least"))
    return (
        both.where(F.col("to") > F.col("node"))
        .join(least, "node")
        .select(F.col("to").alias("high"), F.least("node", "least").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung to the smallest of these."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    moved = links.join(least, "high").where(F.col("low") != F.col("least")).select(
        F.col("low").alias("high"), F.col("least").alias("low")
    )
    return least.select("high", F.col("least").alias("low")).unionAll(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link (columns a, b; long) to another.

    Links may repeat and point either way; loops are ignored. Each round is
    written to the shared folder; the number of rounds grows with the
    logarithm of the largest component. Only sums of the link table reach the
    driver, to see that nothing changes any more.
    """
    links = materialize(links.where("a <> b").select(*_pairs(F.col("a"), F.col("b"))).distinct(), "links")
    seen = None
    while True:
        links = materialize(_small_star(_large_star(links)), "stars")
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")), F.max("high")
        ).first()
        if state == seen:
            return links.select(F.col("high").alias("node"), F.col("low").alias("root"))
        seen = state
