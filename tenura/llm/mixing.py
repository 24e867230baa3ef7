"""Mixing sources to target weights by Poisson replication.

Each source gets the mean repetition rate that brings its expected share of
the corpus to its target weight. A document's number of copies inverts the
Poisson distribution at a uniform number hashed from the seed and its id, so
that the result is the same on every run and needs no state. Copies are
exploded and sorted globally by a hash. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.text import Guarded, bounded
from tenura.settings import materialize

#: a rate above this is drawn as a sum of independent draws with smaller rates
LARGEST_RATE = 16.0

#: terms of the distribution that are tabulated; beyond them, at a rate of 16, less than 1e-30 is left
TERMS = 96


def document_size(text: Column) -> Column:
    """Code points and one end mark, so that an empty document has a size."""
    return F.coalesce(F.length(text), F.lit(0)).cast("long") + 1


def source_rates(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    alpha: float = 0.5,
    total: float | None = None,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(source, size, weight, rate): the mean number of copies for each document of a source.

    ``weights`` gives the target share of each source (any scale); sources it
    does not name get none. Without it a source is weighted by its size to
    the power ``alpha``. ``total`` is the expected size of the mixture, by
    default that of the input. A null source is a source of its own.
    """
    sizes = docs.groupBy(docs[f"`{source}`"].alias("source")).agg(
        F.sum(document_size(docs[f"`{text}`"])).alias("size")
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(float(alpha))))
    else:
        table = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, weight double")
        weighted = sizes.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("name")), "left").select(
            "source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighted = materialize(weighted, "rates")
    everything = weighted.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    scale = float(total if total is not None else everything["size"] or 0)
    all_weight = float(everything["weight"] or 0) or 1.0
    return weighted.withColumn("rate", F.col("weight") / F.lit(all_weight) * F.lit(scale) / F.col("size"))


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def distribution(rate: Column) -> Column:
    """P(X <= k) for k = 0 .. TERMS - 1."""
    start = F.exp(-rate)

    def add(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        return F.struct(
            term.alias("term"),
            (state["sum"] + term).alias("sum"),
            F.concat(state["below"], F.array(state["sum"] + term)).alias("below"),
        )

    first = F.struct(start.alias("term"), start.alias("sum"), F.array(start).alias("below"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), first, add, lambda state: state["below"])


def poisson_mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    alpha: float = 0.5,
    total: float | None = None,
    seed: int = 20240229,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Every copy of every document, all columns, with ``copy`` (from 1) and ``shuffle_key``, sorted by the key.

    A document has Poisson(rate of its source) copies; sources without weight
    and documents drawn zero times give none. Rows repeating an id get equal
    draws. A null id is drawn as the text 'null'; null text has size 1. An
    empty table gives an empty table. Columns of ``docs`` named copy or
    shuffle_key come back beside the new ones, which stand last.
    """
    rates = source_rates(docs, weights, alpha, total, source, text)
    table = rates.where(F.col("rate") > 0).select(
        F.col("source").alias("rate_source"),
        F.ceil(F.col("rate") / LARGEST_RATE).cast("int").alias("draws"),
        distribution(F.col("rate") / F.ceil(F.col("rate") / LARGEST_RATE)).alias("below"),
    )
    own = Guarded(docs)
    drawn = own.df.withColumns({"id": own.col(id), "of": own.col(source)}).join(
        bounded(table), F.col("of").eqNullSafe(F.col("rate_source"))
    )
    copies = F.aggregate(
        F.sequence(F.lit(1), F.col("draws")),
        F.lit(0),
        lambda n, draw: n + F.size(F.filter("below", lambda p: p <= uniform(seed, F.col("id"), draw))),
    )
    order = F.concat_ws(":", F.lit(f"{seed}:shuffle"), F.coalesce(F.col("id").cast("string"), F.lit("null")), "copy")
    return (
        drawn.withColumn("copies", copies)
        .where(F.col("copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn("shuffle_key", F.md5(order))
        .orderBy("shuffle_key")
        .select(*own.restored(), "copy", "shuffle_key")
    )
