"""Quality classification by hierarchical empirical Bayes.

A logistic model turns surface measures of a document into log odds of good
quality. The sites come in by two levels of grouped aggregation: a host's
share of good documents is shrunk toward the global share, a path's share
toward its host's, each with a prior strength estimated from the spread
between the groups, so that sparse sites say little. A document's posterior
joins its own evidence with the prior of its path, from which its own vote is
taken out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.text import Guarded, bounded
from tenura.settings import materialize

#: labelled documents the model is fitted on, at most (those with the smallest hash)
FIT_ROWS = 20_000

#: strength limits of the estimated priors, in documents
STRENGTH = (2.0, 1000.0)

#: log odds of one document's evidence are kept within this
EVIDENCE = 12.0


def measures(text: Column) -> dict[str, Column]:
    """Surface measures, each about 0 to 1, of a text that is not null."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.greatest(F.regexp_count(text, F.lit(r"[^\s]+")), F.lit(1)).cast("double")
    return {
        "symbols": F.regexp_count(text, F.lit(r"[*#$%&!|~^<>{}=_\\]")) / words,
        "capitals": F.regexp_count(text, F.lit(r"[A-Z]")) / chars,
        "digits": F.regexp_count(text, F.lit(r"[0-9]")) / chars,
        "variety": F.size(F.array_distinct(F.split(text, " "))) / words,
        "lines": F.regexp_count(text, F.lit(r"\n")) / words,
        "word_length": chars / words / F.lit(10.0),
        "length": F.log10(chars) / F.lit(5.0),
    }


@dataclass(frozen=True)
class Model:
    """Weights of the standardised measures; ``base`` is the log odds of the fitted share of good documents."""

    names: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    base: float

    def evidence(self, text: Column) -> Column:
        """Log likelihood ratio of good against bad, given the text; null and empty text: 0."""
        values = measures(text)
        total = F.lit(self.intercept - self.base)
        for name, weight in zip(self.names, self.weights, strict=True):
            total = total + F.lit(weight) * values[name]
        limited = F.least(F.greatest(total, F.lit(-EVIDENCE)), F.lit(EVIDENCE))
        return F.when(F.length(text) > 0, limited).otherwise(F.lit(0.0))


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, id: str = "doc_id", text: str = "text", steps: int = 30
) -> Model:
    """Logistic regression on at most ``rows`` labelled documents, by Newton steps with a small ridge.

    Documents without a 0/1 ``quality`` label, null and empty texts take no
    part. Without documents of both labels the model gives evidence 0.
    """
    named = labels.select(F.col(id).alias("label_id"), F.col("quality").alias("good")).where(F.col("good").isin(0, 1))
    chosen = (
        named.orderBy(F.xxhash64("label_id"), "label_id", "good").limit(rows).dropDuplicates(["label_id"])
    )
    body = docs.select(docs[f"`{id}`"].alias("label_id"), docs[f"`{text}`"].alias("body")).where(F.length("body") > 0)
    names = tuple(measures(F.col("body")))
    sample = body.join(F.broadcast(chosen), "label_id").select(
        F.col("good").cast("double").alias("good"), *[v.alias(k) for k, v in measures(F.col("body")).items()]
    )
    table = np.array([list(r) for r in sample.collect()], dtype=float).reshape(-1, len(names) + 1)
    good, x = table[:, 0], table[:, 1:]
    share = good.mean() if len(good) else 0.0
    if not 0 < share < 1:
        return Model(names, (0.0,) * len(names), 0.0, 0.0)
    middle, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - middle) / spread]
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-6] + [1e-2 * len(x) ** 0.5] * len(names))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w)), z.T @ (good - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[1:] / spread
    return Model(
        names, tuple(map(float, weights)), float(w[0] - weights @ middle), float(np.log(share / (1 - share)))
    )


def strength(between: Column, mean: Column, size: Column) -> Column:
    """Pseudo-documents of a beta prior by moments: the more alike the groups, the stronger."""
    variance = mean * (1 - mean)
    spread = F.greatest(between - variance / F.greatest(size, F.lit(1.0)), F.lit(1e-9))
    return F.least(F.greatest(variance / spread - 1, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))


def site_priors(votes: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, path_n, path_good, host_mean, path_strength) for each path, and the global share of good.

    ``votes`` has host, path and vote, the probability that a document is good
    by its own evidence and even odds. All steps are grouped aggregates.
    """
    paths = materialize(
        votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("path_n"), F.sum("vote").alias("path_good")), "paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_good").alias("host_good"))
    top = hosts.agg(
        F.sum("host_good").alias("good"),
        F.sum("host_n").alias("n"),
        F.sum(F.col("host_good") * F.col("host_good") / F.col("host_n")).alias("squares"),
        F.count(F.lit(1)).alias("groups"),
    ).first()
    n = float(top["n"] or 0)
    mean = min(max(float(top["good"] or 0) / n, 1e-3), 1 - 1e-3) if n else 0.5
    between = float(top["squares"] or 0) / n - mean * mean if n else 0.0
    spread = max(between - mean * (1 - mean) * top["groups"] / n, 1e-9) if n else 1e-9
    strong = min(max(mean * (1 - mean) / spread - 1, STRENGTH[0]), STRENGTH[1])
    shrunk = hosts.select(
        F.col("host").alias("of"),
        "host_n",
        "host_good",
        ((F.col("host_good") + F.lit(strong * mean)) / (F.col("host_n") + F.lit(strong))).alias("host_mean"),
    )
    joined = paths.join(bounded(shrunk), F.col("host").eqNullSafe(F.col("of")))
    of_host = joined.groupBy(F.col("host").alias("at")).agg(
        (F.sum(F.col("path_n") * F.pow(F.col("path_good") / F.col("path_n") - F.col("host_mean"), 2)) / F.sum("path_n")).alias(
            "between"
        ),
        (F.sum("path_n") / F.count(F.lit(1))).alias("size"),
        F.first("host_mean").alias("mean"),
    )
    strengths = of_host.select("at", strength(F.col("between"), F.col("mean"), F.col("size")).alias("path_strength"))
    priors = joined.join(bounded(strengths), F.col("host").eqNullSafe(F.col("at"))).select(
        "host", "path", "path_n", "path_good", "host_mean", "path_strength"
    )
    return priors, mean


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def quality_posterior(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    rows: int = FIT_ROWS,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    model: Model | None = None,
) -> DataFrame:
    """All columns of ``docs`` with ``evidence``, ``site_prior``, ``posterior`` and ``keep`` behind them.

    ``host`` and ``path`` name the columns of the two site levels; a null is a
    site of its own. Null and empty text carries no evidence, so its posterior
    is the site's prior. ``keep`` is posterior >= ``threshold``. Repeated rows
    vote each for itself and get equal results. Without usable labels every
    evidence is 0 and everything is kept. An empty table gives an empty table.
    """
    own = Guarded(docs)
    fitted = model or fit(docs, labels, rows, id, text)
    scored = own.df.withColumns(
        {"evidence": fitted.evidence(own.col(text)), "host": own.col(host), "path": own.col(path)}
    )
    vote = 1 / (1 + F.exp(-F.col("evidence")))
    votes = scored.where(F.length(own.col(text)) > 0).select("host", "path", vote.alias("vote"))
    priors, mean = site_priors(votes)
    site = priors.select(
        F.col("host").alias("site_host"), F.col("path").alias("site_path"), "path_n", "path_good", "host_mean", "path_strength"
    )
    joined = scored.join(
        bounded(site), F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")), "left"
    )
    counted = F.when(F.length(own.col(text)) > 0, 1.0).otherwise(0.0)
    prior = (F.col("path_good") - counted * vote + F.col("path_strength") * F.col("host_mean")) / (
        F.col("path_n") - counted + F.col("path_strength")
    )
    bounded_prior = F.least(F.greatest(F.coalesce(prior, F.lit(mean)), F.lit(0.01)), F.lit(0.99))
    return (
        joined.withColumn("site_prior", bounded_prior)
        .withColumn("posterior", 1 / (1 + F.exp(-(F.col("evidence") + log_odds(F.col("site_prior"))))))
        .select(*own.restored(), "evidence", "site_prior", "posterior", (F.col("posterior") >= threshold).alias("keep"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject, with the columns they came with."""
    own = Guarded(docs)
    judged = quality_posterior(docs, labels, **options)
    n = len(own.names)
    return judged.toDF(*[f"c{i}" for i in range(n)], "evidence", "site_prior", "posterior", "keep").where("keep").select(
        *own.restored()
    )
