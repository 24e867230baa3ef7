"""Line-level deduplication: lines that many documents share are removed.

Lines are exploded with their position, normalised and hashed to 128 bits;
distinct documents per hash are counted in two partial aggregates; only the
positions of frequent lines travel back to their document, where the kept
positions are read from the split text. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.text import SPACE, Guarded, ascii_lower
from tenura.settings import materialize


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with the shared lines cut from ``text``, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased.
    Every line whose key has at least ``min_chars`` code points and occurs in
    at least ``min_docs`` documents goes, in every document. The other lines
    stay in order, joined by a line feed.

    Null and empty text is one empty line and gives ''. A document is its
    id: rows that repeat an id count once for ``min_docs``, each still gives
    its own row; rows with a null id count as one document. An empty table
    gives an empty table. Columns of ``docs`` named n_lines or n_dropped come
    back under the same name beside the new ones, which stand last.
    """
    own = Guarded(docs)
    whole = F.coalesce(own.col(text), F.lit(""))
    row = own.df.select(
        *[c for c in own.df.columns if c != f"c{own.names.index(text)}"],
        own.col(id).alias("id"),
        F.xxhash64(whole).alias("version"),
        F.split(whole, "\n", -1).alias("lines"),
    )
    key = line_key(F.col("line"))
    lines = materialize(
        row.select("id", "version", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line"))
        .select("id", "version", "n", "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "version", "n", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")),
        "lines",
    )
    counts = lines.select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"))
    # written before it is joined, so that the join has plain shuffles and a line of many documents can be split
    frequent = materialize(counts.where(F.col("docs") >= min_docs).select("h1", "h2"), "frequent-lines")
    kept = (
        lines.join(frequent, ["h1", "h2"])
        .groupBy("id", "version", "n")
        .agg(F.collect_set("pos").alias("gone"))
        .select(
            F.col("id").alias("kept_id"),
            F.col("version").alias("kept_version"),
            F.array_except(F.sequence(F.lit(0), F.col("n") - 1), F.col("gone")).alias("kept"),
        )
    )
    joined = row.join(
        kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("version") == F.col("kept_version")), "left"
    )
    lines_left = F.when(F.col("kept").isNull(), F.col("lines")).otherwise(
        F.transform("kept", lambda i: F.get(F.col("lines"), i))
    )
    dropped = F.when(F.col("kept").isNull(), 0).otherwise(F.size("lines") - F.size("kept"))
    return joined.withColumn("left_text", F.array_join(lines_left, "\n")).select(
        *own.with_text(text, F.col("left_text")),
        F.size("lines").cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
    )
