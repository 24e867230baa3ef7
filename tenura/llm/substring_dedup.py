"""Substring deduplication with suffix automata of reference shards.

A window is a run of ``window`` words. Of each window the word run with the
smallest hash is its mark; neighbouring windows with the same mark form a
segment, so each window lies in one segment and equal windows have equal
marks. Segments whose mark only one document has are done. The others are
dealt to shards by their mark: a shard's distinct segments, each with the
first document that has it, are its reference, and its suffix automaton keeps
for every state the first document of its words. The segments are streamed
through it; the matching statistics, held at the window's length, name the
first document of each window.

The reference grows with the corpus, so an automaton is not broadcast to all
tasks but only to those that stream segments of its shard. A mark with too many
words for one shard is split into reference blocks, each met by all of the
mark's segments, which are split into blocks too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.text import Guarded, WordHashes, ascii_words, bounded, gram_hashes, mix
from tenura.settings import materialize

WINDOW, GRAM = 50, 6

#: words of the segments that one shard holds
SHARD_WORDS = 200_000

_HASHES = WordHashes()
_LAST = 2**63 - 1
_SEGMENTS = "id long, version long, start int, n int, mark long, content long"
_REFERENCE = "mark long, content long, first long, words string"
_RUNS = "mark long, content long, low int, high int, least long"


def segments(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of words, mark) of the segments of a text's word hashes."""
    windows = len(words) - window + 1
    if windows <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = mix(gram_hashes(words, min(gram, window)))
    span = window - min(gram, window) + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(1) + np.arange(windows)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    ends = np.r_[starts[1:], windows]
    return starts, ends - starts + window - 1, grams[at[starts]]


def _cut(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, versions, starts, sizes, marks, contents = [], [], [], [], [], []
                for key, version, body in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                    words = _HASHES.of(ascii_words(body))
                    start, n, mark = segments(words, window, gram)
                    raw = memoryview(words.tobytes())
                    contents += [xxhash.xxh3_64_intdigest(raw[8 * a : 8 * (a + b)]) for a, b in zip(start.tolist(), n.tolist(), strict=True)]
                    ids.append(np.full(len(start), key, np.int64))
                    versions.append(np.full(len(start), version, np.int64))
                    starts.append(start.astype(np.int32))
                    sizes.append(n.astype(np.int32))
                    marks.append(mark.view(np.int64))
                columns = [np.concatenate(c) for c in (ids, versions, starts, sizes, marks)]
                columns.append(np.array(contents, np.uint64).view(np.int64))
                names = [c.split()[0] for c in _SEGMENTS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted segments of each document, of repeated rows once for each task."""
    seen = set()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            rows = []
            for key, version, body, wanted in zip(*[part.column(i).to_pylist() for i in range(4)], strict=True):
                if (key, version) in seen:
                    continue
                seen.add((key, version))
                words = ascii_words(body)
                rows += [(w["mark"], w["content"], key, " ".join(words[w["start"] : w["start"] + w["n"]])) for w in wanted]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in _REFERENCE.split(", ")]
            )


class SuffixAutomaton:
    """Generalised suffix automaton over words; each state knows the first document its words occur in."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [_LAST]

    def _state(self, length: int, edges: dict[str, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.first.append(_LAST)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, word: str) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: str) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        here = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = here
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[here] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return here

    def add(self, words: list[str], document: int) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)
            if document < self.first[last]:
                self.first[last] = document

    def close(self) -> None:
        """Hand the first documents on to the states of shorter words, after the last text."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            link = self.link[state]
            if self.first[state] < self.first[link]:
                self.first[link] = self.first[state]

    def firsts(self, words: list[str], window: int) -> list[int]:
        """For each window of a text the first document that has it, the largest number if none has."""
        state = matched = 0
        found = []
        edges, link, length, first = self.next, self.link, self.length, self.first
        for k, word in enumerate(words):
            while state and word not in edges[state]:
                state = link[state]
                matched = length[state]
            if word in edges[state]:
                state = edges[state][word]
                matched += 1
            while state and length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if k >= window - 1:
                found.append(first[state] if matched >= window else _LAST)
        return found


def _stream(window: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        automaton = SuffixAutomaton()
        reference = rows[rows["reference"]]
        for words, first in zip(reference["words"], reference["first"], strict=True):
            automaton.add(words.split(" "), first)
        automaton.close()
        out = []
        streamed = rows[rows["streamed"]]
        for mark, content, words in zip(streamed["mark"], streamed["content"], streamed["words"], strict=True):
            firsts = np.array(automaton.firsts(words.split(" "), window), np.int64)
            cuts = np.r_[0, np.flatnonzero(firsts[1:] != firsts[:-1]) + 1, len(firsts)]
            out += [
                (mark, content, low, high, firsts[low])
                for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                if firsts[low] < _LAST
            ]
        return pd.DataFrame(out, columns=[c.split()[0] for c in _RUNS.split(", ")])

    return run


def _sharded(reference: DataFrame) -> DataFrame:
    """Each segment as reference and as stream, in its shard; marks over the size limit in blocks of their own."""
    sized = reference.withColumn("n", F.size(F.split("words", " ")))
    marks = sized.groupBy("mark").agg(F.sum("n").alias("n"))
    total = marks.agg(F.sum("n")).first()[0] or 0
    shards = int(total // SHARD_WORDS) + 1
    large = bounded(
        marks.where(F.col("n") > SHARD_WORDS).select("mark", F.ceil(F.col("n") / SHARD_WORDS).cast("int").alias("blocks"))
    )
    joined = reference.join(large, "mark", "left")
    shard = F.pmod(F.xxhash64("mark"), F.lit(shards))
    small = joined.where("blocks is null").select(
        *reference.columns, shard.alias("shard"), F.lit(0).alias("one"), F.lit(0).alias("other"),
        F.lit(True).alias("reference"), F.lit(True).alias("streamed"),
    )
    block = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    split = joined.where("blocks is not null").withColumns(
        {"own": block, "partner": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))}
    )
    halves = [
        split.select(
            *reference.columns, F.col("mark").alias("shard"), F.col(a).alias("one"), F.col(b).alias("other"),
            F.lit(is_reference).alias("reference"), F.lit(not is_reference).alias("streamed"),
        )
        for a, b, is_reference in (("own", "partner", True), ("partner", "own", False))
    ]
    return small.unionAll(halves[0]).unionAll(halves[1])


def _remove(window: int):
    def run(bodies: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for body, own in zip(bodies, spans, strict=True):
            words = ascii_words(body)
            total = len(words)
            if own is not None and len(own):
                gone = np.zeros(total + 1, np.int32)
                for span in own:
                    gone[span["low"]] += 1
                    gone[span["high"]] -= 1
                words = [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]
            rows.append((" ".join(words), total, total - len(words)))
        return pd.DataFrame(rows, columns=["text", "n_words", "n_removed"])

    return run


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of ``docs``, ``text`` without repeated passages, ``n_words``, ``n_removed`` and ``spans``.

    Words are separated by ASCII white space and compared as they are. A word
    goes if it lies in a run of ``window`` words that also occurs in a
    document with a smaller id, judged on the input. The kept words are joined
    by one space. ``spans`` lists the removed runs as (low, high) word
    positions; they may overlap.

    Null and empty text has no words and gives ''. ``id`` is an integer
    column; a null id counts as larger than all others. Rows that repeat an
    id do not remove each other's passages. An empty table gives an empty
    table. Columns of ``docs`` with the names of the new ones stand before
    them.
    """
    own = Guarded(docs)
    keyed = own.df.withColumns(
        {
            "id": F.coalesce(own.col(id).cast("long"), F.lit(_LAST)),
            "version": F.xxhash64(own.col(text)),
            "body": own.col(text),
        }
    )
    cut = materialize(keyed.select("id", "version", "body").mapInArrow(_cut(window, gram), _SEGMENTS), "segments")
    # written before it is joined, so that the join has plain shuffles and a mark of many documents can be split
    marks = cut.groupBy("mark").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    shared = materialize(marks.select("mark"), "shared-marks")
    found = materialize(cut.join(shared, "mark", "left_semi"), "shared")
    wanted = (
        found.groupBy("mark", "content")
        .agg(F.min(F.struct("id", "version", "start", "n")).alias("first"))
        .groupBy(F.col("first.id").alias("id"), F.col("first.version").alias("version"))
        .agg(F.collect_list(F.struct("mark", "content", F.col("first.start").alias("start"), F.col("first.n").alias("n"))).alias("wanted"))
    )
    bodies = keyed.select("id", "version", "body").join(wanted, ["id", "version"]).select("id", "version", "body", "wanted")
    # a segment of a repeated row may be there once for each task; its spans are collected as a set
    reference = materialize(bodies.mapInArrow(_fetch, _REFERENCE), "reference")
    runs = _sharded(reference).groupBy("shard", "one", "other").applyInPandas(_stream(window), _RUNS)
    spans = (
        found.join(materialize(runs, "runs"), ["mark", "content"])
        .where("least < id")
        .groupBy("id", "version")
        .agg(
            F.collect_set(
                F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") + window - 1).alias("high"))
            ).alias("spans")
        )
    )
    result = F.pandas_udf(_remove(window), "text string, n_words long, n_removed long")
    joined = keyed.join(spans, ["id", "version"], "left").withColumn("result", result("body", "spans"))
    return joined.select(
        *own.with_text(text, F.col("result.text")),
        F.col("result.n_words").alias("n_words"),
        F.col("result.n_removed").alias("n_removed"),
        "spans",
    )
