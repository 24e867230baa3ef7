"""Spelling variants of the words of a corpus by an index of variable-length grams.

Grams are read from the start of a word and, in the reversed word, from its
end; a gram's list holds the words that have it at the same offset. The gram
dictionary is grown level by level: only grams with more than ``LIST`` words
are lengthened, so it holds the frequent grams, and a word is decomposed at
each offset into the shortest gram that is not in it. These grams have short
lists.

One edit affects the grams that cover its place. A gram counted from the start
is intact if the place lies behind it, one counted from the end if the place
lies before it. Each word therefore merges two lists: that of its grams from
the start which ends first, and that of its grams from the end which begins
last. Where the two overlap, an edit between them can affect both; only for the
places in that overlap does the word go into a second index, under its text
without the letter of that place. So two near words always meet, in a list of
at most ``LIST`` words or under a text that bounds the group by the alphabet,
and every candidate is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.text import ascii_lower
from tenura.settings import materialize

#: letters of a run before A-Z are lower-cased: ASCII letters and U+00C0 to U+00FF
RUNS = "[A-Za-zÀ-ÿ]+"

#: words that a list may hold before its gram is lengthened
LIST = 64

#: letters of the shortest and the longest gram; six letters, the offset and the side fill 64 bits
SHORTEST, LONGEST = 2, 6

#: grams that the dictionary holds at most (8 MB); beyond, the longest lists stay in it and others grow
DICTIONARY = 1_000_000

#: words that a task takes
WORDS = 20_000

_KEPT = 4_000_000  # grams that a task counts before it hands them on
_KEYS = "key long, word string"


def word_counts(
    docs: DataFrame, least_letters: int = 5, least_count: int = 3, every: int = 97, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(word, n) of the runs of letters in all texts, A-Z lower-cased.

    Every run whose crc32 with its document's id is divisible by ``every``
    loses one letter first, at the place of the same number modulo its length.
    Null text has no runs; a null id counts as an empty one.
    """
    runs = docs.select(
        F.coalesce(docs[id].cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(ascii_lower(docs[text]), F.lit(RUNS), 0)).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")
    return (
        hashed.select(word)
        .where(F.length("word") >= least_letters)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_count)
    )


# ---- grams as numbers: six letters of one byte, the offset and the side


class Letters:
    """The letters of many words in one array, each word followed by zeros, from the start or from the end."""

    def __init__(self, words: list[str], side: int):
        raw = [word.encode("latin-1") for word in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        joined = bytes(LONGEST).join(r[::-1] for r in raw) if side else bytes(LONGEST).join(raw)
        self.letters = np.frombuffer(joined + bytes(2 * LONGEST), np.uint8)
        starts = np.cumsum(sizes + LONGEST) - sizes - LONGEST
        self.word = np.repeat(np.arange(len(raw)), sizes)
        self.offset = np.arange(len(self.word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.at = np.repeat(starts, sizes) + self.offset
        self.left = sizes[self.word] - self.offset
        self.tail = ((self.offset % 2**15).astype(np.uint64) << np.uint64(1)) | np.uint64(side)

    def grams(self, length: int, chosen: np.ndarray) -> np.ndarray:
        """The grams of ``length`` letters at the chosen places."""
        value = np.zeros(len(chosen), np.uint64)
        for k in range(length):
            value = (value << np.uint64(8)) | self.letters[self.at[chosen] + k].astype(np.uint64)
        return (value << np.uint64(16)) | self.tail[chosen]

    def frequent(self, length: int, dictionary: np.ndarray) -> np.ndarray:
        """The places where a gram of ``length`` letters begins whose shorter beginnings are all in the dictionary."""
        places = np.flatnonzero(self.left >= length)
        for shorter in range(SHORTEST, length):
            places = places[found(self.grams(shorter, places), dictionary)]
        return places


def found(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    return ordered[np.minimum(at, len(ordered) - 1)] == values


def _count(length: int, dictionary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def counted():
            grams, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

        for batch in batches:
            words = batch.column(0).to_pylist()
            for side in (0, 1):
                letters = Letters(words, side)
                waiting.append(letters.grams(length, letters.frequent(length, dictionary.value)))
                size += len(waiting[-1])
            if size > _KEPT:
                yield counted()
                waiting, size = [], 0
        if size:
            yield counted()

    return run


def gram_dictionary(words: DataFrame, longest_list: int = LIST, largest: int = DICTIONARY) -> np.ndarray:
    """The grams with more than ``longest_list`` words whose beginnings are in it too, as sorted numbers.

    If they are more than ``largest``, the bound on the lists is raised until
    they fit, for all lengths alike, so the size of what is sent to the tasks
    is bounded.
    """
    context = words.sparkSession.sparkContext
    known, many = np.empty(0, np.uint64), np.empty(0, np.int64)
    for length in range(SHORTEST, LONGEST + 1):
        sent = context.broadcast(known)
        counts = words.select("word").mapInArrow(_count(length, sent), "gram long, n long")
        frequent = materialize(counts.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > longest_list), "grams")
        # one row for each different number of words
        sizes = sorted(((r["n"], r["grams"]) for r in frequent.groupBy("n").agg(F.count(F.lit(1)).alias("grams")).collect()), reverse=True)
        total = len(known)
        for n, grams in sizes:
            total += grams
            if total > largest:
                longest_list = n
                break
        keep = many > longest_list
        new = frequent.where(F.col("n") > longest_list).toPandas()
        grams = np.r_[known[keep], new["gram"].to_numpy(np.int64).view(np.uint64)]
        many = np.r_[many[keep], new["n"].to_numpy(np.int64)]
        order = np.argsort(grams)
        known, many = grams[order], many[order]
        if not len(new):
            break
    return known


def decomposed(words: list[str], dictionary: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For the start and the end: (word, gram, last offset + 1) of each variable-length gram."""
    sides = []
    for side in (0, 1):
        letters = Letters(words, side)
        places = np.flatnonzero(letters.left >= SHORTEST)
        parts = []
        for length in range(SHORTEST, LONGEST + 1):
            grams = letters.grams(length, places)
            inside = found(grams, dictionary)
            done = places[~inside]
            parts.append((letters.word[done], grams[~inside], letters.offset[done] + length))
            places = places[inside]
            places = places[letters.left[places] > length]
        sides.append(tuple(np.concatenate(c) for c in zip(*parts, strict=True)))
    return sides


def first_ends(n: int, side: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Of each of ``n`` words the gram that ends first (of those the longest) and where; no gram ends at a large number."""
    word, gram, end = side
    order = np.lexsort((-gram.astype(np.float64), end, word))
    word, gram, end = word[order], gram[order], end[order]
    head = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.empty(0, np.int64)
    ends, grams = np.full(n, 2**31), np.zeros(n, np.uint64)
    ends[word[head]], grams[word[head]] = end[head], gram[head]
    return ends, grams


def _lists(dictionary, probes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for side in decomposed(words, dictionary.value):
                if probes:
                    ends, grams = first_ends(len(words), side)
                    here = np.flatnonzero(ends < 2**31)
                    keys = grams[here]
                else:
                    here, keys = side[0], side[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), batch.column(0).take(pa.array(here))], names=["key", "word"]
                )

    return run


def _gaps(dictionary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            start, end = decomposed(words, dictionary.value)
            before, _ = first_ends(len(words), start)
            after, _ = first_ends(len(words), end)
            texts, own = [], []
            for word, first, last in zip(words, before.tolist(), after.tolist(), strict=True):
                size = len(word)
                low, high = (size - last if last <= size else -1), (first if first <= size else size + 1)
                if high > low:
                    cut = {word, *[word[:x] + word[x + 1 :] for x in range(max(low, 0), min(high, size))]}
                    texts += cut
                    own += [word] * len(cut)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(own, pa.string())], names=["rest", "word"])

    return run


def near_words(words: DataFrame, longest_list: int = LIST, largest: int = DICTIONARY) -> DataFrame:
    """(a, b), a < b, of all words that differ by one inserted, deleted or replaced letter, each pair once.

    ``words`` holds different words of letters up to U+00FF, none null.
    """
    spark = words.sparkSession
    total = words.count()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // WORDS + 1)
    # written by a fixed number of tasks, since few bytes of words are much work
    own = materialize(words.select("word").repartition(max(2, total // WORDS + 1), "word"), "words")
    dictionary = spark.sparkContext.broadcast(gram_dictionary(own, longest_list, largest))
    index = own.mapInArrow(_lists(dictionary, False), _KEYS).repartition(tasks, "key")
    probes = own.mapInArrow(_lists(dictionary, True), _KEYS).withColumnRenamed("word", "other").repartition(tasks, "key")
    gaps = own.mapInArrow(_gaps(dictionary), "rest string, word string").repartition(tasks, "rest")
    by_gram = probes.join(index, "key").where("word != other")
    by_rest = gaps.withColumnRenamed("word", "other").join(gaps, "rest").where("word < other")
    candidates = by_gram.select("word", "other").unionAll(by_rest.select("word", "other"))
    verified = candidates.where(F.levenshtein("word", "other", 1) == 1)
    return materialize(
        verified.select(F.least("word", "other").alias("a"), F.greatest("word", "other").alias("b")).distinct(), "near-words"
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each (word, form): where following forms ends. Steps double each round."""
    links = materialize(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        ahead = links.select(F.col("word").alias("middle"), F.col("root").alias("beyond"))
        jumped = materialize(
            links.join(ahead, F.col("root") == F.col("middle"), "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ),
            "links",
        )
        links = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return links


def spelling_variants(words: DataFrame, times: int = 2, longest_list: int = LIST, largest: int = DICTIONARY) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each (word, n).

    Words are near if one inserted, deleted or replaced letter turns one into
    the other. A word's form is its near word of largest n, of equal ones the
    first in code-point order, if that n is at least ``times`` the word's own;
    its root is where following forms ends. ``times`` must be above 1, so that
    forms can not go in circles. An empty table gives an empty table.
    """
    if times <= 1:
        raise ValueError("times must be above 1")
    own = materialize(words.select("word", "n"), "counts")
    pairs = near_words(own, longest_list, largest)
    both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sized = both.join(own.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = sized.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("minus"), "b")).alias("best")
    )
    larger = -F.col("best.minus") >= F.col("n") * times
    formed = materialize(
        own.join(best, F.col("word") == F.col("a"), "left").select(
            "word",
            "n",
            F.when(larger, F.col("best.b")).alias("form"),
            F.when(larger, -F.col("best.minus")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
        ),
        "forms",
    )
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
