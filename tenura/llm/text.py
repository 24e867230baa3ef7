"""Column helpers and word hashing shared by the corpus operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: rows of a grouped table up to which its join side may be broadcast
BROADCAST_ROWS = 100_000

#: distinct words a Python worker remembers before it starts over
CACHED_WORDS = 400_000

_ASCII_LOWER = str.maketrans(UPPER, LOWER)


class Guarded:
    """A table whose columns are called c0, c1, ... so that helper columns can not clash with them."""

    def __init__(self, docs: DataFrame):
        self.schema = docs.schema
        self.names = docs.columns
        self.df = docs.toDF(*[f"c{i}" for i in range(len(self.names))])

    def col(self, name: str) -> Column:
        return F.col(f"c{self.names.index(name)}")

    def restored(self, **replaced: Column) -> list[Column]:
        """All columns under their names again, some with another value."""
        return [replaced.get(name, F.col(f"c{i}")).alias(name) for i, name in enumerate(self.names)]

    def with_text(self, name: str, value: Column) -> list[Column]:
        """All columns with text ``name`` replaced and ``n_chars``, if there, set to its length."""
        replaced = {name: value}
        if "n_chars" in self.names:
            replaced["n_chars"] = F.length(value).cast(self.schema[self.names.index("n_chars")].dataType)
        return self.restored(**replaced)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other code point kept. ASCII text takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it has been counted to be small; joined by shuffle otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ascii_words(text: str | None) -> list[str]:
    """Runs without ``[\\x20\\x09-\\x0D]``; other Unicode spaces belong to words."""
    if not text:
        return []
    for space in SPACE[1:]:
        if space in text:
            text = text.replace(space, " ")
    return [word for word in text.split(" ") if word]


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_ASCII_LOWER)


class WordHashes(dict):
    """64-bit word hashes, remembered; the memory is bounded by starting over."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shift and multiply rounds)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each run of ``size`` word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    value = words[:n].copy()
    for k in range(1, size):
        value = mix(value * _MULTIPLIER + words[k : k + n])
    return value
