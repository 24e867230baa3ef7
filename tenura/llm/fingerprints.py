"""Document fingerprints from prefix polynomial hashes.

For each text two modular prefix arrays are kept, H[i] = sum of code[j] * B^j
over j < i, modulo two primes of 31 bits. Any span's hash follows from two
entries, so equality of spans is a constant-time test and the longest common
extension of two positions a binary search. A fingerprint is the hash of the
whole text and the smallest scrambled hashes of all its spans of a fixed
width; the share of common smallest hashes estimates how much two texts have
in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.text import mix

#: two primes below 2^31 and a base for each
MODULI = (2147483647, 2147483629)
BASES = (1103515245, 747796405)

#: code points of a span by the length a text has at least
WIDTHS = ((48, 12), (16, 4), (0, 1))

#: span hashes kept in a fingerprint, and blocks of a text at most
KEPT, BLOCKS = 48, 16

#: documents of one range of ids, on average, and ranges at most; a task streams its ranges
RANGE_ROWS, RANGES = 4096, 10_000


class _Powers:
    """Powers of a base and of its inverse modulo a prime, extended as texts get longer."""

    def __init__(self, base: int, modulus: int):
        self.base, self.inverse, self.modulus = base, pow(base, -1, modulus), modulus
        self.up = self.down = np.ones(1, np.int64)

    def _more(self, table: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(table) < n:
            table = np.concatenate([table, table * pow(base, len(table), self.modulus) % self.modulus])
        return table

    def reach(self, n: int) -> None:
        self.up, self.down = self._more(self.up, self.base, n), self._more(self.down, self.inverse, n)


_POWERS = [_Powers(b, m) for b, m in zip(BASES, MODULI, strict=True)]


class PrefixHashes:
    """Prefix arrays of one text; positions are code points."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
        self.n = len(codes)
        self.prefix = []
        for powers in _POWERS:
            powers.reach(self.n + 1)
            terms = codes * powers.up[: self.n] % powers.modulus
            self.prefix.append(np.concatenate([np.zeros(1, np.int64), np.cumsum(terms) % powers.modulus]))

    def span(self, start: int, length: int) -> tuple[int, ...]:
        """Hash of ``length`` code points from ``start``, whatever the position."""
        return tuple(
            int((h[start + length] - h[start]) % p.modulus * p.down[start] % p.modulus)
            for h, p in zip(self.prefix, _POWERS, strict=True)
        )

    def spans(self, width: int) -> np.ndarray:
        """Hashes of all spans of a width, as 62-bit numbers; of the whole text if it is shorter."""
        width = min(width, self.n)
        if not width:
            return np.empty(0, np.uint64)
        parts = [
            ((h[width:] - h[: self.n - width + 1]) % p.modulus * p.down[: self.n - width + 1] % p.modulus).astype(np.uint64)
            for h, p in zip(self.prefix, _POWERS, strict=True)
        ]
        return (parts[0] << np.uint64(31)) | parts[1]

    def common(self, other: PrefixHashes, start: int = 0, other_start: int = 0) -> int:
        """Length of the longest common extension from two positions, by binary search."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, middle) == other.span(other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low


def smallest(hashes: np.ndarray, kept: int = KEPT) -> np.ndarray:
    """The ``kept`` smallest distinct values, sorted."""
    if len(hashes) > 8 * kept:
        low = np.unique(np.partition(hashes, 4 * kept)[: 4 * kept])
        if len(low) >= kept:
            return low[:kept]
    return np.unique(hashes)[:kept]


def block_size(n: int) -> int:
    """The power of two that cuts ``n`` code points into at most BLOCKS blocks."""
    return 1 << max(0, (-(-n // BLOCKS) - 1).bit_length())


def fingerprint(hashes: PrefixHashes) -> str:
    """Whole hash and length, block hashes, smallest span hashes, with colons between, in hexadecimal."""
    n, size = hashes.n, block_size(hashes.n)
    whole = hashes.span(0, n)
    blocks = [hashes.span(at, min(size, n - at)) for at in range(0, n, size)]
    folded = mix(np.array([(a << 31) | b for a, b in blocks], np.uint64)) >> np.uint64(32)
    width = next(w for least, w in WIDTHS if n >= least)
    kept = np.unique(smallest(mix(hashes.spans(width))) >> np.uint64(32))
    head = "".join(f"{v:08x}" for v in whole) + f"{n:x}"
    return ":".join([head, folded.astype(">u4").tobytes().hex(), kept.astype(">u4").tobytes().hex()])


def likeness(one: str, other: str) -> float:
    """From 0 to 1: the larger of two shares; 1 for equal fingerprints.

    One is the share of code points in blocks that are equal at their place
    (if both texts have the same block size), the other the share of common
    values among the smallest span hashes of both.
    """
    if one == other:
        return 1.0
    parts = [f.split(":") for f in (one, other)]
    lengths = [int(p[0][16:], 16) for p in parts]
    a, b = ({p[2][i : i + 8] for i in range(0, len(p[2]), 8)} for p in parts)
    union = sorted(a | b)[: max(len(a), len(b), 1)]
    share = sum(v in a and v in b for v in union) / len(union) if union else 0.0
    size = block_size(lengths[0])
    if size == block_size(lengths[1]):
        x, y = ([p[1][i : i + 8] for i in range(0, len(p[1]), 8)] for p in parts)
        equal = sum(min(size, min(lengths) - k * size) for k, (u, v) in enumerate(zip(x, y, strict=False)) if u == v)
        share = max(share, equal / max(*lengths, 1))
    return share


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, text_sha256 string, common_edited long, common_next long, next_id long"
)
_NULL_ID = -(2**63)


def _ranges(ids: DataFrame) -> tuple[list[int], dict[int, int]]:
    """Lowest bound of each range of ids, descending; for the first id of a range, the range before it.

    As many numbers as ranges reach the driver, at most RANGES.
    """
    count = max(1, min(RANGES, ids.count() // RANGE_ROWS))
    cut = (
        ids.distinct()
        .repartitionByRange(count, F.col("id").desc())
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.max("id").alias("first"), F.min("id").alias("last"))
        .collect()
    )
    cut = sorted(cut, key=lambda r: -r["first"])
    return [r["last"] for r in cut], {r["first"]: (k - 1) % len(cut) for k, r in enumerate(cut)}


def fingerprint_successors(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its text edited with the next document (columns: SCHEMA).

    The next document is the one with the next smaller id, after the last the
    first; rows with equal ids follow each other in the order of their texts.
    The edited text has the last third (floor) of the code points replaced by
    as many first ones of the next document, or all it has. ``common_edited``
    and ``common_next`` are the lengths of the common beginnings.

    ``id`` is an integer column; a null id counts as the smallest and stays
    null. Null text is empty; two empty texts have likeness 1, an empty and
    another 0. A lone document is its own next. An empty table gives an empty
    table. Only the two named columns are read.

    Documents are dealt to ranges of ids; the first document of a range is
    also sent to the range before it, so that each range is streamed alone,
    two texts at a time.
    """
    base = docs.select(
        F.coalesce(docs[f"`{id}`"].cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.coalesce(docs[f"`{text}`"], F.lit("")).alias("body"),
    )
    lows, copied = _ranges(base.select("id"))
    rising = np.array(lows[::-1], np.int64)
    firsts = np.array(sorted(copied), np.int64)
    targets = np.array([copied[f] for f in sorted(copied)], np.int64)

    @F.pandas_udf("array<int>")
    def places(ids):
        ids = ids.to_numpy(np.int64)
        own = len(rising) - np.searchsorted(rising, ids, "right")
        at = np.minimum(np.searchsorted(firsts, ids), max(len(firsts) - 1, 0))
        return pd.Series(
            [[o, t] if f == i else [o] for o, f, i, t in zip(own, firsts[at], ids, targets[at], strict=True)]
        )

    dealt = base.select("id", "body", F.posexplode(places("id")).alias("copy", "range"))
    n = max(1, len(lows))
    streamed = dealt.repartition(n, "range").sortWithinPartitions(
        "range", F.col("copy"), F.col("id").desc(), "body"
    )
    return streamed.select("range", "copy", "id", "body").mapInArrow(_stream, SCHEMA).select(
        F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")).alias("doc_id"),
        *[F.col(c.split()[0]) for c in SCHEMA.split(", ")[1:-1]],
        F.when(F.col("next_id") != _NULL_ID, F.col("next_id")).alias("next_id"),
    )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    before = None
    out: list[tuple] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for place, copy, key, body in zip(*[part.column(i).to_pylist() for i in range(4)], strict=True):
                hashes = PrefixHashes(body)
                here = (place, copy, key, body, hashes, fingerprint(hashes))
                if before and before[0] == place and not before[1]:
                    out.append(_compare(before, here))
                before = here
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)))
                out = []


def _compare(one: tuple, after: tuple) -> tuple:
    _, _, key, body, hashes, mark = one
    n = len(body)
    edited = body[: n - n // 3] + after[3][: n // 3]
    edited_hashes = PrefixHashes(edited)
    edited_mark = fingerprint(edited_hashes)
    return (
        key, n, _sha(edited), mark, edited_mark, likeness(mark, edited_mark), likeness(mark, after[5]),
        _sha(body), hashes.common(edited_hashes), hashes.common(after[4]), after[2],
    )

