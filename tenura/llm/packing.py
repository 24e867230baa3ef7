"""Bulk-synchronous best-fit packing of documents into sequences of a fixed length.

Documents are tokenised and cut into pieces; what is packed is the narrow
table of their lengths. Size classes are handled from large to small. In each
step the pieces of a class and all gaps are range-sorted together by size and
swept upwards: a gap takes the largest piece below it that no smaller gap has
taken, so every piece goes to the closest gap that is still free. A range
sweeps alone; what it leaves open (gaps at its start, pieces at its end) is
matched across ranges by rank: only the two counts of each range go to the
driver. Gaps shrink and the step is repeated. The numbers of open pieces and
gaps of each size, which can not exceed the capacity, tell what a further
sweep would place; once that is less than one in a thousand open pieces, the
rest opens new sequences, filled one after the other. Where gaps hold many
pieces, a gap takes several at once: as many as of the largest size would
fit, by the ranks of the pieces and prefix sums of that number.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.text import CACHED_WORDS
from tenura.settings import materialize

CAPACITY = 4096
END = 1

#: the lower ends of the size classes below half a sequence, as parts of the capacity
CLASSES = (8, 32, 128)

#: sweeps end once another would place no more than this share of the open pieces (none, if fewer than 1,000 are open)
TAIL = 0.001

#: gaps take several pieces at once where that places this many times what a sweep does
SWEEPS = 4

#: pieces wait for the gaps of new sequences if they fit at least this share of them
WORTHWHILE = 0.25

_PIECES = "key long, id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokens(dict):
    """Token ids of a text between spaces, as little-endian bytes.

    The vocabulary's tokens never cross white space, so a text's ids are those
    of its parts in order. A part of plain characters goes to the model word
    by word, any other through the whole tokenizer. Bounded by starting over.
    """

    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.any_special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search
        self.special_letters = any(t.isalpha() for t in special)
        self.words: dict[str, bytes] = {}
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        self.shown = {b: chr(b) for b in shown}
        self.shown |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in self.shown)}
        self.word_by_word = self._checked()

    def _checked(self) -> bool:
        """Whether the short way gives the tokenizer's ids on a trial text; else only the whole tokenizer is used."""
        trial = "It's WORD-by-word: 12 naïve É÷×ª µßÿ don't_stop! Straße geß a1b2 ''s 'S x'll½²"
        self.word_by_word = True
        quick = b"".join(self._part(p) for p in trial.split(" "))
        return quick == self._whole(trial)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if len(self.words) >= CACHED_WORDS // 2:
            self.words.clear()
        shown = word if word.isascii() else "".join(map(self.shown.__getitem__, word.encode()))
        ids = self.words[word] = pack_ids([t.id for t in self.model.tokenize(shown)])
        return ids

    def _part(self, part: str) -> bytes:
        if not self.word_by_word:
            return self._whole(part)
        words = self.words
        if part.isascii():
            # letters alone are one word
            if part.isalpha() and not self.special_letters:
                low = part.lower()
                return words.get(low) or self._word(low)
            plain = self.PLAIN.fullmatch(part)
        else:
            plain = self.PLAIN.fullmatch(part) and unicodedata.is_normalized("NFC", part)
        if not plain or self.any_special(part):
            return self._whole(part)
        return b"".join([words.get(word) or self._word(word) for word in self.WORD.findall(part.lower())])

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
            self[""] = b""
        if len(part) > 64:
            return self._part(part)
        ids = self[part] = self._part(part)
        return ids

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@cache
def _tokens(file: str) -> WordTokens:
    return WordTokens(file)


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, id, piece, start, length, ids_crc32, ids) for each piece of each document; ``ids`` only if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(vocabulary)
        end = np.array([END], "<u4").tobytes()
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for doc, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    data = tokens.of(body or "") + end
                    for k, start in enumerate(range(0, len(data), 4 * capacity)):
                        own = data[start : start + 4 * capacity]
                        kept = np.frombuffer(own, "<u4").astype(np.int32) if ids else None
                        rows.append((key, doc, k, start // 4, len(own) // 4, zlib.crc32(own), kept))
                        key += 1
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                names = [c.split()[0] for c in _PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

    return docs.select(docs[f"`{id}`"].cast("long").alias("id"), docs[f"`{text}`"].alias("body")).mapInArrow(cut, _PIECES)


#: a step's rows: a piece (key, size) in a sequence at an offset, an open piece (seq null), an open gap (key null);
#: ``open`` is what the sequence has left after the row, null if another row says so
_STEP = "key long, size int, seq long, offset int, open int"
_SWEPT = f"{_STEP}, part int, rank long"
_SWEPT_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]


def _batch(rows: list[tuple], schema: str, types: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _sweep(capacity: int):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: list[tuple[int, int]] = []
        rows: list[tuple] = []
        gaps = 0
        for size, is_gap, name in _events(batches):
            if not is_gap:
                waiting.append((name, size))
            elif waiting:
                key, length = waiting.pop()
                rows.append((key, length, name, capacity - size, size - length, None, None))
            else:
                rows.append((None, None, name, None, size, part, gaps))
                gaps += 1
            if len(rows) >= 8192:
                yield _batch(rows, _SWEPT, _SWEPT_TYPES)
                rows = []
        rows += [(key, length, None, None, None, part, k) for k, (key, length) in enumerate(waiting)]
        for at in range(0, len(rows), 8192):
            yield _batch(rows[at : at + 8192], _SWEPT, _SWEPT_TYPES)

    return sweep


def _carried(counts: list[tuple[int, int, int]]) -> tuple[list[tuple], int]:
    """Runs that match open pieces with gaps of later ranges, and how many pieces stay open.

    ``counts``: (range, its open gaps, its open pieces). A gap takes the last
    open piece before it. A run is (number, range of the pieces, its highest
    rank, range of the gaps, its lowest rank, length); there are at most two
    for each range.
    """
    stack: list[list[int]] = []
    runs = []
    for part, gaps, open_pieces in sorted(counts):
        taken = 0
        while taken < gaps and stack:
            below, left = stack[-1]
            n = min(left, gaps - taken)
            runs.append((len(runs), below, left - 1, part, taken, n))
            taken += n
            stack[-1][1] -= n
            if not stack[-1][1]:
                stack.pop()
        if open_pieces:
            stack.append([part, open_pieces])
    return runs, sum(n for _, n in stack)


def _step(left: DataFrame, gaps: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """One sweep over the open pieces (key, size) and the gaps (seq, open): its rows and the pieces still open."""
    spark = left.sparkSession
    events = left.select("size", F.lit(False).alias("is_gap"), F.col("key").alias("name")).unionAll(
        gaps.select(F.col("open").alias("size"), F.lit(True).alias("is_gap"), F.col("seq").alias("name"))
    )
    swept = materialize(
        events.repartitionByRange("size", "is_gap", "name")
        .sortWithinPartitions("size", "is_gap", "name")
        .mapInArrow(_sweep(capacity), _SWEPT),
        "swept",
    )
    counts = (
        swept.where("part is not null").groupBy("part").agg(F.count("seq").alias("gaps"), F.count("key").alias("pieces"))
    )
    runs, still = _carried([tuple(r) for r in counts.collect()])
    names = [c.split()[0] for c in _STEP.split(", ")]
    if not runs:
        return swept.select(*names), still
    table = F.broadcast(
        spark.createDataFrame(runs, "run int, piece_part int, piece_top long, gap_part int, gap_low long, n long")
    )
    piece_at = F.col("piece_top") - F.col("rank")
    open_pieces = swept.where("part is not null and seq is null").join(
        table, (F.col("part") == F.col("piece_part")) & (piece_at >= 0) & (piece_at < F.col("n")), "left"
    ).select("key", "size", "run", piece_at.alias("at"))
    gap_at = F.col("rank") - F.col("gap_low")
    open_gaps = swept.where("part is not null and key is null").join(
        table, (F.col("part") == F.col("gap_part")) & (gap_at >= 0) & (gap_at < F.col("n")), "left"
    ).select("seq", F.col("open").alias("gap"), F.col("run").alias("gap_run"), gap_at.alias("gap_at"))
    across = open_pieces.where("run is not null").join(
        open_gaps.where("gap_run is not null"), (F.col("run") == F.col("gap_run")) & (F.col("at") == F.col("gap_at"))
    ).select("key", "size", "seq", (capacity - F.col("gap")).alias("offset"), (F.col("gap") - F.col("size")).alias("open"))
    nothing = F.lit(None).cast("long")
    rest = open_pieces.where("run is null").select(
        "key", "size", nothing.alias("seq"), nothing.cast("int").alias("offset"), nothing.cast("int").alias("open")
    ).unionAll(
        open_gaps.where("gap_run is null").select(
            nothing.alias("key"), nothing.cast("int").alias("size"), "seq", nothing.cast("int").alias("offset"), F.col("gap").alias("open")
        )
    )
    step = swept.where("part is null").select(*names).unionAll(across.select(*names)).unionAll(rest)
    return materialize(step, "step"), still


_COUNTED = "name long, size int, slots int, part int, before long"
_COUNTED_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]


def _before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        slots = batch.column(2).to_numpy().astype(np.int64)
        ends = before + np.cumsum(slots)
        columns = [*batch.columns, pa.array(np.full(len(slots), part, np.int32)), pa.array(ends - slots)]
        names = [c.split()[0] for c in _COUNTED.split(", ")]
        yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _COUNTED_TYPES, strict=True)], names=names)
        before = int(ends[-1]) if len(ends) else before


def _counted(rows: DataFrame, *order) -> tuple[DataFrame, int]:
    """Rows (name, size, slots) with ``at``, the sum of the slots before them in the order, and the sum of all."""
    counted = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_before, _COUNTED), "counted"
    )
    starts, total = [], 0
    for part, slots in sorted(tuple(r) for r in counted.groupBy("part").agg(F.sum("slots")).collect()):
        starts.append((part, total))
        total += slots
    table = F.broadcast(rows.sparkSession.createDataFrame(starts, "part int, start long"))
    return counted.join(table, "part").select("name", "size", "slots", (F.col("start") + F.col("before")).alias("at")), total


def _fill_gaps(left: DataFrame, gaps: DataFrame, count: int, top: int, capacity: int) -> tuple[DataFrame, int]:
    """As a step, but a gap takes as many pieces as it holds of ``top``, the largest size of all."""
    slots = F.floor(F.col("open") / top).cast("int")
    room = gaps.where(F.col("open") >= top)
    room, total = _counted(room.select(F.col("seq").alias("name"), F.col("open").cast("int").alias("size"), slots.alias("slots")), "size", "name")
    own, _ = _counted(
        left.select(F.col("key").alias("name"), "size", F.lit(1).alias("slots")), F.col("size").desc(), F.col("name")
    )
    taken = room.where(F.col("at") < count).select(
        F.col("name").alias("seq"),
        F.col("size").alias("gap"),
        F.explode(F.sequence(F.col("at"), F.least(F.col("at") + F.col("slots"), F.lit(count)) - 1)).alias("at"),
    )
    in_gap = Window.partitionBy("seq").orderBy("at")
    inside = F.sum("size").over(in_gap.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")
    filled = (
        own.where(F.col("at") < total)
        .join(taken, "at")
        .select("name", "size", "seq", "gap", inside.alias("inside"), F.lead("name").over(in_gap).isNull().alias("last"))
    )
    nothing, number = F.lit(None).cast("long"), F.lit(None).cast("int")
    step = (
        filled.select(
            F.col("name").alias("key"),
            "size",
            "seq",
            (capacity - F.col("gap") + F.col("inside") - F.col("size")).alias("offset"),
            F.when(F.col("last"), F.col("gap") - F.col("inside")).alias("open"),
        )
        .unionAll(own.where(F.col("at") >= total).select("name", "size", nothing, number, number))
        .unionAll(room.where(F.col("at") >= count).select(nothing, number, "name", number, "size"))
        .unionAll(gaps.where(F.col("open") < top).select(nothing, number, "seq", number, F.col("open").cast("int")))
    )
    return materialize(step, "step"), max(count - total, 0)


def _fill(capacity: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        seq, used = None, capacity + 1
        for key, size in _events(batches):
            if used + size > capacity:
                seq, used = key, 0
                if len(rows) >= 8192:
                    yield _batch(rows, _STEP, _SWEPT_TYPES[:5])
                    rows = []
            elif rows:
                rows[-1] = (*rows[-1][:4], None)
            rows.append((key, size, seq, used, capacity - used - size))
            used += size
        yield _batch(rows, _STEP, _SWEPT_TYPES[:5])

    return fill


def _open(left: DataFrame, capacity: int) -> DataFrame:
    """New sequences, each filled with one piece after the other, from the largest on."""
    return materialize(
        left.select("key", "size")
        .repartitionByRange(F.col("size").desc(), "key")
        .sortWithinPartitions(F.col("size").desc(), "key")
        .mapInArrow(_fill(capacity), _STEP),
        "opened",
    )


def _sizes(left: DataFrame, gaps: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Number of open pieces of each size and of gaps of each size: at most twice ``capacity`` rows."""
    both = left.select("size", F.lit(False).alias("is_gap")).unionAll(gaps.select("open", F.lit(True)))
    sizes: tuple[dict[int, int], dict[int, int]] = ({}, {})
    for size, is_gap, count in both.groupBy("size", "is_gap").count().collect():
        sizes[is_gap][size] = count
    return sizes


def _fitting(sizes: dict[int, int], gaps: dict[int, int]) -> int:
    """How many pieces one sweep places."""
    waiting = placed = 0
    for size in sorted(sizes.keys() | gaps.keys()):
        waiting += sizes.get(size, 0)
        taken = min(waiting, gaps.get(size, 0))
        placed, waiting = placed + taken, waiting - taken
    return placed


def _waiting(sizes: dict[int, int], capacity: int) -> tuple[int, int]:
    """(size, number of pieces up to it): the size from which on pieces wait for the gaps of new sequences.

    That is the largest one that fits the gaps of at least ``WORTHWHILE`` of
    the sequences which the larger pieces open; (0, 0) if there is none.
    """
    falling = sorted(sizes.items(), reverse=True)
    gaps: list[tuple[int, int]] = []
    for i, (size, count) in enumerate(falling):
        usable = sum(n for gap, n in gaps if gap >= size)
        if usable and usable >= WORTHWHILE * sum(n for _, n in gaps):
            return size, sum(n for _, n in falling[i:])
        each = capacity // size
        gaps.append((capacity - each * size, -(-count // each)))
    return 0, 0


def place(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(key, seq, offset) for each row (key long, unique; size int, 1 to ``capacity``) of ``lengths``."""
    bound = capacity // 2
    first = lengths.where(F.col("size") > bound).select(
        "key", "size", F.col("key").alias("seq"), F.lit(0).alias("offset"), (capacity - F.col("size")).alias("open")
    )
    placed, gaps = [first], first.where("open > 0")
    small = materialize(lengths.where(F.col("size") <= bound), "small")
    limits = [capacity // part for part in CLASSES] + [0]
    level = F.lit(len(limits) - 1)
    for k in reversed(range(len(limits) - 1)):
        level = F.when(F.col("size") > limits[k], k).otherwise(level)
    found = dict(small.groupBy(level.alias("level")).count().collect())
    for k, low in enumerate(limits):
        count = found.get(k, 0)
        if not count:
            continue
        left = small.where((F.col("size") > low) & (F.col("size") <= (limits[k - 1] if k else bound)))
        # gaps that no piece of the class fits: those a sweep leaves as they are find none later either
        idle = [gaps.where(F.col("open") <= low).select("seq", "open")]
        gaps = gaps.where(F.col("open") > low)
        while count:
            several = 0
            while count:
                # in a sweep, a gap that takes nothing is smaller than all open pieces
                if several:
                    step, count = _fill_gaps(left, gaps, count, top, capacity)
                else:
                    step, count = _step(left, gaps, capacity)
                placed.append(step.where("key is not null and seq is not null"))
                free = f"open > {low}" if several else f"key is not null and open > {low}"
                gaps, left = step.where(f"seq is not null and {free}"), step.where("seq is null")
                idle.append(step.where(f"seq is not null and open > 0 and not ({free})").select("seq", "open"))
                if not count:
                    break
                sizes, opens = _sizes(left, gaps)
                top, swept = max(sizes), _fitting(sizes, opens)
                several = sum(n * (gap // top) for gap, n in opens.items())
                if max(swept, several) <= TAIL * count:
                    break
                several = several if several > SWEEPS * swept else 0
            if count:
                # long pieces that fit the gaps of new sequences wait for them; the gaps that shorter pieces
                # leave are smaller than an eighth of a sequence and go to the next classes
                waiting, count = _waiting(sizes, capacity) if not k else (0, 0)
                opened = _open(left.where(F.col("size") > waiting), capacity)
                placed.append(opened)
                idle.append(opened.where(f"open > 0 and open <= {low}").select("seq", "open"))
                gaps = gaps.select("seq", "open").unionAll(opened.where(f"open > {low}").select("seq", "open"))
                left = left.where(F.col("size") <= waiting)
        gaps = gaps.select("seq", "open")
        for more in idle:
            gaps = gaps.unionAll(more)
    result = placed[0].select("key", "seq", "offset")
    for more in placed[1:]:
        result = result.unionAll(more.select("key", "seq", "offset"))
    return result


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    ids: bool = False,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): where each piece of each document lies.

    A document's tokens are those of ``vocabulary`` (a tokenizer file, the same
    path on all executors) and an end mark, so null and empty text is one
    token. Longer documents are cut every ``capacity`` tokens. ``id`` is an
    integer column, null allowed; repeated rows are packed each for itself. An
    empty table gives an empty table. Only the two named columns are read.
    """
    cut = pieces(docs, vocabulary, capacity, ids, id, text)
    cut = materialize(cut if ids else cut.drop("ids"), "pieces")
    where = place(cut.select("key", F.col("length").cast("int").alias("size")), capacity)
    columns = ["piece", "start", "length", "ids_crc32"]
    return cut.join(where, "key").select(
        F.col("id").alias("doc_id"),
        *columns,
        F.col("seq").alias("sequence_id"),
        F.col("offset").cast("long").alias("offset"),
        *(["ids"] if ids else []),
    )
