"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A document's signature has 32 symbols of 16 bits, each the scrambled minimum of
its shingles under one permutation. It is split into 8 chunks of 4 symbols. If
two signatures differ in at most 15 symbols, some chunk differs in at most one
of them (else there were 16 or more differences), so they meet under one of the
32 keys that a signature gets by leaving out one symbol of one chunk. Meeting
pairs are filtered by a longer signature and confirmed on the full sets.

Equal sets count once. To see the components, not every pair of a bucket has to
be looked at: first all members are compared with the bucket's most central
one, then only those pairs that the links found so far leave in different
components, in blocks of bounded size, of which only the links come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.components import components
from tenura.llm.text import Guarded, WordHashes, ascii_words, gram_hashes, lower_ascii, mix
from tenura.settings import materialize

WORDS = 5
CHUNKS, CHUNK = 8, 4
SYMBOLS = CHUNKS * CHUNK

#: symbols of the longer signature, one byte each
LONG = 256

#: members of one block of a bucket; pairs of blocks are compared in one task each
BLOCK = 1024

_rng = np.random.default_rng(20240229)
_ODD = _rng.integers(0, 2**63, LONG, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, LONG, np.uint64)
_HASHES = WordHashes()

_SIGNATURES = (
    "id long, row long, n long, h1 long, h2 long, " + ", ".join(f"chunk{c} long" for c in range(CHUNKS))
)
_SETS = "id long, n long, signature binary, members binary"


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of a text's runs of words, sorted; of all its words if there are fewer."""
    hashes = _HASHES.of(ascii_words(lower_ascii(text or "")))
    if not len(hashes):
        return hashes
    return np.unique(gram_hashes(hashes, min(words, len(hashes))) ^ np.uint64(min(words, len(hashes))))


def minima(members: np.ndarray, count: int) -> np.ndarray:
    """The scrambled minimum of a set under each of ``count`` permutations."""
    scrambled = mix(members)
    low = np.empty(count, np.uint64)
    for k in range(count):
        low[k] = (scrambled * _ODD[k] + _ADD[k]).min()
    return mix(low)


def _signed(value: np.ndarray) -> np.ndarray:
    return value.view(np.int64)


def _table(rows: list[tuple], types: list[pa.DataType], schema: str) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in schema.split(", ")]
    )


def _signatures(words: int):
    types = [pa.int64()] * (5 + CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for key, row, text in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                    members = shingles(text, words)
                    if not len(members):
                        rows.append((key, row, 0, *[None] * (2 + CHUNKS)))
                        continue
                    symbols = (minima(members, SYMBOLS) >> np.uint64(48)).reshape(CHUNKS, CHUNK)
                    chunks = np.bitwise_or.reduce(symbols << (np.arange(CHUNK, dtype=np.uint64) * np.uint64(16)), axis=1)
                    rows.append((key, row, len(members), *_content(members), *_signed(chunks).tolist()))
                yield _table(rows, types, _SIGNATURES)

    return run


def _content(members: np.ndarray) -> list[int]:
    """Two 64-bit hashes of a set, as signed numbers; the first is the key of its class."""
    digest = xxhash.xxh3_128_intdigest(members.tobytes())
    return _signed(np.array([digest >> 64, digest & (2**64 - 1)], np.uint64)).tolist()


def _full_sets(words: int):
    """The sets of the wanted classes, each once for a task; rows with the same row key come to one task."""
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for text, wanted in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if seen.issuperset(wanted):
                        continue
                    members = shingles(text, words)
                    key = _content(members)[0]
                    if key in seen or key not in wanted:
                        continue
                    seen.add(key)
                    signature = (minima(members, LONG) >> np.uint64(56)).astype(np.uint8).tobytes()
                    # six bytes of each hash tell two sets apart as well: a false match has odds of 1e-9 a pair
                    short = np.sort(members & np.uint64(2**48 - 1))
                    packed = short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                    rows.append((key, len(members), signature, packed))
                yield _table(rows, types, _SETS)

    return run


def _unpack(members: bytes) -> np.ndarray:
    wide = np.zeros((len(members) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(members, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def most_different(percent: int) -> int:
    """Unequal symbols of the long signature that a linked pair has at most (6 standard deviations).

    A pair exactly at the threshold has more with odds of about 1e-8 (85 percent) or 5e-9 (80 percent).
    """
    p = 1 - percent / 100
    return int(np.ceil(LONG * p + 6 * np.sqrt(LONG * p * (1 - p))))


def _different(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int32")
    left, right = (np.frombuffer(b"".join(x), np.uint8).reshape(len(x), LONG) for x in (a, b))
    return pd.Series((left != right).sum(1).astype(np.int32))


def _linked(percent: int):
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = _unpack(x), _unpack(y)
            common = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(out, dtype=bool)

    return linked


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("of_b"))
    return pairs.join(left, "a").join(right, "b").where(F.pandas_udf(_linked(percent), "boolean")("of_a", "of_b")).select("a", "b")


def _masks() -> list[tuple[int, int]]:
    """(chunk, bits kept) of each key, in the order of the tags."""
    return [(c, ~(0xFFFF << (16 * j)) & (2**64 - 1)) for c in range(CHUNKS) for j in range(CHUNK)]


def _rest_links(limit: int, percent: int):
    """Of two blocks of a bucket, confirmed links that join components.

    A pair is looked at in the first bucket it shares, if its documents are in
    different components by then and the long signatures do not rule it out,
    the likeliest pairs first. The links join components one by one, so there
    are fewer of them than documents.
    """
    masks = [(c, np.uint64(m)) for c, m in _masks()]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        signature = np.frombuffer(b"".join(rows["signature"]), np.uint8).reshape(len(rows), LONG)
        chunks = rows[[f"chunk{c}" for c in range(CHUNKS)]].to_numpy(np.int64).view(np.uint64)
        ids, roots, sizes, blocks = (rows[c].to_numpy() for c in ("id", "root", "n", "block"))
        members, unpacked = rows["members"].tolist(), {}
        first, second, tag = rows["first"].iloc[0], rows["second"].iloc[0], rows["tag"].iloc[0]
        one, other = blocks == first, blocks == second
        parts = []
        for i in np.flatnonzero(one):
            near = other & (roots != roots[i])
            if first == second:
                near &= ids > ids[i]
            near &= np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * percent
            at = np.flatnonzero(near)
            unequal = (signature[at] != signature[i]).sum(1)
            at, unequal = at[unequal <= limit], unequal[unequal <= limit]
            differ = chunks[at] ^ chunks[i]
            met = np.zeros(len(at), bool)
            for c, mask in masks[:tag]:
                met |= (differ[:, c] & mask) == 0
            parts.append(np.c_[unequal[~met], np.full((~met).sum(), i), at[~met]])
        pairs = np.concatenate(parts) if parts else np.empty((0, 3), np.int64)
        parent = {r: r for r in roots.tolist()}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def full(i: int) -> np.ndarray:
            if i not in unpacked:
                unpacked[i] = _unpack(members[i])
            return unpacked[i]

        found = []
        for _, i, j in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
            a, b = root(int(roots[i])), root(int(roots[j]))
            if a != b:
                x, y = full(i), full(j)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    parent[a] = b
                    found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _buckets(classes: DataFrame) -> DataFrame:
    """(tag, rest, id): each signature under each chunk with one symbol left out."""
    keys = [
        F.struct(
            F.lit(tag).cast("byte").alias("tag"),
            F.col(f"chunk{c}").bitwiseAND(F.lit(mask - 2**64 if mask >= 2**63 else mask)).alias("rest"),
        )
        for tag, (c, mask) in enumerate(_masks())
    ]
    return classes.select("id", F.explode(F.array(*keys)).alias("key")).select("key.tag", "key.rest", "id")


def _links(classes: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """(a, b): links between documents with different sets, enough to connect all that belong together."""
    members = _buckets(classes)
    shared = members.groupBy("tag", "rest").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(members.join(shared, ["tag", "rest"]), "buckets")
    central = members.groupBy("id").agg(F.sum("size").alias("weight"))
    weighted = members.join(central, "id")
    middle = weighted.groupBy("tag", "rest").agg(F.max(F.struct("weight", -F.col("id"))).alias("top")).select(
        "tag", "rest", (-F.col("top.col2")).alias("pivot")
    )
    wanted = classes.join(central.select("id"), "id").groupBy("row").agg(F.collect_set("id").alias("wanted"))
    # dealt by the row key, so that repeated rows meet and give their set once
    dealt = texts.repartition("row").join(wanted, "row").select("body", "wanted")
    sets = materialize(dealt.mapInArrow(_full_sets(words), _SETS), "sets")
    limit = most_different(percent)
    chunks = [f"chunk{c}" for c in range(CHUNKS)]
    marks = sets.select("id", "n", "signature")

    def likely(pairs: DataFrame) -> DataFrame:
        left, right = (marks.toDF(x, f"n_{x}", f"signature_{x}") for x in "ab")
        sized = pairs.join(left, "a").join(right, "b").where(
            F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
        )
        return sized.where(F.pandas_udf(_different, "int")("signature_a", "signature_b") <= limit).select("a", "b")

    star = members.join(middle, ["tag", "rest"]).where("id <> pivot").select(
        F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")
    )
    first = materialize(_confirmed(likely(star.distinct()), sets, percent), "links")
    roots = materialize(components(first), "roots")
    rooted = members.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "root", F.coalesce("root", "id")
    )
    open_buckets = (
        rooted.groupBy("tag", "rest")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("count"))
        .where("least <> most and count > 2")
        .select("tag", "rest", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocked = (
        rooted.join(open_buckets, ["tag", "rest"])
        .join(sets.join(classes.select("id", *chunks), "id"), "id")
        .select("tag", "rest", "id", "root", "n", "signature", "members", *chunks, "blocks", block.alias("block"))
        .withColumn("partner", partner)
        .withColumns({"first": F.least("block", "partner"), "second": F.greatest("block", "partner")})
    )
    second = blocked.groupBy("tag", "rest", "first", "second").applyInPandas(_rest_links(limit, percent), "a long, b long")
    return first.unionAll(materialize(second, "links"))


def near_components(
    docs: DataFrame, percent: int = 85, words: int = WORDS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each document.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    sets of distinct runs of ``words`` words (A-Z lower-cased, split at ASCII
    white space; all words as one run if there are fewer). ``component_id`` is
    the smallest id reachable over links, ``kept`` tells that it is the own.

    Null and empty text has an empty set and is linked with nothing. ``id`` is
    an integer column; rows that repeat an id are the same document if their
    texts are equal. A row with a null id takes part with no id of its own:
    it gets the component of its copies, null without any, and is kept only
    then. An empty table gives an empty table. Only the two named columns are
    read. ``percent`` below 70 is refused: the buckets do not guarantee it.
    """
    if percent < 70:
        raise ValueError("similarities below 70 percent need other chunks")
    signed, known = _classes(docs, percent, words, id, text)
    joined = signed.join(known, ["h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )


def _row_key(id: Column, text: Column) -> Column:
    """The id, for rows without one a hash of their text."""
    return F.coalesce(id.cast("long"), F.xxhash64(text))


def _classes(docs: DataFrame, percent: int, words: int, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, row, n, h1, h2) of every row, and (h1, h2, class_row, component, first) of every class of equal sets.

    A class is known by its content, h1; ``component`` is the smallest id of
    its component, null if no row there has one, and ``first`` tells that the
    class is the component's first by content.
    """
    texts = docs.select(
        docs[f"`{id}`"].cast("long").alias("id"),
        docs[f"`{text}`"].alias("body"),
        _row_key(docs[f"`{id}`"], docs[f"`{text}`"]).alias("row"),
    )
    signed = materialize(texts.select("id", "row", "body").mapInArrow(_signatures(words), _SIGNATURES), "signatures")
    chunks = [F.min(f"chunk{c}").alias(f"chunk{c}") for c in range(CHUNKS)]
    classes = materialize(
        signed.where("n > 0")
        .groupBy("h1", "h2")
        .agg(F.min("id").alias("least"), F.min("row").alias("row"), *chunks)
        .withColumn("id", F.col("h1")),
        "classes",
    )
    roots = components(_links(classes, texts, percent, words))
    rooted = materialize(
        classes.select("h1", "h2", "id", "least", "row")
        .join(roots, F.col("id") == F.col("node"), "left")
        .select("h1", "h2", "id", "least", "row", F.coalesce("root", "id").alias("root")),
        "rooted",
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component"), F.min("id").alias("head"))
    known = rooted.join(materialize(named, "components"), "root")
    return signed.select("id", "row", "n", "h1", "h2"), known.select(
        "h1", "h2", F.col("row").alias("class_row"), "component", (F.col("id") == F.col("head")).alias("first")
    )


def keep_one(
    docs: DataFrame, percent: int = 80, words: int = WORDS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents with the smallest id of each component, with their columns.

    Rows repeating an id stay or go together. Rows with a null id go if their
    component has an id; if it has none, one row of it stays. Null, empty and
    blank texts are linked with nothing and stay. An empty table gives an empty
    table.
    """
    own = Guarded(docs)
    signed, known = _classes(docs, percent, words, id, text)
    gone = (
        signed.where("id is not null and n > 0")
        .join(known, ["h1", "h2"])
        .where("id <> component")
        .select(F.col("id").alias("gone_id"))
        .distinct()
    )
    named = own.df.where(own.col(id).isNotNull()).join(gone, own.col(id) == F.col("gone_id"), "left_anti")
    nameless = own.df.where(own.col(id).isNull()).withColumn("row", _row_key(own.col(id), own.col(text)))
    blank = signed.where("id is null and n = 0").select("row").distinct()
    chosen = known.where("component is null and first").select(F.col("class_row").alias("row"))
    rest = nameless.join(blank, "row", "left_semi").unionByName(
        nameless.join(chosen, "row", "left_semi").dropDuplicates(["row"])
    )
    return named.select(*own.restored()).unionAll(rest.select(*own.restored()))
