"""Each operator against brute force on a small table of awkward documents."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import (
    ann,
    components,
    fingerprints,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    pseudonyms,
    quality,
    substring_dedup,
)
from tenura.llm.queries import vocabulary
from tenura.llm.text import ascii_words, lower_ascii

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id string, row int, lines int, kept boolean,"
    " copy int, version string, spans string, n_dropped long, n_words long, result string, body string, seq long"
)
RANDOM = random.Random(5)
VOCABULARY = ["".join(RANDOM.choices("abcdefghijklmnop", k=RANDOM.randint(1, 8))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choices(VOCABULARY, k=n))


def awkward() -> list[tuple[int | None, str | None]]:
    """(doc_id, text): copies, near copies, shared lines and passages, null, empty, very long, unusual characters."""
    base, passage = prose(160, 1), prose(70, 2)
    texts: list[str | None] = [base, base, base + " tail", base.replace(VOCABULARY[3], "x"), base.upper()]
    for k in range(8):
        words = base.split(" ")
        for at in random.Random(k).sample(range(len(words)), k % 3 + 1):
            words[at] = f"new{k}"
        texts.append(" ".join(words))
    texts += [f"{prose(30, 100 + k)} {passage} {prose(20, 200 + k)}" for k in range(6)]
    texts += [f"{prose(12, 300 + k)}\n  Shared Line\t\n\n{prose(9, 400 + k)}\nshared line" for k in range(12)]
    texts += [None, "", " ", "\n\n", "a", "Ωμέγα Σ ß ﬁ İ", "é́e  x　y  ", "one two three four", "one two three four"]
    texts += [prose(30_000, 9), "ab " * 5000, "token = \"0123456789abcdef0123456789abcdef\" 4111 1111 1111 1111 on 2021-02-28"]
    return [(3 * k + 1, t) for k, t in enumerate(texts)] + [(None, prose(40, 7)), (None, None)]


def extra(row: tuple[int | None, str | None]) -> tuple:
    key, text = row
    source = None if key is None else f"s{key % 4}"
    return (key, text, "en" if key else None, source, len(text or ""), "i", 1, 2, False, 3, "v", None, 9, 9, "r", "b", 5)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([extra(r) for r in awkward()], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows, *columns):
    return Counter((r["doc_id"], *[r[c] for c in columns]) for r in rows)


def test_lines(docs, empty):
    rows = line_dedup.drop_frequent_lines(docs).select("doc_id", "text", F.col("n_lines"), docs.columns[4]).collect()
    keys = defaultdict(set)
    strip = lambda line: lower_ascii(line.strip(" \t\n\x0b\x0c\r"))
    for key, text in awkward():
        for line in (text or "").split("\n"):
            keys[strip(line)].add(key)
    want = Counter()
    for key, text in awkward():
        lines = (text or "").split("\n")
        left = [line for line in lines if not (strip(line) and len(keys[strip(line)]) >= 10)]
        want[key, "\n".join(left), len(lines), len("\n".join(left))] += 1
    assert Counter(map(tuple, rows)) == want
    assert any("hared" not in t and n == 5 for _, t, n, _ in want)
    cut = line_dedup.drop_frequent_lines(empty)
    assert cut.columns[-2:] == ["n_lines", "n_dropped"] and cut.columns[:-2] == empty.columns and not cut.collect()


def test_rows_repeating_an_id_keep_their_own_lines(spark):
    rows = [(1, "a\nb"), (1, "b\na\nc"), (2, "a"), (1, "a\nb")]
    cut = line_dedup.drop_frequent_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=2)
    assert sorted(r["text"] for r in cut.collect()) == ["", "b", "b", "b\nc"]


def test_windows(docs, empty):
    rows = substring_dedup.remove_repeats(docs)
    got = Counter((r[0], r[1], r[-3], r[-2]) for r in rows.collect())
    bodies = [(k if k is not None else 2**63, k, ascii_words(t)) for k, t in awkward()]
    first: dict[tuple, int] = {}
    for order, _, words in sorted(bodies, key=lambda b: b[0]):
        for i in range(len(words) - 49):
            first.setdefault(tuple(words[i : i + 50]), order)
    want = Counter()
    for order, key, words in bodies:
        gone = {j for i in range(len(words) - 49) if first[tuple(words[i : i + 50])] < order for j in range(i, i + 50)}
        want[key, " ".join(w for j, w in enumerate(words) if j not in gone), len(words), len(gone)] += 1
    assert got == want and sum(n for *_, n in want) > 500
    assert not substring_dedup.remove_repeats(empty).collect()


def test_shards_split_hot_marks(docs, monkeypatch):
    want = Counter((r[0], r[1], r[-2]) for r in substring_dedup.remove_repeats(docs).collect())
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 100)
    assert Counter((r[0], r[1], r[-2]) for r in substring_dedup.remove_repeats(docs).collect()) == want


def shingle_sets(rows):
    for key, text in rows:
        words = ascii_words(lower_ascii(text or ""))
        yield key, frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


@pytest.mark.parametrize("percent", [85, 80])
def test_near_copies(docs, empty, percent):
    sets = [(k, s) for k, s in shingle_sets(awkward()) if k is not None]
    parent = {k: k for k, _ in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, x in sets:
        for b, y in sets:
            if a < b and x and 100 * len(x & y) >= percent * len(x | y):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    want = {k: (len(s), root(k), root(k) == k) for k, s in sets}
    rows = near_dedup.near_components(docs, percent).where("doc_id is not null").collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want
    assert near_dedup.near_components(empty).collect() == []


def test_all_pairs_that_the_pivot_leaves(spark, monkeypatch):
    """A chain of near copies whose ends are far apart, in blocks of two."""
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    words = prose(200, 11).split(" ")
    rows = [(k, " ".join([f"w{i}" if i < 3 * k else w for i, w in enumerate(words)])) for k in range(20)]
    got = near_dedup.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0}
    assert near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1


@pytest.mark.parametrize("percent", [85, 80])
def test_the_filter_loses_no_pair_in_practice(percent):
    n, p = near_dedup.LONG, 1 - percent / 100
    more = range(near_dedup.most_different(percent) + 1, n + 1)
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in more) < 2e-8


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 480)]
    links += [(5, 5), (1000, 900)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert dict(map(tuple, got.collect())) == {x: root(x) for x in parent if root(x) != x}


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    want = Counter()
    for key, text in awkward():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 512):
            own = ids[k : k + 512]
            want[key, k // 512, k, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), tuple(own)] += 1
    rows = packing.pack(docs, vocabulary(), 512, ids=True).collect()
    assert Counter((r[0], r[1], r[2], r[3], r[4], tuple(r["ids"])) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        ends = np.cumsum([0, *[n for _, n in sorted(own)]])
        assert [o for o, _ in sorted(own)] == ends[:-1].tolist() and ends[-1] <= 512
    assert len(places) <= 1.05 * sum(r["length"] for r in rows) / 512 + 2
    assert not packing.pack(empty, vocabulary()).collect()


def test_packing_many_equal_sizes(spark):
    rng = random.Random(1)
    sizes = [100] * 700 + [rng.randint(1, 1000) for _ in range(1500)]
    lengths = spark.createDataFrame(list(enumerate(sizes)), "key long, size int")
    rows = packing.place(lengths, 1000).collect()
    used = defaultdict(int)
    for r in rows:
        used[r["seq"]] += sizes[r["key"]]
    assert len(rows) == len(sizes) and max(used.values()) <= 1000 and len(used) <= 1.03 * sum(sizes) / 1000 + 1


def test_packing_few_gaps_and_many_short_pieces(spark):
    sizes = [2100] * 100 + [20] * 6000 + [7] * 300
    lengths = spark.createDataFrame(list(enumerate(sizes)), "key long, size int")
    places = defaultdict(list)
    for r in packing.place(lengths).collect():
        places[r["seq"]].append((r["offset"], sizes[r["key"]]))
    assert sum(map(len, places.values())) == len(sizes) and len(places) == 100
    for own in places.values():
        ends = np.cumsum([0, *[n for _, n in sorted(own)]])
        assert [o for o, _ in sorted(own)] == ends[:-1].tolist() and ends[-1] <= packing.CAPACITY


def test_packing_foresees_what_a_sweep_places(spark):
    rng = random.Random(5)
    for _ in range(3):
        pieces = [rng.randint(1, 60) for _ in range(rng.randint(1, 80))]
        free = [rng.randint(1, 60) for _ in range(rng.randint(1, 80))]
        left = spark.createDataFrame(list(enumerate(pieces)), "key long, size int")
        gaps = spark.createDataFrame(list(enumerate(free)), "seq long, open int")
        sizes = packing._sizes(left, gaps)
        assert sizes == (Counter(pieces), Counter(free))
        assert packing._step(left, gaps, 60)[1] == len(pieces) - packing._fitting(*sizes)


def test_packing_two_sizes_need_no_more_than_best_fit_decreasing(spark):
    sizes = [1500] * 1000 + [1000] * 1000
    lengths = spark.createDataFrame(list(enumerate(sizes)), "key long, size int")
    rows = packing.place(lengths).collect()
    assert len(rows) == len(sizes) and len({r["seq"] for r in rows}) <= 625


def test_fingerprints(docs, empty):
    assert fingerprints.fingerprint_successors(empty).columns[:4] == ["doc_id", "n_chars", "edited_sha256", "fingerprint"]
    rows = {r["doc_id"]: r for r in fingerprints.fingerprint_successors(docs.where("doc_id is not null")).collect()}
    order = sorted(((k, t or "") for k, t in awkward() if k is not None), reverse=True)
    for (key, text), (after, later) in zip(order, order[1:] + order[:1], strict=True):
        n = len(text)
        edited = text[: n - n // 3] + later[: n // 3]
        row = rows[key]
        assert row["n_chars"] == n and row["next_id"] == after
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        common = next((i for i, (a, b) in enumerate(zip(text, later, strict=False)) if a != b), min(n, len(later)))
        assert row["common_next"] == common and 0 <= row["near_next"] <= 1
        # two thirds stay; one block of eight or more can be cut by the edit
        assert row["near_edited"] >= 2 / 3 - 1 / 8 - 0.01 or n < 3 or len(later) < n // 3
        assert (row["fingerprint"] == row["edited_fingerprint"]) == (text == edited)
    assert len(fingerprints.fingerprint_successors(docs).collect()) == len(awkward())
    assert not fingerprints.fingerprint_successors(empty).collect()


def test_span_equality():
    text = fingerprints.PrefixHashes("abcabcabd")
    assert text.span(0, 3) == text.span(3, 3) != text.span(6, 3)
    assert text.common(text, 0, 3) == 5


CLEAN = "Version 1.2.3 of 2021, 4111 1111 1111 1112 and 300.1.2.3, 13/13/2020, 000-12-3456."
PRIVATE = {
    "4111 1111 1111 1111": r"\d{4} \d{4} \d{4} \d{4}",
    "GB82 WEST 1234 5698 7654 32": r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d",
    "2021-02-28": r"\d{4}-\d\d-\d\d",
    "28.02.2021": r"\d\d\.\d\d\.\d{4}",
    "12/31/1999": r"\d\d/\d\d/\d{4}",
    "123-45-6789": r"\d{3}-\d\d-\d{4}",
    "192.168.7.1": r"\d+\.\d+\.\d+\.\d+",
    "+1 (974) 555-3436": r"\+1 \(\d{3}\) \d{3}-\d{4}",
    "Anna.Lee78@mail6.example.com": r"[A-Z][a-z]{3}\.[A-Z][a-z]{2}\d\d@mail6\.example\.com",
}


def luhn(digits):
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pseudonyms(spark, docs, empty):
    rows = [(k, f"Call {v}, {v} or {v}. {CLEAN}") for k, v in enumerate(PRIVATE)] + [(90, CLEAN), (91, None), (92, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pseudonyms.pseudonymize(table, "key").collect()}
    assert [got[k]["text"] for k in (90, 91, 92)] == [CLEAN, None, ""] and got[90]["n_private"] == 0
    for k, (value, form) in enumerate(PRIVATE.items()):
        new = re.fullmatch(rf"Call ({form}), \1 or \1\. {re.escape(CLEAN)}", got[k]["text"])
        assert new and new[1] != value and got[k]["n_private"] == 3, got[k]
    card = re.sub(r"\D", "", got[0]["text"][5:24])
    assert luhn(card)
    iban = got[1]["text"][5:32].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    other = pseudonyms.pseudonymize(table, "other").where("doc_id = 0").first()["text"]
    assert other != got[0]["text"]
    assert pseudonyms.pseudonymize(docs, "key").count() == len(awkward()) and not pseudonyms.pseudonymize(empty, "key").collect()


def test_pseudonyms_in_texts_with_few_digits(spark):
    values = {
        "jane@example.com": r"[a-z]{4}@example\.com",
        "8.8.8.8": r"\d+\.\d+\.\d+\.\d+",
        'token = "abcdefabcdefabcdef"': r'token = "[0-9a-f]{18}"',
        "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1": r"\d(?: \d){15}",
    }
    rows = [(k, f"see {v} there") for k, v in enumerate(values)]
    got = {r["doc_id"]: r for r in pseudonyms.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    for k, (value, form) in enumerate(values.items()):
        new = re.fullmatch(f"see ({form}) there", got[k]["text"])
        assert new and new[1] != value and got[k]["n_private"] == 1, got[k]


def test_ibans_phones_and_times_beside_other_text(spark):
    phone = r"(\+44 \d\d \d{4} \d{4})"
    cases = {
        "ES91 2100 0418 4502 0005 1332 BIC CAIXESBB": r"(ES\d\d(?: \d{4}){5}) BIC CAIXESBB",
        "BE68 5390 0754 7034 EUR 100": r"(BE\d\d(?: \d{4}){3}) EUR 100",
        "ES9121000418450200051332 2024": r"(ES\d{22}) 2024",
        "AT61 1904 3002 3457 3201 PAYABLE": r"(AT\d\d(?: \d{4}){4}) PAYABLE",
        "to DE89 3704 0044 0532 0130 00 4111 1111 1111 1111": r"to (DE\d\d(?: \d{4}){4} \d\d) (\d{4} \d{4} \d{4} \d{4})",
        "+44 20 7946 0958 2024-01-15": phone + r" (\d{4}-\d\d-\d\d)",
        "+44 20 7946 0958 8.8.4.4, 3": phone + r" (\d+\.\d+\.\d+\.\d+), 3",
        "+1 415 555 2671 90210": r"(\+1 \d{3} \d{3} \d{4}) 90210",
        "+14155552671 2024": r"(\+1\d{10}) 2024",
        "+33 1 42 68 53 00 or +44 (0)20 7946 0958": r"(\+33 \d(?: \d\d){4}) or (\+44 \(\d\)\d\d \d{4} \d{4})",
        "+49 30 901820 5": r"(\+49 \d\d \d{6}) 5",
        "at 2021-02-28T10:00:00": r"at (\d{4}-\d\d-\d\d)T10:00:00",
        "DE89 3704 0044 0532 0130 01, 2021-02-30T10:00:00": "DE89 3704 0044 0532 0130 01, 2021-02-30T10:00:00",
    }
    rows = list(enumerate(cases))
    got = {r["doc_id"]: r for r in pseudonyms.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    for k, (text, form) in enumerate(cases.items()):
        new, old = re.fullmatch(form, got[k]["text"]), re.fullmatch(form, text)
        assert new and all(a != b for a, b in zip(new.groups(), old.groups(), strict=True)), got[k]
        assert got[k]["n_private"] == len(new.groups()), got[k]


def test_cards_beside_other_numbers(spark):
    four, amex = r"(\d{4} \d{4} \d{4} \d{4})", r"(\d{4} \d{6} \d{5})"
    cases = {
        "card 4111 1111 1111 1111 12/25": f"card {four} 12/25",
        "no 7 4111 1111 1111 1111": f"no 7 {four}",
        "4111111111111111 123": r"(\d{16}) 123",
        "4111111111111111-123": r"(\d{16})-123",
        "1234 4111 1111 1111 1111 99": f"1234 {four} 99",
        "4322 4111 1111 1111 1111 5500 0000 0000 0004 123": f"4322 {four} {four} 123",
        "12 3782 822463 10005 1234": f"12 {amex} 1234",
        "7 of 4111 1111 1111 1111, 4111-1111-1111-1111.": rf"7 of {four}, (\d{{4}}-\d{{4}}-\d{{4}}-\d{{4}})\.",
        "4111 1111 1111 1111 2021-02-28": rf"{four} (\d{{4}}-\d\d-\d\d)",
        "4111 1111 1111 1111 8.8.4.4": rf"{four} (\d+\.\d+\.\d+\.\d+)",
        "12 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 12/25": r"12 (\d(?: \d){15}) 12/25",
        "41111 11111 111111 x": r"(\d{5} \d{5} \d{6}) x",
        "1990 1991 1992 1993 1994 1995 1996": "1990 1991 1992 1993 1994 1995 1996",
        "4111 1111 1111 1112 12/25, 4111-1111-1111-1111-3a": "4111 1111 1111 1112 12/25, 4111-1111-1111-1111-3a",
    }
    rows = list(enumerate(cases))
    got = {r["doc_id"]: r for r in pseudonyms.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    for k, (text, form) in enumerate(cases.items()):
        new, old = re.fullmatch(form, got[k]["text"]), re.fullmatch(form, text)
        assert new and all(a != b for a, b in zip(new.groups(), old.groups(), strict=True)), got[k]
        assert got[k]["n_private"] == len(new.groups()), got[k]


def feistel(values, radices, key, kind):
    n, half = len(values), len(values) // 2
    for i in range(pseudonyms.ROUNDS):
        left = i % 2 == 0
        fixed = values[half:] if left else values[:half]
        digest = hashlib.sha512(f"{key}:{kind}:{i}:{n}:{','.join(map(str, fixed))}".encode()).hexdigest()
        values = [
            (x + int(digest[4 * (j if left else j - half) :][:4], 16)) % radices[j] if (j < half) == left else x
            for j, x in enumerate(values)
        ]
    return values


def test_permutation_is_the_feistel_network_and_bijective(spark):
    table = spark.range(900).select(
        F.array((F.col("id") / 30).cast("int"), (F.col("id") % 30).cast("int")).alias("v"),
        F.array(F.lit(30), F.lit(30)).alias("r"),
    )
    rows = table.select("v", pseudonyms.permute(F.col("v"), F.col("r"), "k", F.lit("t")).alias("p")).collect()
    assert all(r["p"] == feistel(r["v"], [30, 30], "k", "t") for r in rows)
    assert len({tuple(r["p"]) for r in rows}) == 900


def test_quality(spark, docs, empty):
    rng = random.Random(2)
    good = [(k, prose(rng.randint(20, 80), k), f"s{k % 7}", "en") for k in range(300)]
    bad = [(1000 + k, "*** ".join(prose(40, k).upper().split()) + "!!", f"s{k % 7}", "de") for k in range(60)]
    table = spark.createDataFrame([*good, *bad, (5000, None, None, None), (5001, "", "s1", "en")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(k, int(k < 1000)) for k in [*range(0, 300, 2), *range(1000, 1060, 2)]] + [(None, None)], "doc_id long, quality int")
    rows = quality.quality_posterior(table, labels).collect()
    assert {r["doc_id"] for r in rows if r["keep"] and r["text"]} == set(range(300))
    assert all(0 < r["posterior"] < 1 for r in rows)
    assert quality.quality_posterior(docs, labels.limit(0)).where("keep").count() == len(awkward())
    assert not quality.keep_good(empty, labels).collect()


def test_sparse_sites_are_shrunk(spark):
    votes = [("big", "a", 1.0)] * 90 + [("big", "b", 0.1)] * 90 + [("tiny", "a", 0.0)]
    priors, mean = quality.site_priors(spark.createDataFrame(votes, "host string, path string, vote double"))
    rows = {(r["host"], r["path"]): r for r in priors.collect()}
    assert rows["tiny", "a"]["host_mean"] > 0.2 and 0.4 < mean < 0.7


def test_licenses(spark, docs, empty):
    mit = next(t for n, t in licenses.KNOWN_TEXTS if n == "MIT")
    bsd = next(t for n, t in licenses.KNOWN_TEXTS if n == "BSD-3-Clause")
    rows = [
        (1, "Copyright (c) 2020 A. Person\n\n" + mit.upper().replace("SUBLICENSE", "SUB-LICENSE")),
        (2, prose(20, 1) + "\n\n" + bsd + "\n\n" + prose(5, 2)),
        (3, prose(9, 3) + "\nReleased  under the MIT Licence!\n"),
        (4, "We like software and the MIT License."),
        (5, None), (6, ""), (3, prose(9, 3) + "\nReleased  under the MIT Licence!\n"),
    ]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], tuple(r["licenses"]), r["whole_text"]) for r in got) == Counter(
        [(1, ("MIT",), True), (2, ("BSD-3-Clause",), False), (3, ("MIT",), False), (3, ("MIT",), False), (4, (), False), (5, (), False), (6, (), False)]
    )
    assert licenses.scan_licenses(docs).count() == len(awkward()) and not licenses.scan_licenses(empty).collect()


def test_licenses_in_their_usual_forms(spark):
    mit = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
    apache = """# Copyright 2020 A. Person
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     https://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License."""
    gpl = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 3 of the License, or
(at your option) any later version."""
    cases = [
        (f"{mit}\n\nint main() {{}}\n", ["MIT"], False), (mit, ["MIT"], True), (apache, ["Apache-2.0"], True),
        (f"{apache}\nimport os\n", ["Apache-2.0"], False), (f"/*\n{gpl}\n*/\nint x;", ["GPL-3.0-or-later"], False),
        ("x\nThis work is licensed under the GNU General Public License, version 3.\ny", ["GPL-3.0-only"], False),
        ("x\nReleased under CC BY 4.0.", ["CC-BY-4.0"], False), ("// SPDX-License-Identifier: GPL-2.0+\nx", ["GPL-2.0-or-later"], False),
        ("SPDX-License-Identifier: LGPL-2.1-only", ["LGPL-2.1-only"], True), ("Licensed under GPLv2 or later", ["GPL-2.0-or-later"], True),
        ("Licensed under the MIT License.\nx\nThis file is released under the\nApache License 2.0", ["Apache-2.0", "MIT"], False),
        ("We write about software released under GPLv3.", [], False), (mit.replace("free of charge", "for a fee"), [], False),
    ]
    folder = Path("/usr/share/common-licenses")
    full = {"GPL-3": "GPL-3.0-only", "GPL-2": "GPL-2.0-only", "LGPL-3": "LGPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only"}
    for name, license in (full | {n: n for n in ("Apache-2.0", "MPL-2.0", "CC0-1.0")}).items():
        if (folder / name).exists():
            cases.append(((folder / name).read_text(), [license], True))
            cases.append((f"code\n\n{(folder / name).read_text()}\nmore", [license], False))
    rows = [(k, text) for k, (text, *_) in enumerate(cases)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["licenses"], r["whole_text"]) for r in got} == {k: (n, w) for k, (_, n, w) in enumerate(cases)}


def test_license_units_against_all_runs_of_lines(spark):
    known = [("A", "alpha beta gamma delta"), ("B", "alpha beta gamma delta epsilon zeta"), ("C", "zeta eta theta iota kappa"), ("D", "epsilon zeta")]
    lines = ["alpha beta", "gamma delta", "Alpha, beta gamma delta", "epsilon zeta", "zeta eta", "theta iota kappa", "other words", ""]
    rng = random.Random(8)
    rows = [(k % 190, "\n".join(rng.choices(lines, k=rng.randrange(9)))) for k in range(200)] + [(7, None)] + [(None, "epsilon zeta")] * 50

    def units(text):
        own = [x for x in (re.sub("[^a-z]+", " ", line.lower()).strip() for line in (text or "").split("\n")) if x]
        runs = {(i, j): " ".join(own[i:j]) for i in range(len(own)) for j in range(i + 1, len(own) + 1)}
        hits = {run: next((n for n, t in known if t == form), None) for run, form in runs.items()}
        hits = {run: n for run, n in hits.items() if n}
        outer = [(r, n) for r, n in hits.items() if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in hits)]
        return tuple(sorted({n for _, n in outer})), any(r == (0, len(own)) for r, _ in outer), len({runs[r] for r, _ in outer})

    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit("own"))
    got = Counter((r[0], r[1], r[2], tuple(r[3]), r[4], r[5]) for r in licenses.scan_licenses(table, known).collect())
    assert got == Counter((k, t, "own", *units(t)) for k, t in rows) and len({g[3] for g in got}) > 5


def test_every_license_line_of_the_documents_is_found(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    with_line = licenses.scan_licenses(table.where(F.col("text").rlike(r"(?m)^(This work is licensed|Licensed|Released) under ")))
    assert with_line.count() > 0 and with_line.where("size(licenses) = 0").count() == 0


def test_every_known_text_has_a_marker():
    assert all(any(m in text.lower() for m in licenses.MARKERS) for _, text in licenses.KNOWN_TEXTS)


def test_mixing(spark, docs, empty):
    rates = {r["source"]: r["rate"] for r in mixing.source_rates(docs).collect()}

    def copies(key, source):
        rate = rates[source]
        draws = math.ceil(rate / mixing.LARGEST_RATE)
        total = 0
        for draw in range(1, draws + 1):
            digest = hashlib.md5(f"20240229:{'null' if key is None else key}:{draw}".encode()).hexdigest()
            u, term, below = (int(digest[:13], 16) + 0.5) / 2**52, math.exp(-rate / draws), math.exp(-rate / draws)
            k = 0
            while u >= below:
                k += 1
                term *= rate / draws / k
                below += term
            total += k
        return total

    want = Counter()
    for row in awkward():
        n = copies(row[0], extra(row)[3])
        want.update((row[0], c) for c in range(1, n + 1))
    got = mixing.poisson_mix(docs).collect()
    assert Counter((r["doc_id"], r[-2]) for r in got) == want
    assert [r["shuffle_key"] for r in got] == sorted(r["shuffle_key"] for r in got)
    assert not mixing.poisson_mix(empty).collect()
    assert {r["source"] for r in mixing.poisson_mix(docs, {"s1": 3.0, "s2": 1.0}).collect()} <= {"s1", "s2"}


def test_mixture_reaches_its_weights(spark):
    table = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("word").alias("text"), F.when(F.col("id") < 5000, "a").otherwise("b").alias("source")
    )
    rows = mixing.poisson_mix(table, {"a": 1.0, "b": 3.0}).groupBy("source").count().collect()
    count = dict(map(tuple, rows))
    assert 0.7 < count["b"] / sum(count.values()) < 0.8 and 5500 < sum(count.values()) < 6500


def vectors(n, d=16, seed=0):
    return np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 64)
    x = vectors(600)
    x[300:420] = x[300]
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    rows += [(9000, None), (9050, [0.0] * 16), (9100, [float("nan")] * 16), (9150, [1.0] * 5), (None, [1.0] * 16), (9200, [None] + [1.0] * 15), (9250, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.nearest(table, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    found = 0
    wide = x.astype(float)
    for q in range(0, 600, 50):
        scores = ann.cosines(wide[q], wide)
        best = [k for k in np.lexsort((np.arange(600), -scores)) if k != q][:5]
        found += len({k for k, _ in got[q]} & set(best))
        assert all(s == scores[k] for k, s in got[q])
    assert set(got) == set(range(0, 600, 50)) and found / 60 >= 0.9
    assert [k for k, _ in got[300]] == [301, 302, 303, 304, 305]


def test_nearest_few_and_none(spark):
    schema = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 2.0])], schema)
    got = ann.nearest(few, F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in got) == [(1, 1), (2, 2)]
    assert not ann.nearest(few.limit(0), F.col("vec_id") == 0).collect()
    assert not ann.nearest(few, F.col("vec_id") == 7).collect()


def test_letters_alone_are_not_cut_into_words():
    """A part of ASCII letters is one word and skips the checks that other parts need; all parts get the tokenizer's ids."""
    tokens = packing.WordTokens(vocabulary())
    assert tokens.word_by_word
    parts = ["Words", "ing", "ABC", "It's", "x's1", "don't", "café", "É", "12a", "&&&", "a.b,", "\u0130x", "e\u0301", "<|endoftext|>", "a<|endoftext|>b"]
    for part in parts:
        assert tokens._part(part) == tokens._whole(part), part

    class Never:
        def __getattr__(self, name):
            raise AssertionError("a part of letters needs no pattern")

    tokens.WORD = tokens.PLAIN = Never()
    assert tokens._part("Unseenword") == tokens._whole("Unseenword")
    with pytest.raises(AssertionError):
        tokens._part("unseen-word")
