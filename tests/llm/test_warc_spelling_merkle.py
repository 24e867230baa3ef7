"""Web archives, spelling variants and the Merkle manifest against brute force."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import merkle, spelling, warc
from tenura.settings import new_path

PAGES = "page_id long, url string, html string, at long, file string, error string"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages():
    looks_like = "<p>\nhttp://a/ 1.2.3.4 20200101000000 text/html 5\nhello\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc"
    bodies = [None, "", "one", "one", "\n", "a\nb\n", "a\r\n\r\nb", looks_like, looks_like, "é" * 50_000, "x\n" * 40_000, "HTTP/1.1 200"]
    urls = [None, "", "http://a b/ c", "http://é/?q= 1 2 3 4 5 6 7 8 9", "dns:a"]
    rows = [(i, urls[i % 5], body, 1, "f", "e") for i, body in enumerate(bodies)]
    return rows + [(20, "u", "one", 1, "f", "e"), (20, "u", "one", 1, "f", "e"), (None, "u", "null id", 1, "f", "e"), (None, "u", "null id", 1, "f", "e")]


@pytest.mark.parametrize("version", [1, 2, None])
def test_pages_survive_both_formats(spark, version):
    rows = pages()
    found = warc.archive(spark.createDataFrame(rows, PAGES).repartition(3), new_path(spark, "test"), version=version).collect()
    assert len(found) == len(rows) and all(r["error"] is None for r in found)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in found) == Counter(
        (page, len((html or "").encode()), sha1(html)) for page, _, html, *_ in rows
    )
    groups = defaultdict(list)
    for r in found:
        groups[r["payload_digest"]].append(r)
    for group in groups.values():
        response = [r for r in group if r["record_type"] == "response"]
        assert len(response) == 1 and response[0]["refers_to"] is None
        assert response[0]["page_id"] == max((r["page_id"] for r in group if r["page_id"] is not None), default=None)
        assert all(r["refers_to"] == response[0]["page_id"] for r in group if r["record_type"] == "revisit")


def test_small_payloads_are_not_shared(spark):
    rows = [(i, "u", html, 0, "", "") for i, html in enumerate(["", "", "ab", "ab", "abc", "abc"])]
    found = warc.archive(spark.createDataFrame(rows, PAGES), new_path(spark, "test"), min_bytes=3).collect()
    assert {r["page_id"]: r["refers_to"] for r in found} == {0: None, 1: None, 2: None, 3: None, 4: 5, 5: None}


def test_no_pages(spark):
    assert warc.archive(spark.createDataFrame([], PAGES), new_path(spark, "test")).collect() == []


def test_warc_files_hold_what_the_standard_asks_for(spark, tmp_path):
    rows = [(1, "http://a/", "same", 0, "", ""), (2, "http://b/", "same", 0, "", "")]
    arc = warc.read_arc(spark, warc.write_arc(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path / "arc"), 2))
    path = warc.write_warc(warc.convert(arc).coalesce(1), str(tmp_path / "warc"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "warc").glob("part-*"))
    records, at = [], 0
    while at < len(data):
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.0" and rest[size : size + 4] == b"\r\n\r\n"
        records.append((fields, rest[:size]))
        at += len(head) + 8 + size
    kinds = {f["WARC-Type"]: (f, block) for f, block in records}
    assert sorted(f["WARC-Type"] for f, _ in records) == ["response", "revisit", "warcinfo"]
    assert len({f["WARC-Record-ID"] for f, _ in records}) == 3 and {f["WARC-Date"] for f, _ in records} == {"2024-01-01T00:00:00Z"}
    (response, block), (revisit, header) = kinds["response"], kinds["revisit"]
    assert response["WARC-Target-URI"] == "http://b/" and block.endswith(b"\r\n\r\nsame") and header.endswith(b"\r\n\r\n")
    assert response["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
    assert revisit["WARC-Refers-To"] == response["WARC-Record-ID"] and revisit["WARC-Refers-To-Target-URI"] == "http://b/"
    assert revisit["WARC-Payload-Digest"] == response["WARC-Payload-Digest"] == "sha1:" + sha1("same")
    assert "ARC version 2" in kinds["warcinfo"][1].decode() and warc.read_warc(spark, path).count() == 3


def test_foreign_and_damaged_arc_files(spark, tmp_path):
    """Versions told apart by their block, other content types, noise between records and a cut end."""
    about = lambda n, names: f"{n} 0 Someone\n{names}\n\n".encode()
    one = about(1, "URL IP-address Archive-date Content-type Archive-length")
    two = about(2, "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length")
    reply = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nhi\n"
    first = b"filedesc://a.arc 0.0.0.0 19970101000000 text/plain %d\n%s\n" % (len(one), one)
    first += b"http://a/x y 1.2.3.4 199701011200 text/html %d\n%s\n" % (len(reply), reply)
    first += b"noise that is no header\ndns:a 1.2.3.4 19970101000001 text/dns 4\nabcd\nhttp://cut/ 1.1.1.1 19970101000002 text/html 99\nshort"
    second = b"filedesc://b.arc 0.0.0.0 19980101000000 text/plain 200 - - 0 b.arc %d\n%s\n" % (len(two), two)
    second += b"http://b/ 4.3.2.1 19980101000000 text/html 404 c0ffee - 99 b.arc %d\n%s\n" % (len(reply), reply)
    (tmp_path / "in").mkdir()
    for name, data in {"a": first, "b": second}.items():
        (tmp_path / "in" / f"{name}.arc.gz").write_bytes(gzip.compress(data))
    arc = warc.read_arc(spark, str(tmp_path / "in"))
    rows = {r["url"]: r for r in arc.collect()}
    assert rows["http://a/x y"]["version"] == 1 and rows["http://b/"]["version"] == 2 and rows["http://b/"]["status"] == "404"
    assert rows["http://a/x y"]["payload"] == b"hi\n" and rows["http://b/"]["payload_digest"] == sha1("hi\n")
    assert rows["dns:a"]["error"] == "24 bytes skipped before" and "missing" in rows["http://cut/"]["error"]
    made = {r["target_uri"]: r for r in warc.convert(arc).collect()}
    assert made["http://a/x y"]["date"] == "1997-01-01T12:00:00Z" and made["http://a/x y"]["ip"] == "1.2.3.4"
    assert {made["http://a/x y"]["type"], made["http://b/"]["type"]} == {"response", "revisit"}
    assert "http://cut/" not in made


# ---- spelling variants


def distance_is_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_of(counts, times=2):
    near = {w: [v for v in counts if distance_is_one(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= times * counts[word] else None
    rows = set()
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, form[word], root, counts[word], len(near[word]), counts[form[word]] if form[word] else None))
    return rows


def dense_words():
    draw = random.Random(3)
    letters = "abceéÿ×"
    words = {"".join(draw.choices(letters, [9, 7, 5, 2, 2, 1, 1], k=draw.randint(3, 9))) for _ in range(500)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "aaaa", "a" * 300, "a" * 301, "b" + "a" * 300, "x", "xy"}
    for word in list(words)[:150]:
        at = draw.randrange(len(word))
        words |= {word[:at] + word[at + 1 :], word[:at] + "z" + word[at:], word[:at] + "q" + word[at + 1 :]}
    return {w: draw.randint(1, 40) for w in words if w}


@pytest.mark.parametrize(("longest_list", "largest"), [(0, 10**6), (2, 10**6), (15, 10**6), (10**6, 10**6), (1, 40), (0, 1)])
def test_near_words_whatever_the_dictionary(spark, longest_list, largest):
    """Lists of any length, no list at all, a full dictionary: always the same result."""
    counts = dense_words()
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.spelling_variants(words, longest_list=longest_list, largest=largest)
    assert {tuple(r) for r in got.collect()} == variants_of(counts)


def test_dictionary_is_bounded_and_holds_beginnings(spark):
    words = spark.createDataFrame([(w,) for w in dense_words()], "word string")
    for largest in (5, 50, 10**6):
        assert len(spelling.gram_dictionary(words, 2, largest)) <= largest
    grams = set(spelling.gram_dictionary(words, 2).tolist())
    shorter = {((g >> 24) << 16) | (g & 0xFFFF) for g in grams if g >> 40}
    assert grams and shorter <= grams


def test_counting_of_runs(spark):
    texts = ["Straße straße STRASSE x1y", None, "", "naïve×÷Å-naïve naïve", "aaaaa " * 3000, "überāber Über"]
    rows = [(i, t, "w", 1, "r") for i, t in enumerate(texts * 60)] + [(None, "nulls nulls", "w", 1, "r"), (7, "again", "w", 1, "r")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n long, run string")
    want = Counter()
    for key, text, *_ in rows:
        for run in spelling_runs(text or ""):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    got = {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}


def spelling_runs(text):
    import re

    return ["".join(c.lower() if c.isascii() else c for c in run) for run in re.findall("[A-Za-zÀ-ÿ]+", text)]


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(spelling.word_counts(empty)).collect() == []
    one = spark.createDataFrame([("alone", 3)], "word string, n long")
    assert [tuple(r) for r in spelling.spelling_variants(one).collect()] == [("alone", None, "alone", 3, 0, None)]
    with pytest.raises(ValueError):
        spelling.spelling_variants(one, times=1)


def test_lists_are_short(spark):
    counts = dense_words()
    words = sorted(counts)
    dictionary = spelling.gram_dictionary(spark.createDataFrame([(w,) for w in words], "word string"), 10)
    for side in spelling.decomposed(words, dictionary):
        lists = defaultdict(set)
        for word, gram in zip(side[0].tolist(), side[1].tolist(), strict=True):
            lists[gram].add(word)
        assert lists and max(map(len, lists.values())) <= 10
    assert not spelling.found(np.array([1], np.uint64), np.empty(0, np.uint64))[0]


# ---- Merkle manifest

ROWS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, id long, root string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def paths_of(level):
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, p in enumerate(at):
            a = p // 3 * 3
            paths[i].append(("".join(level[a:p]), "".join(level[p + 1 : a + 3])))
        at = [p // 3 for p in at]
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return paths, level[0]


def manifest_of(rows, tamper):
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append((row[0], leaf_of(row[:5]), leaf_of([*row[:4], tamper(row[4])])))
    for tree in trees.values():
        tree.sort(key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    inner = {s: paths_of([r[1] for r in trees[s]]) for s in names}
    above, root = paths_of([inner[s][1] for s in names])
    out = Counter()
    for name, upper in zip(names, above, strict=True):
        for (key, leaf, checked), own in zip(trees[name], inner[name][0], strict=True):
            node = checked
            for before, after in own + upper:
                node = sha(before + node + after)
            out[key, name, leaf, inner[name][1], root, "".join(b + a for b, a in own + upper), node, node == root] += 1
    return out


@pytest.mark.parametrize(("levels", "count"), [(1, 10), (1, 28), (2, 82), (6, 1), (6, 250)])
def test_manifest_of_any_size(spark, monkeypatch, levels, count):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    draw = random.Random(count)
    sources = [None, "", "a", "é", "Z", "big", "big", "big"] + [f"s{i}" for i in range(count // 20)]
    texts = [None, "", "one\ntwo", "plain", "ü\n" * 5000]
    rows = [(draw.choice([None, *range(count)]) if count > 9 else i, draw.choice(sources), draw.choice(["en", None]), i, draw.choice(texts), "x", 9, "y") for i in range(count)]
    rows += rows[:5] if count > 9 else []
    docs = spark.createDataFrame(rows, ROWS)
    got = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": F.replace("text", F.lit("\n"), F.lit(""))})
    found = Counter(tuple(r[c] for c in ("doc_id", "source", "leaf", "subroot", "root", "proof", "folded_root", "verified")) for r in got.collect())
    assert found == manifest_of(rows, lambda t: t and t.replace("\n", ""))


def test_manifest_of_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], ROWS), ["doc_id", "text"]).collect() == []


def test_any_other_row_changes_the_root(spark):
    rows = [(i, "s", "en", 1, f"text {i}", "", 0, "") for i in range(30)]
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    root = lambda r: merkle.manifest(spark.createDataFrame(r, ROWS), fields).first()["root"]
    assert len({root(rows), root(rows[:-1]), root([*rows[:-1], (29, "t", "en", 1, "text 29", "", 0, "")])}) == 3
