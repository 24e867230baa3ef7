"""The corpus operators bound to the tables of a folder, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import (
    ann,
    fingerprints,
    licenses,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    packing,
    pseudonyms,
    quality,
    spelling,
    substring_dedup,
    warc,
)
from tenura.llm.shipping import ship
from tenura.settings import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: seed of the pseudonyms; a deployment passes its own secret
PSEUDONYM_KEY = "example key, replace in production"


def vocabulary() -> str:
    """The tokenizer file that the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(ship(spark), sf_dir)
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_frequent_lines(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op3_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT doc_id, pos, line, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), frequent AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.key = f.key
GROUP BY doc_id
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_posterior(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "source", "lang", "evidence", "site_prior", "posterior", "keep")


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), "whole_text", "n_units")


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_successors(_table(spark, sf_dir, "documents"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(_table(spark, sf_dir, "documents"))


# The number of copies is counted against the same series, exp(-m) * m^k / k! summed up to k, for each part of a rate.
ORACLES["op9_mixing"] = rf"""
WITH sizes AS (
    SELECT source, sum(coalesce(length(text), 0) + 1)::BIGINT AS size FROM documents GROUP BY source
), rates AS (
    SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate
    FROM sizes
), parts AS (
    SELECT source, ceil(rate / {mixing.LARGEST_RATE})::BIGINT AS draws,
           rate / ceil(rate / {mixing.LARGEST_RATE}) AS mean FROM rates WHERE rate > 0
), terms AS (
    SELECT source, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p FROM parts, range({mixing.TERMS}) t(k)
), below AS (
    SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS p FROM terms
), draws AS (
    SELECT d.doc_id, d.source, unnest(range(1, p.draws + 1)) AS draw
    FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
), uniforms AS (
    SELECT doc_id, source, draw, (('0x' || substr(md5(
        '20240229:' || coalesce(doc_id::VARCHAR, 'null') || ':' || draw), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
    FROM draws
), counts AS (
    SELECT u.doc_id, count(*) AS copies
    FROM uniforms u JOIN below b ON u.source IS NOT DISTINCT FROM b.source AND b.p <= u.u GROUP BY u.doc_id
), copies AS (
    SELECT doc_id, unnest(range(1, copies + 1))::INTEGER AS copy FROM counts
)
SELECT d.*, c.copy, md5('20240229:shuffle:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || c.copy) AS shuffle_key
FROM documents d JOIN copies c ON d.doc_id IS NOT DISTINCT FROM c.doc_id
"""


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(_table(spark, sf_dir, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    return ann.nearest(table, F.col("vec_id") % 50 == 0)


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive(_table(spark, sf_dir, "pages"), new_path(spark, "archives"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Base 32 of the hexadecimal digest: ten digits are eight characters of five bits.
ORACLES["op11_warc"] = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), groups AS (
    SELECT *, max(page_id) OVER (PARTITION BY hex) AS kept FROM payloads
)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31), 1)), '')
           AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM groups
"""


# The table of crc32 and its value for a text, for engines without the function.
CRC_TABLE = """
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                ORDER BY i) AS crcs
    FROM range(256) r(i)"""
CRC_OF = """xor(list_reduce({codes}, lambda a, b: xor(a >> 8, crcs[1 + (xor(a, b) & 255)]), 4294967295), 4294967295)"""


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(_table(spark, sf_dir, "documents")))


# Near words share a text without one letter: at the same place if a letter is replaced, or one of them is that text.
ORACLES["op12_spelling"] = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(
        text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
), counted AS (
    SELECT id, run, count(*) AS n, hex(id || ':' || run) AS bytes FROM runs GROUP BY id, run
), hashed AS (
    SELECT run, n, {CRC_OF.format(codes="list_transform(range(strlen(bytes) // 2), lambda i: ('0x' || substr(bytes, 1 + 2 * i, 2))::BIGINT)")} AS h,
           (h % length(run))::BIGINT AS place
    FROM counted, crc
), words AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, place) || substr(run, place + 2) ELSE run END AS word,
           sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), cuts AS (
    SELECT word, n, place, substr(word, 1, place) || substr(word, place + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS place FROM words)
), near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b USING (rest, place) WHERE a.word <> b.word
    UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word
), best AS (
    SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
           CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
), ways AS (
    SELECT word, word AS at_word, form AS next FROM forms
    UNION ALL SELECT y.word, f.word, f.form FROM ways y JOIN forms f ON y.next = f.word
)
SELECT f.word, form, at_word AS root, n, n_near, form_n FROM forms f JOIN ways y ON f.word = y.word AND y.next IS NULL
"""


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    changed = F.when(F.crc32(docs["doc_id"].cast("string")) % 2 == 0, F.replace(docs["text"], F.lit("\n"), F.lit("")))
    rows = merkle.manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": F.coalesce(changed, docs["text"])}
    )
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified"
    )


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(({column})::VARCHAR) || ':' || ({column}), '-')"


def _nodes_sql(name: str, start: str) -> str:
    """All levels of the trees of ``start``; the width of a level goes along with its nodes."""
    return f"""{name} AS (
        SELECT tree, 0 AS level, spot, digest, width FROM {start}
        UNION ALL
        SELECT tree, level + 1, spot // 3, sha256(string_agg(digest, '' ORDER BY spot)), (max(width) + 2) // 3
        FROM {name} WHERE width > 1 GROUP BY tree, level, spot // 3
    )"""


def _sides_sql(key: str, start: str, nodes: str) -> str:
    """The other nodes of the run, before and after, of each level above each row of ``start``."""
    place = "s.spot // (3 ** n.level)::BIGINT"
    side = "coalesce(string_agg(n.digest, '' ORDER BY n.spot) FILTER (WHERE n.spot {0} " + place + "), '')"
    return f"""
        SELECT s.{key}, n.level, {side.format("<")} || '|' || {side.format(">")} AS sides
        FROM {start} s JOIN {nodes} n ON s.tree = n.tree AND n.width > 1 AND n.spot // 3 = s.spot // (3 ** (n.level + 1))::BIGINT
        GROUP BY s.{key}, n.level"""


_BEFORE_TEXT = "doc_id source lang n_chars".split()
ORACLES["op13_merkle"] = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}
), hashed AS (
    SELECT doc_id, coalesce('s' || source, 'n') AS tree, {" || ".join(_field_sql(c) for c in _BEFORE_TEXT)} AS head,
           sha256(head || {_field_sql("text")}) AS digest,
           {CRC_OF.format(codes="list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)")} % 2 = 0 AS odd,
           CASE WHEN odd THEN replace(text, chr(10), '') ELSE text END AS other,
           sha256(head || {_field_sql("other")}) AS checked
    FROM documents, crc
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS spot, count(*) OVER (PARTITION BY tree) AS width
    FROM hashed
), {_nodes_sql("nodes", "leaves")}, subroots AS (
    SELECT tree AS own, 'all' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS spot, count(*) OVER () AS width
    FROM nodes WHERE width = 1
), {_nodes_sql("tops", "subroots")}, steps AS (
    SELECT doc_id, 0 AS tier, level, sides FROM ({_sides_sql("doc_id", "leaves", "nodes")})
    UNION ALL
    SELECT doc_id, 1, level, sides FROM ({_sides_sql("own", "subroots", "tops")}) u JOIN leaves l ON l.tree = u.own
), paths AS (
    SELECT doc_id, list(sides ORDER BY tier, level) AS path FROM steps GROUP BY doc_id
), folded AS (
    SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, (SELECT digest FROM tops WHERE width = 1) AS root,
           replace(array_to_string(coalesce(path, []), ''), '|', '') AS proof,
           list_reduce(coalesce(path, []), lambda a, b: sha256(split_part(b, '|', 1) || a || split_part(b, '|', 2)), l.checked)
               AS folded_root
    FROM leaves l JOIN subroots s ON l.tree = s.own LEFT JOIN paths p ON l.doc_id = p.doc_id
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
