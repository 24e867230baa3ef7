"""Web archives: write ARC files, convert them to WARC files, read WARC files.

An ARC file begins with a version block, which says how the header lines of
its records are laid out: five fields in version 1, ten in version 2, the
declared length last in both. Archives are read as a stream of lines by
Spark's text reader (compressed files are never split, so a task sees a file
in order) and put together again by the declared lengths, so a line of the
content that looks like a header does no harm, and a task holds one record.

The converter gives each ARC record what WARC asks for: an identifier made
from the record's place and content, an ISO date from the 14 digits, a type,
digests of block and payload. Records that repeat the payload of another
become revisit records that refer to it and hold the HTTP header only. The
decision is made on digests alone; payloads are shuffled once, by the unique
record identifier, so many copies of a page do not meet in one task.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.settings import materialize

# fixed values: the field definitions of the two ARC versions
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

#: header of an archived HTTP response that carries the id of the page
ID_HEADER = "X-Page-Id"

#: bytes of records after which a task hands them on
BATCH_BYTES = 4_000_000

_ARC = (
    "file long, at long, version int, url string, ip string, archived string, content_type string, status string,"
    " http binary, payload binary, payload_bytes long, payload_digest string, block_digest string, page_id long, error string"
)
_WARC = (
    "type string, record_id string, target_uri string, date string, refers_to string, declared_digest string,"
    " block_bytes long, http binary, payload binary, payload_bytes long, payload_digest string, page_id long, error string"
)
_SPACES = re.compile(r"[\x00-\x20\x7f]")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[bytes | None, bytes]:
    """(HTTP header without the blank line, payload); no header if the block is not an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return None, block
    head, found, body = block.partition(b"\r\n\r\n")
    return (head, body) if found else (block.rstrip(b"\r\n"), b"")


def _page_id(head: bytes | None) -> int | None:
    for line in (head or b"").split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == ID_HEADER.lower().encode():
            try:
                return int(value)
            except ValueError:
                return None
    return None


# ---- writing ARC


def _arc_line(version: int, url: str, archived: str, kind: str, length: int, at: int, name: str) -> bytes:
    own = {1: [], 2: ["200", "-", "-", str(at), name]}[version]
    return " ".join([url, "0.0.0.0", archived, kind, *own, str(length)]).encode("utf-8", "surrogatepass") + b"\n"


def _to_arc(version: int | None, archived: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        layout = version or 1 + part % 2
        name = f"pages-{part:05d}.arc"
        about = f"{layout} 0 tenura\n{' '.join(FIELDS[layout])}\n\n".encode()
        at, out, size = 0, [], 0
        for batch in batches:
            for page, url, body in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if not at:
                    first = _arc_line(layout, f"filedesc://{name}", archived, "text/plain", len(about), 0, name) + about
                    out.append(first)
                    at += len(first) + 1
                payload = (body or "").encode("utf-8", "surrogatepass")
                known = b"" if page is None else f"{ID_HEADER}: {page}\r\n".encode()
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + known
                block = head + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                clean = _SPACES.sub(lambda m: f"%{ord(m[0]):02X}", url or "") or "-"
                record = _arc_line(layout, clean, archived, "text/html", len(block), at, name) + block
                out.append(record)
                at += len(record) + 1
                size += len(record)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def write_arc(
    pages: DataFrame,
    path: str,
    version: int | None = None,
    archived: str = "20240101000000",
    id: str = "page_id",
    url: str = "url",
    body: str = "html",
) -> str:
    """Write ``pages`` as compressed ARC files, one per task, and return ``path``.

    ``version`` is 1 or 2; None gives even tasks version 1 and odd ones version
    2. Each page is archived as an HTTP response with its id in ``ID_HEADER``
    (none for a null id). Null text is an empty payload, a null or empty
    address is ``-``, white space in an address is percent-encoded.
    """
    rows = pages.select(pages[id].cast("long"), pages[url], pages[body])
    records = rows.mapInArrow(_to_arc(version, archived), "record binary")
    return _write(records.select(F.col("record").cast("string")), path, "\n")


def _write(lines: DataFrame, path: str, end: str) -> str:
    lines.write.option("compression", "gzip").option("lineSep", end).text(path)
    return path


# ---- reading by declared lengths


class Framer:
    """Puts the records of one archive together from its lines.

    ``header(lines)`` gets the header lines read so far and answers None if
    more are needed, the number of content bytes if the header is complete,
    or a negative number if these lines are no header; they are skipped.
    """

    def __init__(self, header: Callable[[list[bytes]], int | None]):
        self.header = header
        self.lines: list[bytes] = []
        self.content: list[bytes] = []
        self.left = -1
        self.at = self.start = 0
        self.skipped = 0

    def _done(self, error: str | None = None) -> tuple:
        if self.skipped:
            error = "; ".join(filter(None, [error, f"{self.skipped} bytes skipped before"]))
        record = (self.start, self.lines, b"".join(self.content), error)
        self.lines, self.content, self.left, self.skipped = [], [], -1, 0
        return record

    def feed(self, line: bytes) -> Iterator[tuple]:
        """The records (offset, header lines, content, error) that end with this line, given without its line feed."""
        if self.left >= 0:
            size = len(line) + 1
            if size <= self.left:
                self.content += [line, b"\n"]
                self.left -= size
                self.at += size
                if not self.left:
                    yield self._done()
                return
            taken, line = line[: self.left], line[self.left :]
            self.content.append(taken)
            self.at += len(taken)
            yield self._done()
        size = len(line) + 1
        if not self.lines and not line.strip():
            self.at += size
            return
        if not self.lines:
            self.start = self.at
        self.lines.append(line)
        self.at += size
        length = self.header(self.lines)
        if length is None:
            return
        if length < 0:
            self.skipped += sum(len(part) + 1 for part in self.lines)
            self.lines = []
        elif length == 0:
            yield self._done()
        else:
            self.left = length

    def close(self) -> Iterator[tuple]:
        if self.left > 0:
            yield self._done(f"{self.left} bytes missing")
        elif self.lines or self.skipped:
            yield self._done("incomplete header")


def _framed(batches: Iterator[pa.RecordBatch], archive: Callable[[], tuple], names: str) -> Iterator[pa.RecordBatch]:
    """The rows of all archives of a task. ``archive`` gives (framer, function from a record to its row and size)."""
    schema = pa.schema([_field(c) for c in names.split(", ")])
    now, framer, row_of = None, None, None
    rows, size = [], 0

    def packed():
        columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if file != now:
                if framer is not None:
                    rows += [row_of(now, r) for r in framer.close()]
                now, (framer, row_of) = file, archive()
            for record in framer.feed(line):
                rows.append(row_of(now, record))
                size += len(record[2]) + 500
            if size > BATCH_BYTES:
                yield packed()
                rows, size = [], 0
    if framer is not None:
        rows += [row_of(now, r) for r in framer.close()]
    if rows:
        yield packed()


def _field(text: str) -> pa.Field:
    name, kind = text.split()
    return pa.field(name, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[kind])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))


def _words(line: bytes) -> str:
    return line.decode("utf-8", "replace").rstrip("\r")


class ArcLayout:
    """What the version block of an ARC file says about its header lines; version 1 until it is read."""

    def __init__(self):
        self.version = 1

    def fields(self, line: bytes) -> dict[str, str] | None:
        """The fields of a header line, counted from the right, since addresses may hold spaces."""
        text = _words(line)
        names = FIELDS[self.version]
        if text.startswith("filedesc://"):  # in the layout that the block itself declares
            names = FIELDS[2] if len(text.split(" ")) >= len(FIELDS[2]) else FIELDS[1]
        parts = text.rsplit(" ", len(names) - 1)
        if len(parts) != len(names):
            return None
        found = dict(zip(names, parts, strict=True))
        whole = found["Archive-length"].isascii() and found["Archive-length"].isdigit()
        return found if whole and re.fullmatch(r"\d{12,14}", found["Archive-date"], re.ASCII) else None

    def header(self, lines: list[bytes]) -> int:
        found = self.fields(lines[0])
        return -1 if found is None else int(found["Archive-length"])

    def row(self, file: int, record: tuple, blocks: bool) -> tuple:
        at, lines, block, error = record
        found = self.fields(lines[0]) if lines else None
        if found is None:
            return (file, at, self.version, *[None] * 11, error or "no header")
        if found["URL"].startswith("filedesc://"):
            number = block.split(b" ", 1)[0]
            if number in (b"1", b"2"):
                self.version = int(number)
            else:
                error = "; ".join(filter(None, [error, f"unknown version {number[:20]!r}"]))
        head, payload = split_http(block)
        return (
            file, at, self.version, found["URL"], found["IP-address"], found["Archive-date"], found["Content-type"],
            found.get("Result-code"), head if blocks else None, payload if blocks else None, len(payload),
            sha1_base32(payload), sha1_base32(block), _page_id(head), error,
        )


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record of the ARC files at ``path``, the version blocks included.

    ``at`` is the record's offset in its uncompressed file, ``http`` the HTTP
    header, null for content that is no HTTP response. Bytes that are no header
    line where one is expected are skipped up to the next one, a record cut
    short by the end of its file is given as far as it goes; ``error`` says so.
    Without ``blocks`` the content is left out.
    """

    def archive():
        layout = ArcLayout()
        return Framer(layout.header), lambda file, record: layout.row(file, record, blocks)

    return _lines(spark, path).mapInArrow(lambda batches: _framed(batches, archive, _ARC), _ARC)


# ---- conversion


def record_id(*parts: Column) -> Column:
    """An identifier that depends on nothing but ``parts``."""
    value = F.md5(F.concat_ws(" ", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.regexp_replace(value, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "<urn:uuid:$1-$2-5$3-8$4-$5>")


def iso_date(digits: Column) -> Column:
    """YYYYMMDDhhmmss, or without the seconds, as an ISO date."""
    return F.regexp_replace(
        F.rpad(digits, 14, "0"), r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z"
    )


def convert(arc: DataFrame, min_bytes: int = 0) -> DataFrame:
    """WARC records of the ARC records, with ``type``, identifiers, dates, digests, ``http`` and ``payload``.

    The version block becomes a warcinfo record, an HTTP response a response
    record, anything else a resource record. Of the responses whose payloads of
    at least ``min_bytes`` bytes are equal, the one with the largest page id is
    kept (a null id is smaller than all others; of equal ids the largest
    identifier), the others become revisit records with its identifier, address
    and date and without payload. Records with an error are left out, they stay
    in ``arc``.
    """
    stored = materialize(
        arc.where("url is not null and error is null").select(
            "*",
            record_id(*[F.col(c) for c in ("file", "at", "url", "archived", "payload_digest")]).alias("record_id"),
            iso_date(F.col("archived")).alias("date"),
            F.when(F.col("url").startswith("filedesc://"), "warcinfo")
            .when(F.col("http").isNotNull(), "response")
            .otherwise("resource")
            .alias("kind"),
        ),
        "arc-records",
    )
    narrow = stored.where((F.col("kind") == "response") & (F.col("payload_bytes") >= min_bytes)).select(
        "payload_digest", "payload_bytes", "page_id", "record_id", "url", "date"
    )
    first = F.max(F.struct("page_id", "record_id", "url", "date")).alias("first")
    groups = narrow.groupBy("payload_digest", "payload_bytes").agg(first, F.count(F.lit(1)).alias("copies"))
    kept = materialize(groups.where("copies > 1").select("payload_digest", "payload_bytes", "first.*"), "kept-payloads")
    names = {"page_id": "first_page", "record_id": "first_id", "url": "first_url", "date": "first_date"}
    repeats = materialize(
        narrow.select("payload_digest", "payload_bytes", "record_id")
        .join(kept.withColumnsRenamed(names), ["payload_digest", "payload_bytes"])
        .where("record_id != first_id")
        .select("record_id", "first_id", "first_url", "first_date"),
        "repeats",
    )
    repeated = F.col("first_id").isNotNull()
    return stored.join(repeats, "record_id", "left").select(
        F.when(repeated, "revisit").otherwise(F.col("kind")).alias("type"),
        "record_id",
        F.nullif("url", F.lit("-")).alias("target_uri"),
        "date",
        F.when(F.col("ip") != "0.0.0.0", F.col("ip")).alias("ip"),
        F.when(F.col("http").isNotNull(), "application/http; msgtype=response")
        .when(F.col("kind") == "warcinfo", "application/warc-fields")
        .otherwise(F.col("content_type"))
        .alias("content_type"),
        "payload_digest",
        F.when(~repeated, F.col("block_digest")).alias("block_digest"),
        F.col("first_id").alias("refers_to"),
        F.nullif("first_url", F.lit("-")).alias("refers_to_uri"),
        F.col("first_date").alias("refers_to_date"),
        "version",
        "http",
        F.when(~repeated, F.col("payload")).alias("payload"),
    )


def write_warc(records: DataFrame, path: str) -> str:
    """Write the records of ``convert`` as compressed WARC files and return ``path``.

    A file is compressed as a whole; a record ends with two line breaks.
    """
    text = lambda value: F.lit(value).cast("binary")
    about = F.concat(
        text("software: tenura\r\nformat: WARC File Format 1.0\r\nconformsTo: converted from ARC version "),
        F.col("version").cast("string").cast("binary"), text("\r\n"),
    )
    blank = text("\r\n\r\n")
    block = (
        F.when(F.col("type") == "warcinfo", about)
        .when(F.col("http").isNull(), F.col("payload"))
        .otherwise(F.concat("http", blank, F.coalesce("payload", text(""))))
    )
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    held = F.col("type") != "warcinfo"
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.0"),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        F.when(held, line("WARC-Target-URI", F.col("target_uri"))),
        F.when(~held, line("WARC-Filename", F.col("target_uri"))),
        line("WARC-IP-Address", F.col("ip")),
        F.when(held, line("WARC-Block-Digest", F.concat(F.lit("sha1:"), "block_digest"))),
        F.when(held, line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest"))),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        line("WARC-Refers-To-Date", F.col("refers_to_date")),
        F.when(F.col("type") == "revisit", F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.octet_length("block").cast("string")),
    )
    record = F.concat(header.cast("binary"), blank, F.col("block"), text("\r\n"))
    return _write(records.withColumn("block", block).select(record.cast("string").alias("record")), path, "\r\n")


# ---- reading WARC


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (_words(line).partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _warc_header(lines: list[bytes]) -> int | None:
    if not lines[0].startswith(b"WARC/"):
        return -1
    if lines[-1].rstrip(b"\r"):
        return None
    length = _fields(lines).get("content-length", "")
    return int(length) if length.isascii() and length.isdigit() else -1


def _warc_row(record: tuple, blocks: bool) -> tuple:
    _, lines, block, error = record
    if not lines:
        return (*[None] * 12, error)
    fields = _fields(lines)
    kind = fields.get("warc-type")
    head, payload = split_http(block)
    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    computed = None if kind == "revisit" else sha1_base32(payload)
    if error is None and declared and computed and declared != computed:
        error = "payload does not have the declared digest"
    return (
        kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"),
        fields.get("warc-refers-to"), declared, len(block), head if blocks else None, payload if blocks else None,
        None if kind == "revisit" else len(payload), computed, _page_id(head), error,
    )


def read_warc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record of the compressed WARC files at ``path``; ``error`` as in ``read_arc`` or a wrong digest."""

    def archive():
        return Framer(_warc_header), lambda _, record: _warc_row(record, blocks)

    return _lines(spark, path).mapInArrow(lambda batches: _framed(batches, archive, _WARC), _WARC)


def captures(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, error) of all responses and revisits.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload,
    for a revisit those of the response it refers to, whose page id is
    ``refers_to``. A revisit without its response keeps the declared digest
    and has an error. The response of many revisits is one row, so a large
    group of copies is a skewed join that adaptive execution can split.
    """
    read = materialize(records.drop("http", "payload"), "captures")
    responses = read.where("type = 'response'")
    first = responses.select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("first_page"),
        F.col("payload_bytes").alias("first_bytes"),
        F.lit(True).alias("known"),
    )
    revisits = read.where("type = 'revisit'").drop("payload_bytes", "payload_digest").join(first, "refers_to", "left")
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"), "error",
    ).unionByName(
        revisits.select(
            "page_id", F.col("first_bytes").alias("payload_bytes"), F.col("declared_digest").alias("payload_digest"),
            F.col("type").alias("record_type"), F.col("first_page").alias("refers_to"),
            F.coalesce("error", F.when(F.col("known").isNull(), "response not found")).alias("error"),
        )
    )


def archive(pages: DataFrame, folder: str, min_bytes: int = 0, version: int | None = None, **columns: str) -> DataFrame:
    """Write ``pages`` as ARC under ``folder``, convert to WARC there, and give the captures read back.

    Every row of ``pages`` is one capture, repeated rows included: of equal
    rows one is the response. Null text is an empty payload; columns other than
    id, address and text do not matter. An empty table gives no captures.
    """
    spark = pages.sparkSession
    arc = read_arc(spark, write_arc(pages, f"{folder}/arc", version, **columns))
    return captures(read_warc(spark, write_warc(convert(arc, min_bytes), f"{folder}/warc"), blocks=False))
