"""Legacy web archives: ARC files are parsed and rewritten as WARC files.

``write_arc`` lays pages down in the older format, ``convert`` parses each record's header line by its
version's field list, takes the declared number of bytes, and synthesises the WARC identifiers,
timestamps, types and digests; ``read_warc`` parses the result by declared lengths. A record that is an
HTTP message becomes a response, or a revisit where another has its payload; any other becomes a
resource. The address, result code, checksum and location of the header line go along as named fields,
and the version block as the archive's warcinfo record.

Files go through Spark's own text and binaryFile sources, so they can lie on any store. A text row is
a whole file of at most FILE_BYTES, or of one record that is larger; so no file is too long to be read as
one row, and none is held twice in memory.

Defined results: a null html is an empty payload. Of records with equal payloads that with the largest
page_id is the response and the others are revisits of it; rows that repeat this id are responses too.
A null page_id is kept as null: it revisits if the payload has a response with an id, else it is a
response. A null url is written as ``unknown:``. Empty tables give empty archives. Further columns of
pages are not read. A header or a length that the format doesn't allow stops the job, or, with
``strict=False``, leaves out the rest of its file, which ``faults`` lists.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fresh_path, release, stored

#: Field lists of the two header lines (fixed values of the format).
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
ARCHIVED = "20200101000000"
PAGE_HEADER = "X-Page-Id"
#: Rows of a lookup that may be sent to every task; a row is a few dozen bytes.
BROADCAST_ROWS = 200_000
#: Bytes of an archive file before compression, unless one record has more: files are read whole.
FILE_BYTES = 16_000_000

PARSED = "page_id bigint, url string, archived string, mime string, http string, extra string, payload binary"
_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("archived", pa.string()), ("mime", pa.string()), ("http", pa.string()), ("extra", pa.string()), ("payload", pa.binary())])
#: WARC fields that keep what an ARC header line says besides (the first is the standard's own).
KEPT_FIELDS = {"IP-address": "WARC-IP-Address", "Result-code": "X-ARC-Result-Code", "Checksum": "X-ARC-Checksum", "Location": "X-ARC-Location"}
READ = "page_id bigint, url string, warc_type string, warc_date string, record_id string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("warc_type", pa.string()), ("warc_date", pa.string()), ("record_id", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


class BadArchive(ValueError):
    """A header or a declared length that the format doesn't allow. at: the byte where its record begins."""

    def __init__(self, why: str, at: int = 0):
        super().__init__(why)
        self.at = at


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uuid(page_id: int | None, digest: str, url: str) -> str:
    """A UUID (version 8) that holds the page's id in its free bits; without one, a name-based UUID."""
    if page_id is None:
        return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{url} {digest}"))
    low = page_id & (1 << 64) - 1
    return str(uuid.UUID(int=0x57A2C0DE << 96 | 8 << 76 | (low >> 62) << 64 | 2 << 62 | low & (1 << 62) - 1))


def page_of_uuid(text: str | None) -> int | None:
    """The page's id in a UUID made by record_uuid."""
    if not text:
        return None
    x = uuid.UUID(text.strip("<>").removeprefix("urn:uuid:"))
    if x.int >> 96 != 0x57A2C0DE or x.int >> 76 & 15 != 8:
        return None
    low = (x.int >> 64 & 3) << 62 | x.int & (1 << 62) - 1
    return low - (1 << 64) if low >> 63 else low


# ---- ARC


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 loomspark\n{' '.join(ARC_FIELDS[version])}\n".encode()
    head = ["filedesc://" + name, "0.0.0.0", ARCHIVED, "text/plain", *(["200", "-", "-", "0", name] if version == 2 else []), str(len(body))]
    return " ".join(head).encode() + b"\n" + body


def arc_record(version: int, url: str | None, page_id: int | None, payload: bytes, name: str) -> bytes:
    own = f"{PAGE_HEADER}: {page_id}\r\n" if page_id is not None else ""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    where = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "unknown:"
    head = [where, "0.0.0.0", ARCHIVED, "text/html", *(["200", "-", "-", "0", name] if version == 2 else []), str(len(block))]
    return " ".join(head).encode() + b"\n" + block


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of one archive file; "version" is that of the block before it."""
    at, fields, version = 0, None, 0
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        if end < 0:
            raise BadArchive("a header line has no end", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        parts = line.split(" ")
        try:
            length = int(parts[-1])
        except ValueError:
            raise BadArchive(f"no declared length: {line[:80]}", at) from None
        block = data[end + 1 : end + 1 + length] if length >= 0 else b""
        if length < 0 or len(block) < length:
            raise BadArchive(f"declared {length} bytes, found {len(block)}", at)
        if line.startswith("filedesc://"):
            first, _, rest = block.decode("utf-8", "replace").partition("\n")
            number = first.split(" ")[0]
            version = int(number) if number.isdigit() else 0
            fields = ARC_FIELDS.get(version)
            if fields is None or rest.split("\n")[0].split(" ") != list(fields):
                raise BadArchive(f"unknown version block: {first}", at)
            at = end + 1 + length
            continue
        if fields is None:
            raise BadArchive("no version block before the first record", at)
        if len(parts) != len(fields):
            raise BadArchive(f"{len(parts)} fields instead of {len(fields)}: {line[:80]}", at)
        yield dict(zip(fields, parts, strict=True)) | {"version": str(version)}, block
        at = end + 1 + length


def split_http(block: bytes) -> tuple[str, bytes]:
    """Head and body of an HTTP response; a block that is none is all body."""
    if not block.startswith(b"HTTP/"):
        return "", block
    m = re.search(rb"\r?\n\r?\n", block)
    return (block.decode("latin-1"), b"") if m is None else (block[: m.start()].decode("latin-1"), block[m.end() :])


def http_header(head: str, name: str) -> str | None:
    m = re.search(rf"(?im)^{re.escape(name)}:[ \t]*(.*?)[ \t]*\r?$", head)
    return m[1] if m else None


def write_arc(pages: DataFrame, path: str, version: int | None = None) -> None:
    """pages(page_id, url, html) as gzipped ARC files of one version; without one, files take turns."""
    most = FILE_BYTES

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        number = task

        def begin() -> bytes:
            nonlocal number, now, name
            now, name = version or 1 + number % 2, f"part-{task:06d}-{number - task:06d}.arc"
            number += 1
            return arc_version_block(now, name)

        now, name = 0, ""
        files = _Files(b"\n", begin, most)
        for batch in batches:
            for i, u, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                payload = p.as_py() or b""
                files.room(len(payload))
                yield from files.add(arc_record(now, u, i, payload, name))
        yield from files.rest()

    slim = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string").cast("binary"))
    _write(slim.mapInArrow(rows, "value binary"), path, "\n")


class _Files:
    """Records gathered to files of so many bytes at most, each as one row."""

    def __init__(self, end: bytes, begin: Callable[[], bytes], most: int):
        self.end, self.begin, self.most = end, begin, most
        self.held: list[bytes] = []
        self.full: list[bytes] = []
        self.size = 0

    def room(self, more: int) -> None:
        """Begin a file, or another one, if the next record needs it."""
        if self.held and self.size + more > self.most:
            self._close()
        if not self.held:
            self.held.append(self.begin())
            self.size = len(self.held[0])

    def add(self, record: bytes) -> Iterator[pa.RecordBatch]:
        self.held.append(record)
        self.size += len(record) + len(self.end)
        yield from self._out()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self._close()
        yield from self._out()

    def _close(self) -> None:
        self.full.append(self.end.join(self.held))
        self.held = []

    def _out(self) -> Iterator[pa.RecordBatch]:
        while self.full:
            yield pa.RecordBatch.from_arrays([pa.array([self.full.pop(0)], pa.binary())], names=["value"])


def _write(files: DataFrame, path: str, end: str) -> None:
    """Gzipped files, one for each row, with the format's end of a record behind it. Fast compression: archives are markup."""
    out = files.select(F.col("value").cast("string")).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    out.option("maxRecordsPerFile", 1).option("lineSep", end).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _inflate(data: bytes) -> bytes:
    import gzip

    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(x) for x in row if isinstance(x, bytes))
        if size >= most:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_arc(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A row for each record of the ARC files under path. Not strict: a file is read up to its first fault."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                for data in batch.column(1):
                    try:
                        for head, block in parse_arc(_inflate(data.as_py())):
                            http, payload = split_http(block)
                            page = http_header(http, PAGE_HEADER)
                            extra = "".join(f"{name}: {head[field]}\r\n" for field, name in KEPT_FIELDS.items() if head.get(field, "-") not in ("-", "0.0.0.0", ""))
                            yield int(page) if page else None, head["URL"], head["Archive-date"], head["Content-type"], http, extra + f"X-ARC-Version: {head['version']}\r\n", payload
                    except BadArchive:
                        if strict:
                            raise

        return _in_batches(each(), _PARSED)

    return _files(spark, path).mapInArrow(rows, PARSED)


def faults(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, why) of the first fault of each ARC file under path that has one."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    for _ in parse_arc(_inflate(data.as_py())):
                        pass
                except BadArchive as e:
                    found.append({"file": file, "at": e.at, "why": str(e)})
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema([("file", pa.string()), ("at", pa.int64()), ("why", pa.string())]))

    return _files(spark, path).mapInArrow(rows, "file string, at bigint, why string")


# ---- WARC


def warc_record(kind: str, url: str, date: str, record: str, digest: str, http: str, payload: bytes, refers: str | None = None, extra: str = "", mime: str = "text/html") -> bytes:
    block = http.encode("latin-1") + b"\r\n\r\n" * bool(http) + (b"" if kind == "revisit" else payload)
    mime = "application/http; msgtype=response" if http else mime
    more = f"WARC-Refers-To: <urn:uuid:{refers}>\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n" if refers else ""
    if kind == "revisit" and not http:
        more += f"X-Payload-Length: {len(payload)}\r\n"
    head = (
        f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{record}>\r\nWARC-Date: {date}\r\nWARC-Target-URI: {url}\r\n"
        f"WARC-Payload-Digest: sha1:{digest}\r\nWARC-Block-Digest: sha1:{sha1_base32(block)}\r\n{extra}{more}Content-Type: {mime}\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block


def warcinfo_record(name: str) -> bytes:
    """What stands for the version block at the begin of a file."""
    block = f"software: loomspark\r\nformat: WARC File Format 1.1\r\ndescription: converted from ARC\r\nfilename: {name}\r\n".encode()
    record = uuid.uuid5(uuid.NAMESPACE_URL, name)
    return f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{record}>\r\nWARC-Date: {warc_date(ARCHIVED)}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block


def warc_date(arc_date: str) -> str:
    """ISO 8601 of an ARC date of 12 or 14 digits."""
    digits = re.sub(r"\D", "", arc_date).ljust(14, "0")[:14]
    return datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of one WARC file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise BadArchive(f"no WARC header at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(head["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) < length or data[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
            raise BadArchive(f"declared {length} bytes, found {len(block)} or no end of record")
        yield head, block
        at = end + 8 + length


def responses(digests: DataFrame) -> DataFrame:
    """(page_id, refers_to, digest) of each of digests(page_id, digest) that repeats another's payload.

    Digests are summed up before they are dealt out, so a payload that fills a third of the archive
    costs one row a task; the losers alone are joined to their response.
    """
    best = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND refers_to IS NOT NULL")
    best = stored(best.drop("n"), "repeated-payloads")
    return digests.join(best, "digest").filter("NOT page_id <=> refers_to").select("page_id", "refers_to", "digest").distinct()


def convert(spark: SparkSession, arc: str, warc: str, strict: bool = True) -> None:
    """ARC files under arc, rewritten as gzipped WARC files under warc. They are parsed twice: for the digests, and to be written."""
    records = read_arc(spark, arc, strict).withColumn("digest", F.sha1("payload"))
    digests = stored(records.select("page_id", "digest"), "digests")
    losers = stored(responses(digests), "revisits")
    discard(digests)
    side = F.broadcast(losers) if losers.count() <= BROADCAST_ROWS else losers
    marked = records.join(side.withColumnsRenamed({"page_id": "_page", "digest": "_digest"}), (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_page")), "left")
    most = FILE_BYTES

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0

        def begin() -> bytes:
            nonlocal number
            number += 1
            return warcinfo_record(f"part-{task:06d}-{number:06d}.warc")

        files = _Files(b"\r\n\r\n", begin, most)
        for batch in batches:
            heads = zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 5, 7)), strict=True)
            for (page, url, date, mime, http, extra, refers), payload in zip(heads, batch.column(6), strict=True):
                payload = payload.as_py()
                digest = sha1_base32(payload)
                kind = ("response" if http else "resource") if refers is None else "revisit"
                files.room(len(payload))
                yield from files.add(warc_record(kind, url, warc_date(date), record_uuid(page, digest, url), digest, http, payload, None if refers is None else record_uuid(refers, digest, url), extra, mime))
        yield from files.rest()

    values = marked.select("page_id", "url", "archived", "mime", "http", "extra", "payload", "refers_to").mapInArrow(rows, "value binary")
    _write(values, warc, "\r\n\r\n")
    discard(losers)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the WARC files under path but the warcinfo ones; a revisit's payload is null, its size and digest are the full payload's."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                for data in batch.column(1):
                    for head, block in parse_warc(_inflate(data.as_py())):
                        if head["warc-type"] == "warcinfo":
                            continue
                        http, payload = split_http(block)
                        page, revisit = http_header(http, PAGE_HEADER), head["warc-type"] == "revisit"
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        if not revisit and sha1_base32(payload) != digest:
                            raise BadArchive(f"digest of {head['warc-record-id']}")
                        size = int(head.get("x-payload-length") or http_header(http, "Content-Length") or 0) if revisit else len(payload)
                        yield (int(page) if page else page_of_uuid(head["warc-record-id"]), head["warc-target-uri"], head["warc-type"], head["warc-date"], head["warc-record-id"], page_of_uuid(head.get("warc-refers-to")) if revisit else None, size, digest, None if revisit else payload)

        return _in_batches(each(), _READ)

    return _files(spark, path).mapInArrow(rows, READ)


def archive_pages(pages: DataFrame, version: int | None = None) -> DataFrame:
    """pages through ARC and WARC files in the shared folder, as read back."""
    spark = pages.sparkSession
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    write_arc(pages, arc, version)
    convert(spark, arc, warc)
    release(spark, [arc])
    return read_warc(spark, warc)
