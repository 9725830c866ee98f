"""WARC archives: a writer with revisit records and a reader that splits files by byte ranges.

Writing: one gzip member a record (``response`` with the payload, or ``revisit`` that refers to
the response of an equal payload). Which payloads are equal is found over digests alone, so
payloads aren't shuffled: only digests that occur more than once are joined to the rows.

Reading: a task scans its byte range for the gzip magic, validates each candidate by decoding
its first bytes to a WARC header, and owns the records whose member starts inside its range,
however far they reach beyond it. Behind a valid member the next one starts at once, so bytes
within members are never taken for one. Memory is bounded by a block and, where payloads are
asked for, one record.

A null payload is empty. A null page id or URL is left out of the record and read back as
null; null ids never become the response others refer to. Rows that repeat a page id are
records of their own; equal rows of the largest id are all responses. An empty table makes no
file and an empty result. A member cut off at a file's end is no record. Only the named
columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import files
from vigil.llm.common import materialize, partitions_for, small_batches
from vigil.session import scratch_path

REVISIT_BYTES, FILE_BYTES, RANGE_BYTES, LEVEL = 1000, 128 << 20, 4 << 20, 3
MAGIC, READ, STEP = b"\x1f\x8b\x08", 1 << 20, 1 << 16
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of URLs


def _record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}')}>"


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, size: int, sha1_hex: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One uncompressed record; a revisit has the payload's HTTP header only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1_hex)).decode()}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: all but control characters, blanks and what lies beyond ASCII
_URL_SAFE = "".join(chr(c) for c in range(33, 127))


def _member(data: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _write(folder: str, file_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def close() -> pa.RecordBatch:
            uri = files.fresh(folder, "pages", ".warc.gz")
            files.write(uri, parts)
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64())], ["uri", "size"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "payload_bytes", "digest", "refers_to"))):
                page, url, payload, n, digest, refers = row
                parts.append(_member(record("response" if refers is None else "revisit", page, url, payload, n, digest, refers), level))
                size += len(parts[-1])
                if size >= file_bytes:
                    yield close()
                    parts, size = [], 0
        if parts:
            yield close()
    return run


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_bytes: int = REVISIT_BYTES,
          file_bytes: int = FILE_BYTES, level: int = LEVEL, folder: str | None = None) -> DataFrame:
    """Write all rows; returns the kept table of files ``uri, size``."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = small_batches(pages).select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                                       F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    repeated = materialize(rows.where(F.col("payload_bytes") >= revisit_bytes).groupBy("digest")
                           .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
                           .where("n > 1 and response is not null").drop("n"), "repeated")
    marked = rows.join(repeated, "digest", "left").withColumn(
        "refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("response")), F.col("response")))
    payload = F.when(F.col("refers_to").isNull(), F.col("payload"))
    lean = marked.select("page_id", "url", F.coalesce(payload, F.lit(b"")).alias("payload"), "payload_bytes", "digest", "refers_to")
    return materialize(lean.mapInArrow(_write(folder, file_bytes, level), "uri string, size long"), "archives")


class _Reader:
    """Bytes of a file from a place on, read in blocks; ``at`` is the file's place of ``data[pos]``."""

    def __init__(self, handle, at: int):
        self.handle, self.start, self.data, self.pos = handle, at, b"", 0
        handle.seek(at)

    @property
    def at(self) -> int:
        return self.start + self.pos

    def more(self) -> bool:
        block = self.handle.read(READ)
        if block:
            self.data, self.start, self.pos = self.data[self.pos:] + block, self.start + self.pos, 0
        return bool(block)


def _parsed(header: bytes) -> dict[str, str] | None:
    lines = header.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields if fields.get("content-length", "").isdigit() else None


class _Record:
    """A record while its bytes come in: the digest and size of its payload, the payload if kept."""

    def __init__(self, fields: dict[str, str], keep: bool):
        self.fields, self.left, self.keep = fields, int(fields["content-length"]), keep
        self.head = b"" if fields.get("content-type", "").startswith("application/http") else None
        self.sha1, self.size, self.kept = hashlib.sha1(), 0, []
        self.http: dict[str, str] = {}

    def take(self, data: bytes) -> None:
        self.left -= len(data)
        if self.head is not None:
            self.head += data
            cut = self.head.find(b"\r\n\r\n")
            if cut < 0:
                return
            lines = self.head[:cut].decode("latin-1").split("\r\n")[1:]
            self.http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            data, self.head = self.head[cut + 4:], None
        self.sha1.update(data)
        self.size += len(data)
        if self.keep:
            self.kept.append(data)

    def row(self) -> dict:
        f = self.fields
        revisit = f.get("warc-type") == "revisit"
        said = f.get("warc-payload-digest", "")
        digest = base64.b32decode(said[5:]).hex() if revisit and said.startswith("sha1:") else self.sha1.hexdigest()
        size = int(self.http["content-length"]) if revisit and self.http.get("content-length", "").isdigit() else self.size
        page = f.get("x-page-id")
        return {"record_type": f.get("warc-type"), "record_id": f.get("warc-record-id"), "refers_to_id": f.get("warc-refers-to"), "url": f.get("warc-target-uri"),
                "page_id": int(page) if page is not None else None, "payload_bytes": size, "payload_digest": digest,
                "payload": b"".join(self.kept) if self.keep and not revisit else None}


class _Parser:
    """Records out of a member's decoded bytes as they come."""

    def __init__(self, keep: bool):
        self.keep, self.rows, self.begun, self.plain, self.current, self.seen = keep, [], False, bytearray(), None, 0

    def take(self, data: bytes) -> bool:
        """False if the bytes can't be records."""
        self.plain += data
        while self.plain:
            if self.current is None:
                if not self.seen:
                    del self.plain[:len(self.plain) - len(self.plain.lstrip(b"\r\n"))]
                cut = self.plain.find(b"\r\n\r\n", max(self.seen - 3, 0))
                if cut < 0:  # a header is of any length; what is no header shows in its first line
                    self.seen = len(self.plain)
                    return bytes(self.plain[:7]) == b"WARC/1."[:len(self.plain)]
                fields = _parsed(bytes(self.plain[:cut]))
                if fields is None:
                    return False
                self.begun, self.current, self.seen = True, _Record(fields, self.keep), 0
                del self.plain[:cut + 4]
            part = bytes(self.plain[:self.current.left])
            self.current.take(part)
            del self.plain[:len(part)]
            if self.current.left:
                return True
            self.rows.append(self.current.row())
            self.current = None
        return True


def _member_records(reader: _Reader, keep: bool) -> list[dict] | None:
    """The records of the gzip member at the reader's place, which moves behind it.

    None if there is no member whose content starts with a record; the place stays then.
    """
    gunzip, parser, ahead = zlib.decompressobj(31), _Parser(keep), 0
    while not gunzip.eof:
        if reader.pos + ahead == len(reader.data):
            if parser.begun:  # what is decoded needn't be held
                reader.pos, ahead = reader.pos + ahead, 0
            if not reader.more():
                return parser.rows if parser.begun else None
        step = reader.data[reader.pos + ahead:reader.pos + ahead + STEP]
        try:
            good = parser.take(gunzip.decompress(step, READ))
            while good and gunzip.unconsumed_tail and not gunzip.eof:
                good = parser.take(gunzip.decompress(gunzip.unconsumed_tail, READ))
        except zlib.error:
            good = False
        if not good:
            return parser.rows if parser.begun else None
        ahead += len(step) - len(gunzip.unused_data)
    if not parser.begun:
        return None
    reader.pos += ahead
    return parser.rows


def records_in(handle, start: int, end: int, keep: bool = False) -> Iterator[dict]:
    """The records whose member starts at ``start`` or later and before ``end``."""
    reader = _Reader(handle, start)
    while reader.at < end:
        place = reader.data.find(MAGIC, reader.pos)
        if place < 0:
            reader.pos = max(reader.pos, len(reader.data) - len(MAGIC) + 1)  # the magic may go on in the next block
            if not reader.more():
                return
            continue
        reader.pos = place
        if reader.at >= end:
            return
        before = reader.at
        found = _member_records(reader, keep)
        if found:
            yield from found
        if reader.at == before:
            reader.pos += 1


_FIELDS = (("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()), ("url", pa.string()), ("page_id", pa.int64()),
           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()))


def _read(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in _FIELDS], [n for n, _ in _FIELDS])

        for b in batches:
            for uri, start, end in zip(*(b.column(c).to_pylist() for c in ("uri", "start", "end"))):
                system, path = files.opened(uri)
                rows, size = [], 0
                with system.open_input_file(path) as handle:
                    for r in records_in(handle, start, end, keep):
                        rows.append(r)
                        size += len(r["payload"] or b"") + 500
                        if size > READ:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)
    return run


def read(archives: DataFrame, keep_payload: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``record_type, record_id, refers_to_id, url, page_id, payload_bytes, payload_digest, payload``
    of each record of the files ``uri, size``; the payload only if asked for, and of no revisit.

    Size and digest are of the full payload: as read of a response, as stated by a revisit.
    """
    n = F.ceil(F.col("size") / range_bytes).cast("int")
    ranges = archives.where("size > 0").select("uri", "size", F.explode(F.sequence(F.lit(0), n - 1)).alias("i")).select(
        "uri", (F.col("i").cast("long") * range_bytes).alias("start"), F.least("size", (F.col("i") + 1).cast("long") * range_bytes).alias("end"))
    spread = ranges.repartition(partitions_for(archives), "uri", "start")
    return spread.mapInArrow(_read(keep_payload), ", ".join(f"{n} {_SQL[t]}" for n, t in _FIELDS))


_SQL = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}


def with_referred(records: DataFrame) -> DataFrame:
    """Adds ``refers_to``: the page id of the response that a revisit refers to."""
    known = records.where("record_type = 'response' and page_id is not null").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).distinct()
    return records.join(known, "refers_to_id", "left")
