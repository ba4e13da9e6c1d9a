"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged files.

Writer: each task writes its rows as gzip members (one record each) to archive files of about ``ARCHIVE_BYTES`` in a
shared folder. Of rows with equal payloads (SHA-256, of at least ``min_payload`` bytes) the one with the smallest id
becomes a response record, the others revisit records that name it. The written table of (file, size, records) is the
list of what counts: files that a lost task has left behind are not in it.

Reader: a member or plain record counts if everything about it checks out: the gzip checksum, version line, headers,
Content-Length, the closing line ends, block digest and payload digest. Where a check fails, the reader looks for the
next gzip magic or version line at which a whole valid record begins, goes on there, and logs the bytes between as a
quarantined gap with the reason of the failure. Records after a damaged one are never lost with it. A file is read by
one task through a window of ``WINDOW_BYTES``, so memory is bounded by the largest record.

Defined results: a null payload is empty; a null url becomes a URN of the row; a null id becomes an empty one and comes
after all others, so it never is the one that others refer to; rows that repeat the smallest id of a payload are all
responses; an empty table gives no archive and no records; an empty file has no records and no gap; other columns are
not written.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import bounded_batches
from ledgerlens.operators.small import settled
from ledgerlens.session import ensure_checkpoint_dir

ARCHIVE_BYTES = 64 << 20
WINDOW_BYTES = 1 << 20
HEADER_BYTES = 1 << 16
BATCH_BYTES = 4 << 20
# Version line, profile of a revisit record, gzip magic, line ends.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
CRLF = b"\r\n"
# Bytes of a URL that may stand in a header line.
_URL_SAFE = "".join(chr(c) for c in range(0x21, 0x7F))

FILES = "file string, size long, records long"
RECORDS = (
    "file string, begin long, end long, record_type string, record_id string, target_uri string, date string,"
    " payload_digest string, payload_length long, refers_to string, payload binary"
)
GAPS = "file string, begin long, end long, reason string"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_urn(key: str | None) -> str:
    return f"urn:page:{quote(key or '', safe='')}"


def key_of(urn: str) -> str | None:
    """The id in a record's URN, null for the empty one."""
    return unquote(urn.removeprefix("urn:page:")) or None


def record_bytes(key: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit that names the response with that payload."""
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
    block = CRLF.join(http) + CRLF * 2 + (payload if refers_to is None else b"")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{record_urn(key)}>",
        "WARC-Date": date,
        "WARC-Target-URI": record_urn(key) if url is None else quote(url, safe=_URL_SAFE),
        "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}",
        "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<{record_urn(refers_to)}>"}
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = [VERSION, *[f"{name}: {value}".encode("ascii") for name, value in fields.items()]]
    return CRLF.join(lines) + CRLF * 2 + block + CRLF * 2


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own, the same bytes each time."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class Damaged(Exception):
    """Why no valid record begins at a place."""


def _digest_holds(named: str | None, data: bytes) -> bool:
    kind, _, value = (named or "").partition(":")
    return kind.lower() != "sha1" or value.upper() == sha1_base32(data)


def parse_record(data: bytes) -> tuple[dict, int]:
    """The record at the start of ``data`` and its length; raises :class:`Damaged`, or EOFError if more is needed."""
    end = data.find(CRLF * 2, 0, HEADER_BYTES)
    if end < 0:
        raise (EOFError if len(data) < HEADER_BYTES else Damaged)("no end of the headers")
    lines = data[:end].split(CRLF)
    if not lines[0].startswith(b"WARC/1."):
        raise Damaged("no version line")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("broken header line")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("latin-1")
    if not fields.get("warc-type") or not fields.get("warc-record-id"):
        raise Damaged("no type or id")
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise Damaged("no content length")
    start, stop = end + 4, end + 4 + int(size)
    closing = data[stop : stop + 4]
    if closing != CRLF * 2:
        raise (EOFError if len(closing) < 4 and (CRLF * 2).startswith(closing) else Damaged)("wrong content length")
    block = data[start:stop]
    if not _digest_holds(fields.get("warc-block-digest"), block):
        raise Damaged("wrong block digest")
    head, split, payload = block.partition(CRLF * 2)
    http = {}
    if "application/http" in fields.get("content-type", "") and split:
        http = dict(line.lower().split(b":", 1) for line in head.split(CRLF)[1:] if b":" in line)
    else:
        payload = block
    kind = fields.get("warc-type", "")
    if kind != "revisit" and not _digest_holds(fields.get("warc-payload-digest"), payload):
        raise Damaged("wrong payload digest")
    length = http.get(b"content-length", b"").strip()
    record = {
        "record_type": kind,
        "record_id": fields.get("warc-record-id", "").strip("<>"),
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_length": int(length) if kind == "revisit" and length.isdigit() else len(payload),
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "payload": None if kind == "revisit" else payload,
    }
    return record, stop + 4


class Archive:
    """A file that is looked at through a window of bytes."""

    def __init__(self, stream: pa.NativeFile, size: int) -> None:
        self.stream, self.size = stream, size
        self.base, self.held = 0, b""

    def read(self, at: int, n: int) -> bytes:
        if at < self.base or at + n > self.base + len(self.held):
            self.stream.seek(at)
            self.base, self.held = at, self.stream.read(max(n, WINDOW_BYTES))
        return self.held[at - self.base : at - self.base + n]

    def record(self, at: int) -> tuple[dict, int]:
        """The valid record that begins here and where it ends, or :class:`Damaged`."""
        start = self.read(at, 5)
        if start.startswith(MAGIC):
            unpacker, parts, place = zlib.decompressobj(31), [], at
            while not unpacker.eof:
                chunk = self.read(place, 1 << 14)
                if not chunk:
                    raise Damaged("cut member")
                try:
                    parts.append(unpacker.decompress(chunk))
                except zlib.error as error:
                    raise Damaged("bad member") from error
                if parts[0] and not VERSION.startswith(parts[0][:7]) and not parts[0].startswith(b"WARC/1."):
                    raise Damaged("no version line")
                place += len(chunk)
            data = b"".join(parts)
            try:
                record, length = parse_record(data)
            except EOFError as error:
                raise Damaged(str(error)) from error
            if length != len(data):
                raise Damaged("more than one record in a member")
            return record, place - len(unpacker.unused_data)
        if start != b"WARC/":
            raise Damaged("no record")
        n = HEADER_BYTES
        while True:
            data = self.read(at, n)
            try:
                record, length = parse_record(data)
                return record, at + length
            except EOFError as error:
                if len(data) < n:
                    raise Damaged(str(error)) from error
                n *= 2

    def candidate(self, at: int) -> int:
        """The next place at which a member or a version line may begin."""
        while at < self.size:
            window = self.read(at, WINDOW_BYTES)
            found = [i for i in (window.find(MAGIC), window.find(b"WARC/1.")) if i >= 0]
            if found:
                return at + min(found)
            # A mark may lie across the end of the window.
            at += max(1, len(window) - 6)
        return self.size

    def walk(self) -> Iterator[tuple[int, int, dict | str]]:
        """(begin, end, record), or (begin, end, reason) for a gap, from the first byte to the last."""
        at = 0
        while at < self.size:
            try:
                record, end = self.record(at)
                yield at, end, record
                at = end
                continue
            except Damaged as error:
                reason = str(error)
            gap, at = at, self.candidate(at + 1)
            while at < self.size:
                try:
                    self.record(at)
                    break
                except Damaged:
                    at = self.candidate(at + 1)
            yield gap, at, reason


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        path = rest if colon else uri
        return fs.LocalFileSystem(), "/" + path.lstrip("/") if path.startswith("/") else path
    return fs.FileSystem.from_uri(uri)


def write_archives(
    pages: DataFrame, folder: str, payload: str = "html", key: str = "page_id", url: str = "url",
    min_payload: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write the rows to archives in ``folder`` and return the written table of (file, size, records)."""
    bounded_batches(pages.sparkSession)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("sha", F.sha2("body", 256))
    counted = rows.where(F.octet_length("body") >= min_payload).groupBy("sha")
    # Written, so that its size tells whether it is sent to all tasks, and a hot payload can be split if not.
    repeated = settled(counted.agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to")
    named = rows.join(repeated, "sha", "left").select(F.col("key").cast("string").alias("key"), "url", "body", refers)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        system.create_dir(root, recursive=True)
        stream, name, size, records = None, "", 0, 0

        def done() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pydict({"file": [name], "size": [size], "records": [records]})

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                if stream is None:
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = system.open_output_stream(f"{root}/{name}", compression=None)
                data = member(record_bytes(*[v.as_py() for v in row], date))
                stream.write(data)
                size, records = size + len(data), records + 1
                if size >= ARCHIVE_BYTES:
                    yield done()
                    stream = None
        if stream is not None:
            yield done()

    return settled(named.mapInArrow(written, FILES))


def _walked(files: DataFrame, folder: str, schema: str, gaps: bool) -> DataFrame:
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(name, types[kind]) for name, kind in (field.split() for field in schema.split(","))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{root}/{name}") as stream:
                    rows, held = [], 0
                    for begin, end, found in Archive(stream, stream.size()).walk():
                        if isinstance(found, str) != gaps:
                            continue
                        rows.append({"file": name, "begin": begin, "end": end} | ({"reason": found} if gaps else found))
                        held += end - begin if gaps else len(found["payload"] or b"") + 256
                        if held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, arrow)

    return files.mapInArrow(read, schema)


def read_archives(files: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of the named files; ``files`` has a column ``file``, one task reads one file."""
    bounded_batches(files.sparkSession)
    dealt = files.select("file").repartition(max(1, files.count()), "file")
    return _walked(dealt, folder, RECORDS, False), _walked(dealt, folder, GAPS, True)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/archives/{uuid.uuid4().hex}"
