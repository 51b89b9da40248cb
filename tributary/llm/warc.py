"""Operator 12: WARC archives, written with revisit records and read by a reader that salvages.

Writer: one gzip member per record (or plain records), pages with equal
payloads kept once.  Tasks write files under names of their own attempt; the
manifest, written by Spark, names the files of the attempts that count.

Reader: a record counts when its member ends well, its version line, fields
and length hold together and its block and payload digests agree.  Where one
does not, the reader searches byte by byte for the next member or version line
that passes all checks, goes on from there, and reports the bytes in between
as a gap with the reason of the first failure.  A file is read through a window
that holds one record (or the damaged stretch being searched), not the file.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, small_batches
from .token_files import _filesystem

#: Payloads of fewer bytes are always kept whole: a revisit record would not be shorter.
LEAST_SHARED = 100
#: A task opens its next file when one has so many bytes.
FILE_BYTES = 64 << 20
LEVEL = 6
_READ = 1 << 20
_LONGEST_HEADER = 1 << 20

# Fixed values of the format.
_VERSION = b"WARC/1.1\r\n"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP_MAGIC = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "application/http;msgtype=response"


class Damaged(ValueError):
    """A record that fails a check."""


@dataclass
class Record:
    """A record whose checks all passed."""

    fields: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.fields.get("warc-type", "")

    @property
    def payload(self) -> bytes:
        """What follows the header of an HTTP message; the block itself of other records."""
        if self.fields.get("content-type", "").startswith("application/http"):
            return self.block.partition(_END)[2]
        return self.block


def record_bytes(fields: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
    return _VERSION + lines + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + _END


def _digest_agrees(stated: str, data: bytes) -> bool:
    name, _, value = stated.partition(":")
    if name.lower() not in ("sha256", "sha1", "md5", "sha512"):
        return True  # an algorithm that is not known cannot be checked
    found = hashlib.new(name.lower(), data)
    return value.lower() in (found.hexdigest(), base64.b32encode(found.digest()).decode().lower())


def _header(head: bytes) -> tuple[dict[str, str], int]:
    """Fields by lower-case name, and the length of the block."""
    try:
        lines = head.decode().split("\r\n")[1:]
    except UnicodeDecodeError:
        raise Damaged("fields are not UTF-8") from None
    fields: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (" ", "\t") and last:  # continuation of the line before
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("line without a field")
        last = name.strip().lower()
        fields[last] = value.strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or not {"warc-type", "warc-record-id"} <= fields.keys():
        raise Damaged("fields are missing")
    return fields, int(length)


def _checked(fields: dict[str, str], block: bytes) -> Record:
    record = Record(fields, block)
    if not _digest_agrees(fields.get("warc-block-digest", ""), block):
        raise Damaged("block digest")
    if record.kind in ("response", "resource") and not _digest_agrees(
            fields.get("warc-payload-digest", ""), record.payload):
        raise Damaged("payload digest")
    return record


class _Window:
    """A part of a file that moves forward: bytes from ``base`` on, read as needed."""

    def __init__(self, source, size: int):
        self.source, self.size, self.base, self.held = source, size, 0, bytearray()

    def have(self, end: int) -> int:
        """Read up to offset ``end`` or the end of the file; returns the offset held."""
        while self.base + len(self.held) < min(end, self.size):
            more = self.source.read(max(_READ, min(end, self.size) - self.base - len(self.held)))
            if not more:
                self.size = self.base + len(self.held)
                break
            self.held += more
        return min(end, self.base + len(self.held))

    def get(self, start: int, end: int) -> bytes:
        end = self.have(end)
        return bytes(self.held[start - self.base:end - self.base])

    def drop(self, before: int) -> None:
        if before - self.base >= _READ:
            del self.held[:before - self.base]
            self.base = before

    def find(self, pattern: bytes, start: int, end: int) -> int:
        """First offset of ``pattern`` that lies within start and end, or -1."""
        end = self.have(end)
        at = self.held.find(pattern, start - self.base, end - self.base)
        return at + self.base if at >= 0 else -1


def _read_plain(window: _Window, at: int) -> tuple[Record, int]:
    if not _VERSION_LINE.match(window.get(at, at + 10)):
        raise Damaged("no version line")
    head_end = window.find(_END, at, at + _LONGEST_HEADER)
    if head_end < 0:
        raise Damaged("header without an end")
    fields, length = _header(window.get(at, head_end))
    start, end = head_end + 4, head_end + 4 + length
    if end + 4 > window.size:
        raise Damaged("cut short")
    block = window.get(start, end + 4)
    if len(block) < length + 4 or block[length:] != _END:
        raise Damaged("block without an end")
    return _checked(fields, block[:length]), end + 4


def _read_member(window: _Window, at: int) -> tuple[Record, int]:
    inflate = zlib.decompressobj(31)
    out, found, place = [], 0, at
    # The first bytes decide whether it is a record at all; only then is the rest read.
    step = 512
    while not inflate.eof:
        data = window.get(place, place + step)
        if not data:
            raise Damaged("member is cut short")
        try:
            out.append(inflate.decompress(data))
        except zlib.error:
            raise Damaged("member does not inflate") from None
        place += len(data)
        if found < 10 and (found := sum(map(len, out))) >= 10 and not _VERSION_LINE.match(b"".join(out)):
            raise Damaged("no version line")
        step = _READ
    raw = b"".join(out)
    head_end = raw.find(_END, 0, _LONGEST_HEADER)
    if not _VERSION_LINE.match(raw) or head_end < 0:
        raise Damaged("no version line")
    fields, length = _header(raw[:head_end])
    if len(raw) != head_end + 4 + length + 4 or raw[-4:] != _END:
        raise Damaged("length of the block")
    return _checked(fields, raw[head_end + 4:-4]), place - len(inflate.unused_data)


def _next_start(window: _Window, start: int) -> int:
    """The next offset from ``start`` on at which a member or a version line could begin, or -1."""
    overlap = 16
    while start < window.size:
        end = start + _READ
        places = [p for p in (window.find(_GZIP_MAGIC, start, end), window.find(b"WARC/1.", start, end)) if p >= 0]
        if places:
            return min(places)
        if window.have(end) >= window.size:
            return -1
        start = end - overlap
        window.drop(start)
    return -1


def salvage(source, size: int) -> Iterator[tuple[int, int, Record | str]]:
    """(offset, length, record) of every sound record of an open file, and (offset, length, reason) of every gap.

    Records and gaps come in order and cover the file without holes.  Members
    and plain records may be mixed.  A version line inside a damaged record's
    block is a record if it passes all checks.
    """
    window = _Window(source, size)
    at, gap, reason = 0, None, ""
    while at < window.size:
        try:
            read = _read_member if window.get(at, at + 3) == _GZIP_MAGIC else _read_plain
            record, end = read(window, at)
        except Damaged as failed:
            if gap is None:
                gap, reason = at, str(failed)
            window.drop(at + 1)
            at = _next_start(window, at + 1)
            if at < 0:
                break
            continue
        if gap is not None:
            yield gap, at - gap, reason
            gap = None
        yield at, end - at, record
        window.drop(end)
        at = end
    if gap is not None:
        yield gap, window.size - gap, reason


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, n_bytes: int,
                date: str, shared: bool = False, first: int | None = None) -> bytes:
    """The record of a page: a response, or (``shared``) a revisit of the response of page ``first``."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    if not shared:
        block += payload
    fields = {"WARC-Type": "revisit" if shared else "response", "WARC-Record-ID": _record_id(page_id, digest),
              "WARC-Date": date, "Content-Type": _HTTP}
    if url is not None:
        fields["WARC-Target-URI"] = urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~")
    fields["WARC-Payload-Digest"] = f"sha256:{digest}"
    fields["WARC-Block-Digest"] = f"sha256:{hashlib.sha256(block).hexdigest()}"
    if page_id is not None:
        fields["X-Page-Id"] = str(page_id)
    if shared:
        fields |= {"WARC-Profile": _IDENTICAL, "WARC-Refers-To": _record_id(first, digest),
                   "X-Refers-To-Page-Id": str(first), "X-Payload-Length": str(n_bytes)}
    return record_bytes(fields, block)


def shared_payloads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                    least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, url, payload, digest, n_bytes, shared, first): which pages repeat the payload of another.

    Payloads are compared by SHA-256 from ``least`` bytes on.  The smallest id
    of a payload holds it; rows that repeat that id (or pages none of which has
    an id) all hold it.  A shared payload is null here.  Ids of a payload are
    gathered by a partial minimum, payloads in one page only are not joined.
    """
    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                          F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    hashed = narrow.select("*", F.sha2("payload", 256).alias("digest"),
                           F.octet_length("payload").cast("long").alias("n_bytes"))
    first = (hashed.where(F.col("n_bytes") >= least).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"))
    shared = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return hashed.join(first, "digest", "left").select(
        "page_id", "url", F.when(~shared, F.col("payload")).alias("payload"), "digest", "n_bytes",
        shared.alias("shared"), F.when(shared, F.col("first")).alias("first"))


MANIFEST = "part long, number long, file string, n_records long, n_bytes long"


def _writer(folder: str, date: str, file_bytes: int, compressed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        filesystem, root = _filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        out, name, number, n_records, n_bytes = None, "", 0, 0, 0

        def put(record: bytes) -> None:
            nonlocal n_bytes
            if compressed:
                deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                record = deflate.compress(record) + deflate.flush()
            out.write(record)
            n_bytes += len(record)

        def close() -> pa.RecordBatch:
            nonlocal out, number, n_records, n_bytes
            out.close()
            row = pa.RecordBatch.from_pydict({"part": [part], "number": [number], "file": [name],
                                              "n_records": [n_records], "n_bytes": [n_bytes]})
            out, number, n_records, n_bytes = None, number + 1, 0, 0
            return row

        for batch in small_batches(batches):
            for row in range(batch.num_rows):
                values = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                if out is None:
                    name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.warc{'.gz' if compressed else ''}"
                    out = filesystem.open_output_stream(f"{root}/{name}", compression=None)
                    put(record_bytes({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                                      "WARC-Date": date, "WARC-Filename": name,
                                      "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
                put(page_record(**values, date=date))
                n_records += 1
                if n_bytes >= file_bytes:
                    yield close()
        if out is not None:
            yield close()
    return run


def write_archive(pages: DataFrame, folder: str, date: str | None = None, file_bytes: int = FILE_BYTES,
                  compressed: bool = True, **columns) -> DataFrame:
    """Write a record per row of ``pages`` to ``folder`` and return the manifest of its files.

    A null payload is an empty one, a null url or id is left out of the record.
    Repeated rows are written each.  Only the named columns are read
    (``shared_payloads`` has their names).  An empty table writes no file.  The
    folder must be one that all executors reach.
    """
    spark = pages.sparkSession
    ship_package(spark)
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    manifest = shared_payloads(pages, **columns).mapInArrow(
        _writer(f"{folder}/archive", date, file_bytes, compressed), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


ENTRIES = ("file string, offset long, length long, gap string, record_type string, record_id string, target_uri string, "
           "refers_to_id string, page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary")


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None


def _entry(name: str, offset: int, length: int, found: Record | str, with_payload: bool) -> dict:
    entry = dict.fromkeys([f.split()[0] for f in ENTRIES.split(", ")])
    entry |= {"file": name, "offset": offset, "length": length}
    if isinstance(found, str):
        return entry | {"gap": found}
    f, payload = found.fields, found.payload
    entry |= {"record_type": found.kind, "record_id": f["warc-record-id"], "target_uri": f.get("warc-target-uri"),
              "refers_to_id": f.get("warc-refers-to"), "page_id": _number(f.get("x-page-id")),
              "refers_to": _number(f.get("x-refers-to-page-id"))}
    if found.kind == "revisit":
        return entry | {"payload_bytes": _number(f.get("x-payload-length")),
                        "payload_digest": f.get("warc-payload-digest", "").partition(":")[2].lower() or None}
    return entry | {"payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(),
                    "payload": payload if with_payload else None}


def _reader(folder: str, with_payload: bool):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(ENTRIES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                path = f"{root}/{name}"
                held, size = [], 0
                with filesystem.open_input_stream(path, compression=None) as source:
                    for offset, length, found in salvage(source, filesystem.get_file_info(path).size):
                        held.append(_entry(name, offset, length, found, with_payload))
                        size += len(held[-1]["payload"] or b"") + 200
                        if size >= _READ:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)
    return run


def read_archive(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives that ``files`` names (column ``file``, within ``folder``).

    One row per sound record: place, type, ids, payload (null for a revisit,
    whose length and digest are those of the payload it refers to).  One row
    per gap: place and the failed check in ``gap``, all else null.  Every byte
    of a file lies in exactly one row.  A task reads one file at a time.
    """
    spark = files.sparkSession
    ship_package(spark)
    spread = files.select("file").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file")
    return spread.mapInArrow(_reader(folder, with_payload), ENTRIES)


def quarantined(entries: DataFrame) -> DataFrame:
    """The log of gaps: (file, offset, length, reason)."""
    return entries.where(F.col("gap").isNotNull()).select("file", "offset", "length", F.col("gap").alias("reason"))


def archived_pages(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The page records of an archive that ``write_archive`` wrote, in the files that its manifest names."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    entries = read_archive(manifest, f"{folder}/archive", with_payload)
    return entries.where(F.col("record_type").isin("response", "revisit"))
