"""Operator 5: token ids in Simple-8b files.

Word format (Simple-8b): each 64-bit word holds a 4-bit selector and up to 60
bits of values, all of one width; values that need more than 60 bits follow an
escape word as they are.  Blocks of a fixed number of ids start on a word of
their own and are found by offsets, so a block is decoded on its own: words
with the same selector are unpacked together by array operations.

A file holds the documents of one key range in ascending order.  Tasks write
files under names of their own attempt; the manifest, written by Spark, names
the files of the attempts that count, so a task that is lost or runs twice
leaves nothing that is read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.session import scratch_path

from .common import ship_package
from .tokens import default_vocabulary, tokenizer

# Selector -> how many values of how many bits a word holds (fixed values of Simple-8b).
# Selectors 0 and 1 stand for runs of 240 and 120 ones in the published format; here 0 is the escape.
COUNTS = np.array([0, 0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 0
BLOCK_IDS = 4096
MAGIC = b"S8BTOK01"
#: Ids a file holds at most before the task opens the next one; bounds the writer's memory.
FILE_IDS = 4_000_000


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; 255 marks values that only an escape holds."""
    small = values < np.uint64(1 << 52)  # exact as floating-point numbers
    bits = np.frexp(np.where(small, values, 0).astype(np.float64))[1].astype(np.uint8)
    if not small.all():
        high = np.frexp((values >> np.uint64(32)).astype(np.float64))[1].astype(np.uint8) + np.uint8(32)
        bits = np.where(small, bits, np.where(high <= WIDTHS[-1], high, 255)).astype(np.uint8)
    return bits


def _selectors(values: np.ndarray, block_ids: int) -> np.ndarray:
    """For every place the selector of a word that would start there, blocks below one another.

    The widest value among the next 2, 3, 4, ... is the wider one of two
    shorter stretches, so each count takes one pass.
    """
    n = len(values)
    blocks = -(-n // block_ids)
    bits = np.full((blocks, block_ids), 255, np.uint8)  # what is behind the end fits nowhere
    bits.reshape(-1)[:n] = _bit_lengths(values)
    choice = np.where(bits <= WIDTHS[-1], len(COUNTS) - 1, ESCAPE).astype(np.uint8)
    widest, reach = bits, 1
    known = {1: bits}
    for s in range(len(COUNTS) - 2, 1, -1):
        count = int(COUNTS[s])
        if count > block_ids:
            break
        # Stretches of ``reach`` and the longest known one that completes the count (they may overlap).
        other = max(k for k in known if k <= reach and k + reach >= count or k == reach)
        while reach + other < count:
            widest = np.maximum(widest[:, :widest.shape[1] - other], widest[:, other:])
            reach += other
            known[reach] = widest
            other = max(k for k in known if k <= reach)
        shift = count - other
        both = np.maximum(widest[:, :block_ids - count + 1], known[other][:, shift:shift + block_ids - count + 1])
        widest, reach = both, count
        known[count] = both
        choice[:, :block_ids - count + 1][both <= WIDTHS[s]] = s
    return choice


def encode_blocks(values: np.ndarray, block_ids: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of ``values`` (unsigned, up to 64 bits) and where each block of ``block_ids`` begins among them.

    Words take as many values as fit, from each block's first on; the words
    of all blocks are found side by side.
    """
    values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    block_ids = min(block_ids, n)
    choice = _selectors(values, block_ids).reshape(-1)
    step = np.where(COUNTS == 0, 1, COUNTS).astype(np.int64)[choice]
    begins = np.arange(0, n, block_ids)
    is_word = np.zeros(n, bool)
    at, stop = begins, np.minimum(begins + block_ids, n)
    while len(at):
        is_word[at] = True
        at = at + step[at]
        open_ = at < stop
        if not open_.all():
            at, stop = at[open_], stop[open_]
    starts = np.flatnonzero(is_word)
    selectors = choice[starts]
    escaped = selectors == ESCAPE
    places = np.cumsum(1 + escaped) - 1 - escaped
    words = np.zeros(len(starts) + int(escaped.sum()), np.uint64)
    for s in np.unique(selectors):
        mine = selectors == s
        if s == ESCAPE:
            words[places[mine] + 1] = values[starts[mine]]
            continue
        first, width = starts[mine], int(WIDTHS[s])
        word = np.full(len(first), int(s) << 60, np.uint64)
        for i in range(int(COUNTS[s])):
            word |= values[first + i] << np.uint64(i * width)
        words[places[mine]] = word
    return words, np.append(places[np.searchsorted(starts, begins)], len(words))


def encode_block(values: np.ndarray) -> np.ndarray:
    """The words of one block."""
    return encode_blocks(values, max(1, len(values)))[0]


def decode_block(words: np.ndarray) -> np.ndarray:
    """The values that ``encode_block`` packed (or several blocks in a row), as uint64."""
    words = words.astype(np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    if not len(words):
        return words
    if (selectors == ESCAPE).any():
        # The word after an escape is a value as it stands, whatever its upper bits look like.
        raw = np.zeros(len(words), bool)
        at = 0
        for at in np.flatnonzero(selectors == ESCAPE).tolist():
            if not raw[at]:
                raw[at + 1] = True
        counts = np.where(raw, 1, COUNTS[selectors])
        counts[(selectors == ESCAPE) & ~raw] = 0
    else:
        raw, counts = np.zeros(len(words), bool), COUNTS[selectors]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]), np.uint64)
    begins = ends - counts
    out[begins[raw]] = words[raw]
    for s in np.unique(selectors[~raw]):
        if s == ESCAPE:
            continue
        mine = np.flatnonzero((selectors == s) & ~raw)
        first, left, width = begins[mine], words[mine], int(WIDTHS[s])
        mask = np.uint64((1 << width) - 1)
        for i in range(int(COUNTS[s])):
            out[first + i] = (left >> np.uint64(i * width)) & mask
    return out


def pack_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: header, block words, block offsets, document index, footer.

    The document index holds id, whether the id is null, and number of token
    ids per document; offsets are in 64-bit words, one per block and the end.
    """
    words, offsets = encode_blocks(ids)
    body = words.astype("<u8").tobytes()
    index = (np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
             + np.array([d is None for d in doc_ids], "<u1").tobytes() + counts.astype("<i8").tobytes())
    footer = struct.pack("<QQQI", len(ids), len(offsets) - 1, len(doc_ids), zlib.crc32(body))
    return MAGIC + body + offsets.astype("<u8").tobytes() + index + footer + MAGIC


class TokenFile:
    """A file of ``pack_file``, read block by block."""

    FOOTER = struct.calcsize("<QQQI") + len(MAGIC)

    def __init__(self, data: bytes):
        if data[:8] != MAGIC or data[-8:] != MAGIC:
            raise ValueError("not a Simple-8b token file, or cut short")
        self.n_ids, n_blocks, n_docs, crc = struct.unpack("<QQQI", data[-self.FOOTER:-8])
        index = len(data) - self.FOOTER - 17 * n_docs
        body_end = index - 8 * (n_blocks + 1)
        if zlib.crc32(data[8:body_end]) != crc:
            raise ValueError("token file is damaged")
        self.words = np.frombuffer(data, "<u8", (body_end - 8) // 8, 8)
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, body_end)
        ids = np.frombuffer(data, "<i8", n_docs, index)
        null = np.frombuffer(data, "<u1", n_docs, index + 8 * n_docs)
        self.counts = np.frombuffer(data, "<i8", n_docs, index + 9 * n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null)]

    def block(self, i: int) -> np.ndarray:
        return decode_block(self.words[int(self.offsets[i]):int(self.offsets[i + 1])])

    def ids(self, start: int, count: int) -> np.ndarray:
        """Token ids ``start`` to ``start + count`` of the file, decoding only the blocks they lie in."""
        if not count:
            return np.empty(0, np.uint64)
        first, last = start // BLOCK_IDS, (start + count - 1) // BLOCK_IDS
        found = np.concatenate([self.block(i) for i in range(first, last + 1)])
        return found[start - first * BLOCK_IDS:start - first * BLOCK_IDS + count]


def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def _writer_of(folder: str, vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        filesystem, root = _filesystem(folder)
        encode = tokenizer(vocabulary).encode
        end = np.array([end_id], "<u4").tobytes()
        docs: list = []
        held: list[bytes] = []
        size, number = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, held, size, number
            ids = np.frombuffer(b"".join(held), "<u4")
            data = pack_file(docs, np.array([len(x) // 4 for x in held], np.int64), ids)
            name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.s8b"
            filesystem.create_dir(root, recursive=True)
            with filesystem.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "number": [number], "file": [name], "n_docs": [len(docs)], "n_ids": [len(ids)],
                 "n_bytes": [len(data)]})
            docs, held, size, number = [], [], 0, number + 1
            return row

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py()) + end
                docs.append(doc_id)
                held.append(ids)
                size += len(ids) // 4
                if size >= FILE_IDS:
                    yield flush()
        if docs:
            yield flush()
    return run


MANIFEST = "part long, number long, file string, n_docs long, n_ids long, n_bytes long"


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the token ids of all rows to ``folder`` and return the manifest of its files.

    Rows are dealt by ranges of the id (null first), ties by text hash, so
    files in order of (part, number) hold ascending ids.  A null text is an
    empty one: its only id is ``end_id``.  The folder must be one that all
    executors reach.  Only the two named columns are read.  An empty table
    writes no file.
    """
    spark = docs.sparkSession
    ship_package(spark)
    vocabulary = vocabulary or default_vocabulary()
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = narrow.repartitionByRange(n, *order).sortWithinPartitions(*order)
    manifest = ranged.mapInArrow(_writer_of(f"{folder}/ids", vocabulary, end_id), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _reader_of(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                with filesystem.open_input_stream(f"{root}/{name}") as source:
                    found = TokenFile(source.read())
                starts = np.concatenate([[0], np.cumsum(found.counts)])
                ids = memoryview(decode_block(found.words).astype("<u4").tobytes())
                cuts = (4 * starts).tolist()
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.doc_ids, pa.int64()), pa.array(starts[:-1] + before),
                     pa.array(found.counts), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files that the manifest names.

    start counts the ids of all documents before, over all files in order.
    Rows come back as they were written: repeated ones each, null ids as null,
    null and empty texts with the end id alone, rows of one id in order of their
    text hash.  Column names of the documents play no part.  A folder whose
    manifest names no file gives an empty result.
    Nothing but the files is read: each is decoded block by block in a task.
    """
    ship_package(spark)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per file; files hold millions of ids each.
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    files = placed.select("file", "before")
    spread = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file")
    return spread.mapInArrow(_reader_of(f"{folder}/ids"),
                             "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, **options) -> DataFrame:
    """``docs`` written as token files to a new shared folder and read back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "llm", "tokens")
    write_tokens(docs, folder, **options)
    return read_digests(spark, folder)
