"""Operator 10: mixture-controlled packing of token ids into sequences.

Each source is a queue of token ids.  Deficit round-robin fills every window
(sequence): a source earns credit in proportion to its target share, spends
whole tokens, and carries what is left over to the next window.  Documents are
cut where a window ends; the ids that do not fill a last whole window go to
windows whose sizes are powers of two, so nothing is padded.

The windows are laid out without touching the ids.  From the token totals of
the sources the same round-robin first deals them to large groups of windows,
then within a group to smaller ones, down to single windows; the credit is
carried through each level, so any task works out the part of the layout its
own documents fall in, and all tasks agree.  A document's place in its queue is
its offset within the chunk (task) that tokenised it plus the totals of the
chunks before.  Ids are written once and never shuffled.
"""

from __future__ import annotations

import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, small_batches, stored
from .tokens import default_vocabulary, tokenizer

CAPACITY = 4096
#: Parts a group of windows is dealt to at a time.
FAN = 256
#: Layouts of groups that a task keeps at hand.
KEPT_GROUPS = 64


def deficit_round_robin(totals: list[int], caps: list[int], shares: list[int] | None = None) -> np.ndarray:
    """takes[k, s]: tokens of queue s in window k; rows sum to ``caps``, columns to ``totals``.

    In every window queue s earns shares[s] / sum(shares) of the window as
    credit (``shares`` defaults to the totals: every window holds the mixture of
    the whole) and spends its whole tokens as far as its queue lasts; what is
    then missing is spent in advance by the queues with the most credit.
    Arithmetic is exact, in units of 1 / sum(shares).
    """
    left = np.array(totals, object)
    shares = np.array(totals if shares is None else shares, object)
    whole = int(shares.sum()) or 1
    credit = np.zeros(len(left), object)
    out = np.zeros((len(caps), len(left)), np.int64)
    for k, cap in enumerate(caps):
        if k + 1 == len(caps):
            out[k] = left.astype(np.int64)
            break
        credit = credit + shares * cap
        take = np.minimum(np.maximum(credit // whole, 0), left)
        missing = cap - int(take.sum())
        while missing:
            rest = credit - take * whole
            if missing > 0:
                open_ = np.flatnonzero(left > take)
                order = open_[np.argsort([-rest[i] for i in open_], kind="stable")][:missing]
                each = max(1, missing // len(open_))
                for i in order:
                    more = min(each, int(left[i] - take[i]), missing)
                    take[i] += more
                    missing -= more
            else:
                held = np.flatnonzero(take > 0)
                order = held[np.argsort([rest[i] for i in held], kind="stable")][:-missing]
                for i in order:
                    take[i] -= 1
                    missing += 1
        credit = credit - take * whole
        left = left - take
        out[k] = take.astype(np.int64)
    return out


class Layout:
    """Which window, and where in it, each token of each queue goes to."""

    def __init__(self, totals: list[int], capacity: int = CAPACITY, shares: list[int] | None = None,
                 fan: int = FAN):
        self.totals, self.capacity, self.shares, self.fan = [int(t) for t in totals], capacity, shares, fan
        total = sum(self.totals)
        self.full, rest = divmod(total, capacity)
        self.tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        self.windows = self.full + len(self.tail)
        self.span = 1
        while self.span * fan < self.windows:
            self.span *= fan
        self.groups: OrderedDict = OrderedDict()

    def tokens(self, first: int, last: int) -> int:
        """Tokens in the windows from ``first`` up to but without ``last``."""
        whole = max(0, min(last, self.full) - min(first, self.full))
        return whole * self.capacity + sum(self.tail[max(0, first - self.full):max(0, last - self.full)])

    def group(self, first: int, span: int, totals: list[int], shares=None) -> tuple[np.ndarray, np.ndarray]:
        """Of the windows ``first`` to ``first + span * fan``, by parts of ``span``: cumulative takes, takes."""
        key = (first, span)
        if key in self.groups:
            self.groups.move_to_end(key)
            return self.groups[key]
        edges = list(range(first, min(first + span * self.fan, self.windows), span))
        takes = deficit_round_robin(totals, [self.tokens(a, min(a + span, self.windows)) for a in edges], shares)
        found = np.vstack([np.zeros((1, len(totals)), np.int64), np.cumsum(takes, axis=0)]), takes
        self.groups[key] = found
        if len(self.groups) > KEPT_GROUPS:
            self.groups.popitem(last=False)
        return found

    def pieces(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(sequence, offset in it, start, length) of tokens ``start`` to ``start + length`` of a queue."""
        yield from self._pieces(queue, start, length, 0, self.span, self.totals, 0, self.shares)

    def _pieces(self, queue, start, length, first, span, totals, base, shares=None):
        """``base``: tokens of the queue before window ``first``."""
        ends, takes = self.group(first, span, totals, shares)
        column = ends[:, queue]
        at = int(np.searchsorted(column, start - base, "right")) - 1
        while length:
            here = base + int(column[at])
            part = min(length, base + int(column[at + 1]) - start)
            if part:
                if span == 1:
                    yield first + at, int(takes[at, :queue].sum()) + start - here, start, part
                else:
                    yield from self._pieces(queue, start, part, first + at * span, span // self.fan,
                                            takes[at].tolist(), here)
                start += part
                length -= part
            at += 1


def _tokens_of(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId()
        encode_all = tokenizer(vocabulary).encode_all
        end = np.array([end_id], "<u4").tobytes()
        seen: dict = {}
        for batch in small_batches(batches):
            sources = batch.column("source").to_pylist()
            counts, before, ids = [], [], []
            for source, raw in zip(sources, encode_all(batch.column("text").to_pylist())):
                raw += end
                n = len(raw) // 4
                found = np.frombuffer(raw, "<u4")
                # Two bytes an id where that is enough; the reader sees which by the length.
                ids.append(found.astype("<u2").tobytes() if found.max() < 65_536 else raw)
                counts.append(n)
                before.append(seen.get(source, 0))
                seen[source] = before[-1] + n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array([chunk] * len(ids), pa.int64()),
                 pa.array(before, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "source", "chunk", "before", "n_tokens", "ids"])
    return run


def _pieces_of(totals: list[int], sources: list, capacity: int, shares: list[int] | None, with_ids: bool):
    number = {source: i for i, source in enumerate(sources)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = Layout(totals, capacity, shares)
        for batch in small_batches(batches):
            columns: list[list] = [[] for _ in range(9)]
            for doc_id, source, at, n, raw in zip(*(batch.column(c).to_pylist()
                                                    for c in ("doc_id", "source", "at", "n_tokens", "ids"))):
                ids = np.frombuffer(raw, "<u4" if len(raw) == 4 * n else "<u2").astype("<u4").tobytes()
                for sequence, offset, start, length in layout.pieces(number[source], at, n):
                    own = ids[4 * (start - at):4 * (start - at + length)]
                    for column, value in zip(columns, (doc_id, start - at, length, zlib.crc32(own), n, sequence,
                                                       offset, source, own if with_ids else None)):
                        column.append(value)
            kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"]
            keep = 9 if with_ids else 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:keep], kinds)],
                                             names=names[:keep])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         vocabulary: str | None = None, end_id: int = 2, capacity: int = CAPACITY,
         shares: dict | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source[, ids].

    ``ids`` holds the piece's ids as little-endian uint32.  Every window holds
    the sources in proportion to ``shares`` (by source; default: to their token
    totals) as far as their queues last.  A null text has ``end_id`` as its only
    id; a null source is a source of its own; repeated rows are packed each.
    Only the three named columns are read.  An empty table gives no piece.
    The token totals of the sources (one number each) are held by every task.
    """
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                         F.col(text_col).alias("text"))
    tokens = stored(narrow.mapInArrow(
        _tokens_of(vocabulary or default_vocabulary(), end_id),
        "doc_id long, source string, chunk long, before long, n_tokens long, ids binary"), "packing_ids")
    per_chunk = tokens.groupBy("source", "chunk").agg(F.sum("n_tokens").alias("chunk_tokens"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = stored(per_chunk.withColumn("chunk_start", F.coalesce(F.sum("chunk_tokens").over(earlier), F.lit(0)))
                    .select(F.col("source").alias("chunk_source"), F.col("chunk").alias("chunk_number"),
                            "chunk_start", "chunk_tokens"), "packing_chunks")
    totals = {r["chunk_source"]: int(r["n"]) for r in
              chunks.groupBy("chunk_source").agg(F.sum("chunk_tokens").alias("n")).collect()}
    sources = sorted(totals, key=lambda s: (s is None, s or ""))
    wanted = None if shares is None else [max(0, int(shares.get(s, 0))) for s in sources]
    placed = (tokens.join(chunks, F.col("source").eqNullSafe(F.col("chunk_source"))
                          & (F.col("chunk") == F.col("chunk_number")))
              .select("doc_id", "source", (F.col("before") + F.col("chunk_start")).alias("at"), "n_tokens", "ids"))
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
              "source string" + (", ids binary" if with_ids else ""))
    return placed.mapInArrow(_pieces_of([totals[s] for s in sources], sources, capacity, wanted, with_ids), schema)
