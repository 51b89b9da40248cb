"""Operator 1: near-duplicates by SimHash fingerprints.

Fingerprint: 64 bits; a bit is set if it is set in over half of the XXH64
hashes (seed 42) of the text's word shingles, repeats included.  Two
fingerprints are linked if they differ in at most ``max_bits`` bits.

Links are found by pigeonhole: the 64 bits are cut into ``blocks`` blocks; a
pair with at most k differing bits agrees on at least ``blocks - k`` of them,
so it meets under the key made of those blocks.  More blocks give more keys
per fingerprint, each longer; the number of blocks follows the number of
different fingerprints so that a key is shared by a few of them by chance.
Every choice finds every link.

Equal fingerprints are one node, so a group of copies costs one row.  Within
a key, members are compared in tasks and only a spanning forest of the links
leaves the task; a key with very many members is dealt out as pairs of
bounded chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, stored
from .components import connected_components

#: Members of one key that one task compares at a time; larger keys are dealt
#: out as pairs of chunks of this size.
CHUNK = 20_000
#: Members up to which all linked pairs of a key are put out as they are.
FEW = 24


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; 0 if it has no word."""
    words = (text or b"").lower().split()  # bytes.lower() changes A-Z only, split() cuts at the six blanks
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1:].tolist())),
                         np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def _fingerprints_of(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            found = [fingerprint(None if not x.is_valid else x.as_buffer().to_pybytes(), shingle)
                     for x in text]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"),
                 pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["doc_id", "text_hash", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp) per row of ``docs``; fp is a signed long."""
    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("text_hash"))
    return narrow.mapInArrow(_fingerprints_of(shingle), "doc_id long, text_hash long, fp long")


def block_widths(blocks: int) -> list[int]:
    return [64 // blocks + (i < 64 % blocks) for i in range(blocks)]


def blocks_for(distinct: int, max_bits: int, load: int = 4) -> int:
    """Fewest blocks whose keys are shared by about ``load`` fingerprints at most by chance."""
    for blocks in range(max_bits + 1, 17):
        if distinct <= load << sum(sorted(block_widths(blocks))[:blocks - max_bits]):
            return blocks
    return max(16, max_bits + 1)


def key_masks(blocks: int, max_bits: int) -> list[int]:
    """Signed masks, one per choice of ``blocks - max_bits`` blocks."""
    ends = np.cumsum(block_widths(blocks)).tolist()
    block = [((1 << end) - 1) ^ ((1 << (end - width)) - 1) for end, width in zip(ends, block_widths(blocks))]
    masks = [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``values`` (uint64, all different)."""
    left, right = [], []
    rest = values.copy()
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), at))
                right.append(found)
                todo.extend(found)
                rest = rest[~near]
    empty = np.empty(0, np.uint64)
    return (np.concatenate(left) if left else empty, np.concatenate(right) if right else empty)


def _links_of(max_bits: int):
    """Rows come sorted by key; the links of each run of equal keys go out."""

    def links(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else np.empty(0, int)
        sizes = np.diff(np.r_[starts, len(keys)])
        a, b = [], []
        small = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
        run = np.repeat(np.arange(len(starts)), sizes)
        fps_few, run_few = fps[small], run[small]
        for lag in range(1, FEW):
            if len(run_few) <= lag:
                break
            pair = run_few[lag:] == run_few[:-lag]
            if not pair.any():
                break
            x, y = fps_few[lag:][pair], fps_few[:-lag][pair]
            near = np.bitwise_count(x ^ y) <= max_bits
            a.append(x[near])
            b.append(y[near])
        for i in np.flatnonzero(sizes > FEW):
            x, y = _forest(np.unique(fps[starts[i]:starts[i] + sizes[i]]), max_bits)
            a.append(x)
            b.append(y)
        empty = np.empty(0, np.uint64)
        return np.concatenate([empty, *a]), np.concatenate([empty, *b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty((0, 4), np.int64), np.empty(0, np.uint64)

        def out(n: int) -> pa.RecordBatch:
            a, b = links(keys[:n], fps[:n])
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                              names=["a", "b"])

        for batch in batches:
            new = np.stack([batch.column(c).to_numpy() for c in ("j", "key", "c1", "c2")], axis=1).astype(np.int64)
            keys = np.concatenate([keys, new])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
            changed = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
            if len(changed):
                n = int(changed[-1]) + 1  # the last key may go on in the next batch
                yield out(n)
                keys, fps = keys[n:], fps[n:]
        if len(fps):
            yield out(len(fps))
    return run


def links(nodes: DataFrame, max_bits: int = 4, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links that join all fingerprints ``nodes.fp`` (distinct) as all pairs within ``max_bits`` would."""
    ship_package(nodes.sparkSession)
    masks = key_masks(blocks_for(nodes.count(), max_bits), max_bits)
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                         .alias("j", "key"))
    hot = (keyed.groupBy("j", "key").count().filter(F.col("count") > chunk)
           .select("j", "key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")))
    hot = stored(hot, "simhash_hot")
    if hot.isEmpty():
        dealt = keyed.select("j", "key", F.lit(0).alias("c1"), F.lit(0).alias("c2"), "fp")
    else:
        # A key with C chunks becomes C (C + 1) / 2 pairs of chunks; a row joins the C pairs of its own chunk.
        own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        dealt = (keyed.join(hot, ["j", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
                 .withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                 .select("j", "key", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "fp"))
    return (dealt.repartition("j", "key", "c1", "c2").sortWithinPartitions("j", "key", "c1", "c2", "fp")
            .mapInArrow(_links_of(max_bits), "a long, b long"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per row of ``docs``.

    component_id is the smallest id among the rows reachable over links; root,
    the component's smallest fingerprint, tells components apart without ids.
    Only ``id_col`` and ``text_col`` are read; other columns never clash.
    Null and wordless texts have fingerprint 0 and are linked like any other.
    A null id never becomes a component_id unless all ids of the component
    are null; repeated rows come out as often as they went in.  An empty table
    gives an empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "simhash_nodes")
    if max_bits:
        roots = connected_components(links(nodes, max_bits))
        rooted = (nodes.join(roots, nodes.fp == roots.node, "left")
                  .select("fp", "lowest", F.coalesce("root", "fp").alias("root")))
    else:
        rooted = nodes.select("fp", "lowest", F.col("fp").alias("root"))
    rooted = stored(rooted, "simhash_roots")
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: its smallest id (null ids last), then the smallest text hash.

    All columns come out as they went in.  Texts are not shuffled: the rows to
    keep are looked up by id and text hash; only rows that are repeated as
    they stand are brought together to keep one of them.
    """
    found = stored(simhash_components(docs, id_col, text_col, shingle, max_bits), "simhash_found")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    chosen = (found.groupBy("root").agg(F.min(order).alias("first"))
              .select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")))
    copies = (found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_copies"))
              .select(F.col("doc_id").alias("_id2"), F.col("text_hash").alias("_hash2"), "_copies"))
    keep = stored(chosen.join(copies, F.col("_id").eqNullSafe(F.col("_id2"))
                              & (F.col("_hash") == F.col("_hash2"))).select("_id", "_hash", "_copies"),
                  "simhash_keep")

    def taken(rows: DataFrame) -> DataFrame:
        return docs.join(rows, docs[id_col].cast("long").eqNullSafe(rows["_id"])
                         & (F.xxhash64(docs[text_col]) == rows["_hash"]), "left_semi")

    once = taken(keep.filter("_copies = 1"))
    many = keep.filter("_copies > 1")
    if many.isEmpty():
        return once
    return once.unionByName(taken(many).dropDuplicates([id_col, text_col]))
