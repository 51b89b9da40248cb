"""Operator 13: phrases of words that stand together, counted in quotient filters.

Texts are read once: every task turns chunks of whole texts (shards) into ids
of a vocabulary of the shard's own.  Words frequent enough in the corpus get
ids of their own per language; the shards' ids are replaced by them.  Shards
count their pairs of frequent words in counting quotient filters of the packed
ids, cut at the same upper bits everywhere; tasks merge the filters of one
segment across shards.  Shards learn which of their pairs are frequent and
count only those longer phrases all of whose pairs are: no other phrase can be
frequent, so nothing is lost.  Counts are exact; what is left is a table of
frequent phrases, which is scored by joins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import quotient_filter as Q
from .common import ship_package, stored

#: Characters at which a text is cut into pieces; words are cut at space and tab.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANGUAGE = "und"
#: A shard is closed when its texts have so many UTF-8 bytes; a text is never cut.
SHARD_BYTES = 8 << 20
#: Words of the corpus per segment of the filters; the number of segments grows with the corpus.
SEGMENT_WORDS = 1 << 20
#: Words a phrase has at most: four ids of up to 32 bits are one key.
LONGEST = 4

_BREAK = b"\xff"  # not a byte of any UTF-8 text
_TABLE = bytes(0xFF if b in PIECE_ENDS else 0x20 if b == 9 else b for b in range(256))


class _Ids(dict):
    """Word -> id, in order of appearance; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def words_and_breaks(text: str | None) -> list[bytes]:
    """Words as UTF-8 with A-Z lowered, and a mark after each piece."""
    raw = (text or "").encode().lower().translate(_TABLE)
    return [*raw.replace(_BREAK, b" " + _BREAK + b" ").split(), _BREAK]


_SHARDS = "shard long, lang string, ids binary, words array<string>, counts array<long>"


def _shard_maker(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId() << 32
        held: dict[str, tuple[_Ids, list]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, shard
            for lang, (ids, parts) in held.items():
                found = np.concatenate(parts)
                counts = np.bincount(found, minlength=len(ids))[1:]
                words = [w.decode() for w in ids if w != _BREAK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard]), pa.array([lang]), pa.array([found.astype("<u4").tobytes()], pa.binary()),
                     pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64()))],
                    names=["shard", "lang", "ids", "words", "counts"])
            held, size, shard = {}, 0, shard + 1

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                words = words_and_breaks(text.as_py())
                if lang not in held:
                    held[lang] = (_Ids({_BREAK: 0}), [])
                ids, parts = held[lang]
                parts.append(np.fromiter(map(ids.__getitem__, words), np.uint32, len(words)))
                size += sum(map(len, words)) + len(words)
                if size >= shard_bytes:
                    yield from flush()
        yield from flush()
    return run


def _coder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the shard's ids by the corpus's; 0 for ends of pieces and words that are not frequent."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = np.frombuffer(batch.column("ids")[i].as_py(), "<u4")
            pairs = batch.column("known")[i].values
            to = np.zeros(int(ids.max()) + 1, np.uint32)
            to[pairs.field("at").to_numpy(zero_copy_only=False)] = pairs.field("gid").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard").slice(i, 1), batch.column("lang").slice(i, 1),
                 pa.array([to[ids].astype("<u4").tobytes()], pa.binary())], names=["shard", "lang", "ids"])


_FILTERS = "lang string, n int, segment long, shard long, filter binary"


def _filters_of(lang: str, n: int, shard: int, high: np.ndarray, low: np.ndarray, half: int,
                bits: int) -> pa.RecordBatch | None:
    cut = Q.segments(Q.counted(high, low, half), half, bits)
    if not cut:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(cut)), pa.array([n] * len(cut), pa.int32()), pa.array([s for s, _ in cut], pa.int64()),
         pa.array([shard] * len(cut), pa.int64()), pa.array([Q.pack(e, half, bits) for _, e in cut], pa.binary())],
        names=["lang", "n", "segment", "shard", "filter"])


def _pair_counter(id_bits: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), "<u4").astype(np.uint64)
                both = (ids[:-1] > 0) & (ids[1:] > 0)
                made = _filters_of(batch.column("lang")[i].as_py(), 2, batch.column("shard")[i].as_py(),
                                   ids[:-1][both], ids[1:][both], id_bits, bits)
                if made is not None:
                    yield made
    return run


def _phrase_counter(id_bits: int, bits: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.uint64(id_bits)
        for batch in batches:
            for i in range(batch.num_rows):
                lang, shard = batch.column("lang")[i].as_py(), batch.column("shard")[i].as_py()
                ids = np.frombuffer(batch.column("ids")[i].as_py(), "<u4").astype(np.uint64)
                known = np.frombuffer(b"".join(batch.column("pairs")[i].as_py()), "<u8")
                pair = (ids[:-1] << wide) | ids[1:]
                known = np.sort(known)
                place = np.minimum(np.searchsorted(known, pair), len(known) - 1)
                frequent = known[place] == pair
                follows = frequent
                for n in range(3, longest + 1):
                    follows = follows[:-1] & frequent[n - 2:]
                    at = np.flatnonzero(follows)
                    low = ids[at + 2] if n == 3 else pair[at + 2]
                    made = _filters_of(lang, n, shard, pair[at], low, 2 * id_bits, bits)
                    if made is not None:
                        yield made
    return run


_MERGED = "lang string, n int, shard long, g array<long>, f long, pairs binary"


def _merger(least: int, id_bits: int):
    """Frequent keys of a segment as rows, and for pairs those of each shard that has them."""
    def run(table: pa.Table) -> pa.Table:
        lang, n, segment = (table.column(c)[0].as_py() for c in ("lang", "n", "segment"))
        parts, half = [], 0
        for data in table.column("filter"):
            entries, half = Q.unpack(data.as_py(), segment)
            parts.append(entries)
        high, low, counts = Q.merge(parts, half)
        often = counts >= least
        high, low, counts = high[often], low[often], counts[often]
        a, b = Q.unpermute(high, low, half)
        wide, mask = np.uint64(id_bits), np.uint64((1 << id_bits) - 1)
        columns = [a, b] if n == 2 else [a >> wide, a & mask, b] if n == 3 else [a >> wide, a & mask, b >> wide, b & mask]
        rows = len(a)
        g = pa.ListArray.from_arrays(np.arange(0, n * rows + 1, n, np.int32) if rows else np.zeros(1, np.int32),
                                     pa.array(np.stack(columns, 1).reshape(-1).astype(np.int64)))
        out = [pa.table([pa.array([lang] * rows, pa.string()), pa.array([n] * rows, pa.int32()), pa.nulls(rows, pa.int64()),
                         g, pa.array(counts, pa.int64()), pa.nulls(rows, pa.binary())],
                        names=["lang", "n", "shard", "g", "f", "pairs"])]
        if n == 2 and rows:
            # Places of pairs fit into one number: half a key has at most 32 bits.
            key = (high << np.uint64(half)) | low
            shards, lists = [], []
            for shard, (h, l, _) in zip(table.column("shard").to_pylist(), parts):
                mine = (h << np.uint64(half)) | l
                at = np.minimum(np.searchsorted(key, mine), rows - 1)
                at = at[key[at] == mine]
                if len(at):
                    shards.append(shard)
                    lists.append(((a[at] << wide) | b[at]).astype("<u8").tobytes())
            k = len(shards)
            out.append(pa.table([pa.array([lang] * k, pa.string()), pa.array([n] * k, pa.int32()), pa.array(shards, pa.int64()),
                                 pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.int64()), pa.array(lists, pa.binary())],
                                names=["lang", "n", "shard", "g", "f", "pairs"]))
        return pa.concat_tables([t.cast(out[0].schema) for t in out])
    return run


def _numbered(words: DataFrame) -> DataFrame:
    """Give the words of each language ids from 1 on; no language passes through one task."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = words.repartitionByRange(n, "lang", "word").sortWithinPartitions("lang", "word")
    dealt = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "words").withColumn(
        "part", F.shiftright("at", 33))
    # One row per language and partition of the numbering.
    parts = dealt.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("lang", "part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return dealt.join(parts, ["lang", "part"]).select(
        "lang", "word", "f", (F.col("before") + F.col("at") - F.col("first") + 1).alias("gid"))


def phrase_counts(docs: DataFrame, least: int = 30, longest: int = LONGEST, text_col: str = "text",
                  lang_col: str = "lang", shard_bytes: int = SHARD_BYTES,
                  segment_words: int = SEGMENT_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Exact counts of all phrases of 1 to ``longest`` words that occur ``least`` times or more per language.

    Returns (lang, n): word occurrences per language; (lang, gid, word): the
    frequent words; (lang, g, f): frequent phrases as arrays of word ids with
    their counts.  A phrase is counted at every place it starts within a piece.
    A null text is empty, a null language ``und``; only these two columns are
    read.  Repeated rows count each.  An empty table gives empty results.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                         F.col(text_col).alias("text"))
    shards = stored(narrow.mapInArrow(_shard_maker(shard_bytes), _SHARDS), "shards")
    totals = shards.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    totals = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    listed = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "shard", "lang", (F.col("pos") + 1).alias("at"), F.col("col.words").alias("word"), F.col("col.counts").alias("c"))
    often = listed.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
    words = stored(_numbered(often), "vocabulary")
    # Two numbers reach the driver.
    most, n_words = words.agg(F.max("gid")).first()[0] or 0, totals.agg(F.sum("n")).first()[0] or 0
    id_bits = max(1, int(most).bit_length())
    if id_bits > 32:
        raise ValueError("more frequent words than 32 bits can number")
    bits = min(id_bits, math.ceil(math.log2(max(1, n_words / segment_words))))

    known = (listed.join(words, ["lang", "word"]).groupBy("shard", "lang")
             .agg(F.collect_list(F.struct(F.col("at").cast("long").alias("at"), "gid")).alias("known")))
    coded = stored(shards.select("shard", "lang", "ids").join(known, ["shard", "lang"])
                   .mapInArrow(_coder, "shard long, lang string, ids binary"), "coded")
    merge = _merger(least, id_bits)
    pairs = stored(coded.mapInArrow(_pair_counter(id_bits, bits), _FILTERS)
                   .groupBy("lang", "n", "segment").applyInArrow(merge, _MERGED), "pairs")
    found = pairs.where(F.col("shard").isNull())
    if longest > 2:
        mine = (pairs.where(F.col("shard").isNotNull()).groupBy("shard", "lang")
                .agg(F.collect_list("pairs").alias("pairs")))
        longer = (coded.join(mine, ["shard", "lang"]).mapInArrow(_phrase_counter(id_bits, bits, longest), _FILTERS)
                  .groupBy("lang", "n", "segment").applyInArrow(merge, _MERGED))
        found = found.unionByName(stored(longer, "phrases"))
    singles = words.select("lang", F.array("gid").alias("g"), "f")
    return totals, words.select("lang", "gid", "word"), singles.unionByName(found.select("lang", "g", "f"))


def collocations(docs: DataFrame, least: int = 30, longest: int = LONGEST, keep: int = 2000,
                 covered_percent: int = 80, **options) -> DataFrame:
    """The ``keep`` best phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A phrase that occurs a >= ``least`` times is scored by the cut of its words
    into two parts (l and r occurrences) that scores lowest, floor(2000000 * a
    / (l + r)); ties go to the shorter first part.  Phrases whose words lie
    within a longer frequent phrase with ``covered_percent`` of their
    occurrences or more are left out.  Order: score and a descending, phrase
    ascending by UTF-8 bytes.  For odd rows see ``phrase_counts``.
    """
    totals, words, phrases = phrase_counts(docs, least, longest, **options)
    phrases = stored(phrases.where(F.col("f") >= least), "frequent")
    candidates = phrases.where(F.size("g") >= 2)
    cuts = candidates.select("lang", "g", F.col("f").alias("a"), F.explode(
        F.sequence(F.lit(1), F.size("g") - 1)).alias("k")).select(
        "*", F.slice("g", F.lit(1), F.col("k")).alias("g_l"), F.expr("slice(g, k + 1, size(g) - k)").alias("g_r"))
    lefts = phrases.select("lang", F.col("g").alias("g_l"), F.col("f").alias("l"))
    rights = phrases.select("lang", F.col("g").alias("g_r"), F.col("f").alias("r"))
    score = F.expr("cast((cast(2000000 as decimal(38,0)) * a) div (cast(l as decimal(38,0)) + r) as bigint)")
    scored = (cuts.join(lefts, ["lang", "g_l"]).join(rights, ["lang", "g_r"])
              .groupBy("lang", "g", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")))
    inner = candidates.where(F.size("g") > 2).select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, size(g) - 1), m -> transform(sequence(1, size(g) - m + 1), s -> slice(g, s, m))))"
    )).alias("g")).groupBy("lang", "g").agg(F.max("f").alias("covering"))
    left = scored.join(inner, ["lang", "g"], "left").where(F.expr(
        f"covering is null or cast(100 as decimal(38,0)) * covering < cast({int(covered_percent)} as decimal(38,0)) * a"))
    # Limits before the texts are looked up; rows that tie with the last one stay until then.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    top = (left.select("lang", "g", "a", "cut.score", "cut.l", "cut.r").withColumn("place", F.rank().over(best))
           .where(F.col("place") <= keep))
    spelled = (top.select("lang", "g", "a", "score", "l", "r", F.posexplode("g").alias("pos", "gid"))
               .join(words, ["lang", "gid"]).groupBy("lang", "g", "a", "score", "l", "r")
               .agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w"))
               .withColumn("phrase", F.expr("array_join(transform(w, x -> x.word), ' ')")))
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= keep)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              "n", "score")
