"""Operator 6: document fingerprints by a homomorphic multiset hash [DataFrame functions only].

Every paragraph (line) of a text is hashed to a wide vector; a document's
fingerprint is the sum of its paragraphs' vectors, each lane modulo 2^32.  So the
order of paragraphs does not matter, and inserting or deleting a paragraph adds
or subtracts its vector.  A vector has two parts:

* identity: ``IDENTITY`` lanes of XXH64 hashes of the whole paragraph under
  different seeds, and one that counts paragraphs; equal in all lanes means
  equal paragraphs, whatever their order;
* likeness: how many of the paragraph's word shingles have each of the 64 bits
  of their hash set (and how many shingles there are).  The lanes, less half the
  number of shingles, are a random projection of the multiset of shingles, so the
  cosine between two documents' lanes estimates how much of it they share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK_CLASS, stored, text_or_empty

IDENTITY = 8
LIKENESS = 64
#: Words of a shingle; a shorter paragraph is one shingle.
SHINGLE = 2
MODULUS = 1 << 32
#: Documents whose neighbours are looked up together, on average.
BUCKET_ROWS = 400
#: Quantiles of the ids that are asked for at most.
COARSE = 1024


# ------------------------------------------------------------------ vectors

def _paragraph_words(paragraph: Column) -> Column:
    return F.filter(F.split(paragraph, BLANK_CLASS + "+"), lambda w: w != "")


def _shingle_hashes(paragraph: Column, k: int) -> Column:
    words = _paragraph_words(paragraph)
    return F.aggregate(  # one pass over an array of one, so that the words are cut once
        F.array(words), F.array().cast("array<bigint>"),
        lambda _, w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1))),
                        lambda i: F.xxhash64(F.slice(w, i, k)))))


def identity_lanes(paragraphs: Column) -> list[Column]:
    """Sums of the paragraphs' hashes, one lane per seed, and their number."""
    mask = F.lit(MODULUS - 1)
    lane = lambda seed: F.aggregate(
        paragraphs, F.lit(0).cast("bigint"),
        lambda total, p: (total + F.xxhash64(F.lit(seed), p).bitwiseAND(mask)).bitwiseAND(mask))
    return [lane(seed) for seed in range(IDENTITY)] + [F.size(paragraphs).cast("bigint")]


def likeness_sums(hash_col: str) -> list[Column]:
    """Sums of hash bits, two 32-bit lanes to a long: bits i and i + 32 add up in the halves of sum i."""
    pair = F.lit((1 << 32) + 1)
    return [F.sum(F.shiftrightunsigned(hash_col, i).bitwiseAND(pair)).alias(f"s{i}") for i in range(32)]


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keys`` plus ``identity`` and ``likeness`` (arrays of lanes) per row of ``texts``.

    Rows are summed up by ``keys``, which must tell them apart; if ``texts`` is
    already partitioned by some of them, nothing is shuffled.  Lanes wrap
    modulo 2^32.  An empty text is one empty paragraph without shingles.
    """
    paragraphs = F.split(F.col(text_col), "\n")
    hashed = texts.select(*keys, F.array(*identity_lanes(paragraphs)).alias("identity"),
                          F.flatten(F.transform(paragraphs, lambda p: _shingle_hashes(p, shingle))).alias("hashes"))
    # Without shingles a document still needs its row: a null hash adds nothing.
    rows = hashed.select(*keys, "identity", F.explode_outer("hashes").alias("h"))
    summed = rows.groupBy(*keys, "identity").agg(F.count("h").alias("shingles"), *likeness_sums("h"))
    low = [F.coalesce(F.col(f"s{i}"), F.lit(0)).bitwiseAND(F.lit(MODULUS - 1)) for i in range(32)]
    high = [F.shiftrightunsigned(F.coalesce(F.col(f"s{i}"), F.lit(0)), 32) for i in range(32)]
    return summed.select(*keys, "identity", F.array(*low, *high, F.col("shingles").bitwiseAND(F.lit(MODULUS - 1)))
                         .alias("likeness"))


def add(a: Column, b: Column) -> Column:
    """The vector of both multisets together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MODULUS - 1)))


def subtract(a: Column, b: Column) -> Column:
    """The vector of ``a`` after deleting what ``b`` was made of."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MODULUS - 1)))


def to_text(identity: Column, likeness: Column) -> Column:
    """All lanes as hexadecimal digits, eight a lane."""
    return F.array_join(F.transform(F.concat(identity, likeness), lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def near(a_identity: Column, a: Column, b_identity: Column, b: Column) -> Column:
    """Likeness from 0 to 1: 1 for equal fingerprints, else the cosine of the centred lanes, at least 0."""
    half = lambda lanes: F.element_at(lanes, -1) / 2.0
    centred = lambda lanes: F.transform(F.slice(lanes, 1, LIKENESS), lambda x: x - half(lanes))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda t, v: t + v)
    size = dot(centred(a), centred(a)) * dot(centred(b), centred(b))
    cosine = F.when(size > 0, dot(centred(a), centred(b)) / F.sqrt(size)).otherwise(0.0)
    return F.when((a_identity == b_identity) & (a == b), F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


# ------------------------------------------------------------------ the edit of the query

def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, place, doc_id, text, next_text, last) in ascending order of the id, the first after the last.

    Rows are dealt to buckets of about ``BUCKET_ROWS`` rows by ranges of (id, hash), so
    texts are shuffled once and neighbours found within a bucket; only the first
    text of each bucket is looked up by its id for the bucket before.  Null ids
    come first; equal ids are ordered by text hash.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    placed = narrow.withColumn("hash", F.xxhash64("text"))
    placed = placed.withColumn("bucket", _buckets(narrow.select("doc_id"), F.col("doc_id"), F.col("hash")))
    # The first row of each bucket, by (id, hash), and the bucket before it; the first of all follows the last.
    firsts = stored(placed.groupBy("bucket").agg(F.min(F.struct("doc_id", "hash")).alias("first"))
                    .withColumn("part", F.shiftright("bucket", 32)), "fingerprint_firsts")
    # The bucket before lies in the same part of the id range, or is the last one of the part before: at most
    # ``COARSE`` parts and their null part are put in order as a whole.
    in_part = Window.partitionBy("part").orderBy("bucket")
    parts = firsts.groupBy("part").agg(F.max("bucket").alias("end"))
    final = F.max("end").over(Window.partitionBy())
    parts = parts.select(F.col("part"), F.coalesce(F.lag("end").over(Window.orderBy("part")), final).alias("part_before"))
    heads = stored(firsts.withColumn("inside", F.lag("bucket").over(in_part)).join(parts, "part")
                   .withColumn("before", F.coalesce("inside", "part_before"))
                   .select("before", F.col("first.doc_id").alias("head_id"), F.col("first.hash").alias("head_hash")),
                   "fingerprint_heads")
    texts = (narrow.withColumn("hash", F.xxhash64("text"))
             .join(heads, F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash")))
             .dropDuplicates(["before"]).select(F.col("before").alias("head_bucket"), F.col("text").alias("head_text")))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "hash")
    within = (placed.withColumn("place", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
              .withColumn("last", F.col("next_text").isNull()).drop("hash"))
    ends = within.join(texts, (F.col("bucket") == F.col("head_bucket")) & F.col("last"), "left")
    return ends.select("bucket", "place", "doc_id", "text", F.coalesce("next_text", "head_text").alias("next_text"),
                       "last")


def _buckets(ids: DataFrame, value: Column, tie: Column) -> Column:
    """A number that rises with (value, tie), null values first, and is shared by about ``BUCKET_ROWS`` rows.

    At most ``COARSE`` quantiles of the ids cut their range; each part is cut evenly
    further.  An id that fills several quantiles, or the null id, is cut by its ties.
    """
    row = ids.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("known"),
                  F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    n, nulls = row["known"], row["n"] - row["known"]
    parts = min(COARSE, -(-n // BUCKET_ROWS))
    cuts = [int(c) for c in ids.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts)
            ] if parts > 1 else []
    heavy = {c: cuts.count(c) * -(-n // (parts * BUCKET_ROWS)) for c in cuts if cuts.count(c) > 1}
    edges = sorted({*cuts, *(c + 1 for c in heavy)})
    fine = -(-n // (BUCKET_ROWS * parts)) if parts else 1
    by_tie = lambda m: F.floor((tie.cast("double") / float(1 << 64) + 0.5) * m)

    def inside(at: int) -> Column:
        low, high = (edges[at - 1] if at else row["low"]), (edges[at] if at < len(edges) else row["high"] + 1)
        if low in heavy:
            return by_tie(heavy[low] + 1)
        if fine == 1 or high - low < 2:
            return F.lit(0)
        return F.least(F.lit(fine - 1), F.floor((value - low).cast("double") / float(high - low) * fine))

    def tree(a: int, b: int) -> Column:
        if a == b:
            return F.lit((a + 1) << 32) + inside(a)
        middle = (a + b) // 2
        return F.when(value < F.lit(edges[middle]), tree(a, middle)).otherwise(tree(middle + 1, b))

    null_bucket = by_tie(-(-nulls // BUCKET_ROWS) or 1)
    return F.when(value.isNull(), null_bucket).otherwise(tree(0, len(edges)) if n else F.lit(0)).cast("long")


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses, one row per row of ``docs``.

    The edited text has the last half (rounded down) of the code points
    replaced by the first as many of the next document's, or all it has.  Null
    texts are empty ones.  A table of one row is its own next.  Only the two
    named columns are read.  An empty table gives an empty result.
    """
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 2)"),
                      F.expr("left(next_text, length(text) div 2)"))
    rows = with_next(docs, id_col, text_col).withColumn("edited", edited)
    keys = ["bucket", "place"]
    variant = lambda kind, text: F.struct(F.lit(kind).alias("kind"), F.col(text).alias("body"))
    variants = F.when(F.col("last"), F.array(variant(0, "text"), variant(1, "edited"), variant(2, "next_text"))
                      ).otherwise(F.array(variant(0, "text"), variant(1, "edited")))
    # The facts are worked out before the variants are cut apart, so that none of them carries the others' texts.
    whole = rows.select(*keys, "doc_id", F.length("text").cast("long").alias("n_chars"),
                        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), variants.alias("variants"))
    spread = (whole.select(*keys, "doc_id", "n_chars", "edited_sha256", F.explode("variants").alias("v"))
              .select(*keys, "doc_id", "n_chars", "edited_sha256", "v.kind", "v.body"))
    prints = fingerprints(spread, [*keys, "doc_id", "n_chars", "edited_sha256", "kind"], "body")
    part = lambda kind, what: F.max(F.when(F.col("kind") == kind, F.col(what)))
    merged = prints.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("doc_id", "n_chars", "edited_sha256")],
        *[part(k, what).alias(f"{what}{k}") for k in (0, 1, 2) for what in ("identity", "likeness")])
    order = Window.partitionBy("bucket").orderBy("place")
    following = [F.coalesce(F.col(f"{what}2"), F.lead(f"{what}0").over(order)).alias(f"{what}_next")
                 for what in ("identity", "likeness")]
    return (merged.select("*", *following).select(
        "doc_id", "n_chars", "edited_sha256",
        to_text(F.col("identity0"), F.col("likeness0")).alias("fingerprint"),
        to_text(F.col("identity1"), F.col("likeness1")).alias("edited_fingerprint"),
        near(F.col("identity0"), F.col("likeness0"), F.col("identity1"), F.col("likeness1")).alias("near_edited"),
        near(F.col("identity0"), F.col("likeness0"), F.col("identity_next"), F.col("likeness_next"))
        .alias("near_next")))
