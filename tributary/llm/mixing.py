"""Operator 8: mixing sources to target weights.

Efraimidis-Spirakis sampling: a document with quality weight w and a uniform
number u gets the exponential key -ln(u) / w; taking a source's documents in
ascending order of their keys draws them without replacement in proportion
to their weights.  A source whose target is e times its size and a rest gives
e complete epochs and, by prefix sums over the key order, documents up to the
rest.

A source may hold most of the rows, so no source is ever sorted as a whole:
the keys are cut into slices per source, slice sizes are added up, whole slices
fall inside or outside the budget, and only the one slice in which the budget
ends is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_or_empty, word_count

#: Weights of the sources by code point, repeating; null last (fixed values).
WEIGHTS = (5, 2, 1)
#: A source is seen at most so many times.
MOST_EPOCHS = 3
#: Slices of a source's keys; the slice that is sorted holds about this fraction of the source.
SLICES = 4096
#: Classes of quality weights, each a power of ten to this fraction wide, that tell how a source's keys are spread.
WEIGHT_CLASSES = 32


def uniform(id_col: Column, text: Column) -> Column:
    """A number in (0, 1) that depends on the id and the text alone: 52 bits of an MD5."""
    named = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), text)
    bits = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def text_quality(text: Column) -> Column:
    """Quality weight in [0.1, 1]: the share of characters that are not markup symbols."""
    n = F.length(text)
    symbols = n - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.when(n == 0, F.lit(0.1)).otherwise(F.greatest(F.lit(0.1), 1 - symbols.cast("double") / n))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The sources share the sum of all sizes by weight; a target stops at
    ``most`` times its source's size and the excess is shared anew among the
    others.  Sources in ascending order of most * size / weight stop first, so
    one pass finds the level at which none is above: a source stops if its
    limit per weight is at most what would be left per weight for it and all
    after it.  The table has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % n + 1)
    limit = (F.col("source_size") * most).cast("double")
    ordered = Window.orderBy("limit_per_weight", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
             ).cast("double") / F.sum("weight").over(onward)
    sized = (sizes.withColumn("weight", weight).withColumn("limit_per_weight", limit / F.col("weight"))
             .withColumn("level", level).withColumn("stops", F.col("limit_per_weight") <= F.col("level")))
    left = F.min(F.when(~F.col("stops"), F.struct("limit_per_weight", F.col("source").isNull(), "source", "level"))
                 ).over(everything)["level"]
    return (sized.withColumn("open_level", left)
            .select("source", "source_size",
                    F.when(F.col("stops"), limit).otherwise(F.col("open_level") * F.col("weight")).alias("target")))


def sliced_keys(rows: DataFrame, slices: int = SLICES) -> DataFrame:
    """``rows`` (source, weight, key) with the slice of each key; slices of a source rise with the key and are alike in rows.

    Of documents with weight w the share exp(-w * key) has larger keys, so the
    weights of a source say what share of it lies before a key, whatever the
    weights are; they are counted by class.  Every step is monotone in the key.
    """
    at = F.least(F.lit(WEIGHT_CLASSES - 1), F.floor(F.log10(F.col("weight") * 10) * WEIGHT_CLASSES))
    spread = rows.groupBy("source").agg(*[F.count_if(at == b).alias(f"c{b}") for b in range(WEIGHT_CLASSES)])
    total = sum((F.col(f"c{b}") for b in range(WEIGHT_CLASSES)), F.lit(0))
    shares = spread.select(F.col("source").alias("spread_source"), F.array(
        *[F.col(f"c{b}") / total for b in range(WEIGHT_CLASSES)]).alias("shares"))
    middles = F.array(*[F.lit(0.1 * 10 ** ((b + 0.5) / WEIGHT_CLASSES)) for b in range(WEIGHT_CLASSES)])
    beyond = F.aggregate(F.zip_with("shares", middles, lambda p, w: p * F.exp(-w * F.col("key"))), F.lit(0.0), lambda t, x: t + x)
    place = F.greatest(F.lit(0), F.least(F.lit(slices - 1), F.floor((1 - beyond) * slices)))
    return (rows.join(shares, F.col("source").eqNullSafe(F.col("spread_source")))
            .withColumn("slice", place).drop("spread_source", "shares", "weight"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, slices: int = SLICES) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, epochs) per row of ``docs``.

    ``epochs`` is how often the mix takes the row: the complete epochs of its
    source, plus one if its key comes before the end of the source's remaining
    budget (the document in which the budget ends is taken if at least half of
    it fits).  Rows are ordered by key and id; rows equal in id and text are
    interchangeable.  A null text has size 0; a null source
    is a source of its own, last in order; a null id counts as an empty one.
    Only the three named columns are read, so no other column clashes.  An
    empty table gives an empty result; sources without a word take nothing.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"), word_count(F.col(text_col)).alias("size"),
                       text_quality(text).alias("weight"),
                       (-F.ln(uniform(F.col(id_col), text)) / text_quality(text)).alias("key"))
    rows = stored(rows, "mix")  # six narrow columns; texts are read once
    # Each step reads the files of the one before: plans stay short, and nothing is worked out twice.
    sliced = stored(sliced_keys(rows, slices), "mix_sliced")
    per_slice = stored(sliced.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")), "mix_slices")
    sizes = per_slice.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    goals = (targets(sizes, weights, most)
             .withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                         .otherwise(F.lit(0)))
             .withColumn("budget", F.col("target") - F.col("full") * F.col("source_size"))
             .withColumnRenamed("source", "goal_source"))
    # The slice in which each source's budget ends, and what comes before it: one row per source.
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = (per_slice.withColumn("before", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
            .join(goals, F.col("source").eqNullSafe(F.col("goal_source")))
            .groupBy("goal_source", "source_size", "target", "full", "budget")
            .agg(F.min(F.when(F.col("before") + F.col("slice_size") > F.col("budget"),
                              F.struct("slice", "before"))).alias("end")))
    ends = stored(ends, "mix_ends")
    placed = (sliced.join(ends, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
              .withColumn("at", F.when(F.col("end").isNull() | (F.col("slice") < F.col("end.slice")), F.lit(-1))
                          .when(F.col("slice") > F.col("end.slice"), F.lit(1)).otherwise(F.lit(0))))
    whole = placed.filter("at <> 0").withColumn("extra", F.when(F.col("at") < 0, F.lit(1)).otherwise(F.lit(0)))
    in_slice = (Window.partitionBy("source", "slice").orderBy("key", "doc_id")
                .rowsBetween(Window.unboundedPreceding, -1))
    split = (placed.filter("at = 0")
             .withColumn("start", F.col("end.before") + F.coalesce(F.sum("size").over(in_slice), F.lit(0)))
             .withColumn("extra", (F.col("start") + F.col("size") / 2.0 <= F.col("budget")).cast("int"))
             .drop("start"))
    return (whole.unionByName(split)
            .select("doc_id", "source", "text_hash", "size", "source_size", "target",
                    (F.col("full") + F.col("extra")).alias("epochs")))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns as they were.

    Rows that are taken differently though equal in id, source and text (the
    budget ended between them) are told apart by their number alone.
    """
    taken = mix(docs, id_col, source_col, text_col, **options)
    # One row per (id, source, text hash): how many rows there are and how often all of them are taken together.
    totals = (taken.groupBy("doc_id", "source", "text_hash")
              .agg(F.count(F.lit(1)).alias("__mix_rows"), F.sum("epochs").alias("__mix_taken"))
              .select(F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"),
                      F.col("text_hash").alias("__mix_hash"), "__mix_rows", "__mix_taken"))
    totals = stored(totals, "mix_totals")
    joined = docs.join(totals, docs[id_col].eqNullSafe(totals["__mix_id"]) & docs[source_col].eqNullSafe(totals["__mix_source"])
                       & (F.xxhash64(docs[text_col]) == totals["__mix_hash"]))
    single = joined.filter("__mix_rows = 1").withColumn("__mix_times", F.col("__mix_taken"))
    order = Window.partitionBy("__mix_id", "__mix_source", "__mix_hash").orderBy(F.lit(0))
    repeated = (joined.filter("__mix_rows > 1").withColumn("__mix_n", F.row_number().over(order))
                .withColumn("__mix_times", F.floor(F.col("__mix_taken") / F.col("__mix_rows"))
                            + (F.col("__mix_n") <= F.col("__mix_taken") % F.col("__mix_rows")).cast("long")).drop("__mix_n"))
    return (single.unionByName(repeated).filter("__mix_times > 0")
            .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_times").cast("int"))))
            .select(*docs.columns))
