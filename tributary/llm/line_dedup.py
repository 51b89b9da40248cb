"""Operator 7: line dedup by log templates [DataFrame functions only].

Lines are parsed as log messages are.  Tokens that hold a digit or an @ are
variable from the start (``<*>``); a line of nothing but such tokens is taken as
it stands.  A tree of fixed depth leads a line to its leaf by its number of tokens
and its leading tokens.  Within a leaf the distinct lines are compared position by
position: two that agree in three quarters of their positions (in half of them
from 16 tokens on) make a template, in which the positions that differ are variable.

A template recurs if lines of two documents fall under it, be they equal (lines of
any length) or not (lines of ``LEAST_VARIED`` tokens and more, as fewer cannot
differ).  Its lines stay in the document with the smallest id and are dropped from
all others.  So a line goes if a document with a smaller id holds an equal line,
or one that agrees with it in that share of the positions.  Empty lines stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CLASS, free_name, stored, text_or_empty

#: Leading tokens that the tree branches on.
LEADING = 3
#: Documents without an id count as one, after all others.
NO_ID = (1 << 63) - 1
#: Tokens from which one position, and from which half of the positions may vary.
LEAST_VARIED, HALF_VARIES = 4, 16
#: Tokens, and least and most lines, of a block; larger leaves are dealt out as pairs of blocks.
BLOCK_TOKENS, BLOCK_LEAST, BLOCK_MOST = 100_000, 32, 1000
#: Bits that tell most leaves of a single form from those to compare.
LEAF_BITS = 1 << 24


def masked_tokens(line: Column) -> Column:
    tokens = F.filter(F.split(line, BLANK_CLASS + "+"), lambda t: t != "")
    return F.when(line.rlike("[0-9@]"), F.transform(
        tokens, lambda t: F.when(t.rlike("[0-9@]"), F.lit("<*>")).otherwise(t))).otherwise(tokens)


def line_tokens(line: Column) -> Column:
    tokens = F.filter(F.split(line, BLANK_CLASS + "+"), lambda t: t != "")
    fixed = F.exists(tokens, lambda t: ~t.rlike("[0-9@]"))
    return F.when(line.rlike("[0-9@]") & fixed, masked_tokens(line)).otherwise(tokens)


def agreeing(n: Column) -> Column:
    """Positions of ``n`` in which two lines of a template agree, at least."""
    return n - F.when(n >= HALF_VARIES, F.floor(n / 2)).otherwise(F.floor(n / 4))


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_hash, line, hash, leaf, form) of every line with a token; no leaf and form for lines that cannot vary."""
    # The hash is taken before the lines are cut apart, so that none of them carries its whole text along.
    whole_texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                              F.xxhash64(F.col(text_col)).alias("text_hash"),
                              F.split(text_or_empty(text_col), "\n").alias("bodies"))
    exploded = (whole_texts.select("doc", "text_hash", F.posexplode("bodies").alias("line", "body"))
                .withColumn("t", line_tokens(F.col("body"))).withColumn("n", F.size("t")).filter("n > 0"))
    varied = lambda c: F.when(F.col("n") >= LEAST_VARIED, c)
    return exploded.select("doc", "text_hash", "line", F.xxhash64("t").alias("hash"),
                           varied(F.xxhash64("n", F.slice("t", 1, LEADING))).alias("leaf"),
                           varied(F.array_join("t", " ")).alias("form"))


def later_forms(parsed: DataFrame, forms: DataFrame, block_tokens: int = BLOCK_TOKENS,
                block_least: int = BLOCK_LEAST) -> DataFrame:
    """(hash) of the forms that agree with another form of which a smaller document has a line.

    Only leaves with several forms and documents are compared.  A leaf of more
    than one block of lines is dealt out as pairs of blocks, so that any two of its
    forms meet in some task.  The forms of a block stand by their first document,
    and a form is compared until one agrees.
    """
    leaves = (forms.filter("leaf is not null").groupBy("leaf")
              .agg(F.count(F.lit(1)).alias("forms"), F.min("first").alias("low"), F.max("high").alias("high"))
              .filter("forms > 1 and low <> high").select("leaf", "forms"))
    leaves = stored(leaves, "line_leaves")
    # A table of bits, bounded whatever the leaves, spares most other lines the way to the exact join.
    place = F.pmod(F.col("leaf"), F.lit(LEAF_BITS))
    bit = F.pmod(place, F.lit(64)).cast("int")
    words = leaves.groupBy(F.floor(place / 64).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    maybe = (parsed.filter("leaf is not null").withColumn("word", F.floor(place / 64))
             .join(F.broadcast(words), "word").filter(F.getbit("bits", bit) == 1).select("leaf", "hash", "doc", "form"))
    several = (maybe.join(leaves, "leaf").groupBy("leaf", "hash", "forms")
               .agg(F.min("doc").alias("first"), F.first("form").alias("form"))
               .withColumn("t", F.transform(F.split("form", " "), lambda w: F.xxhash64(w))).drop("form")
               .withColumn("n", F.size("t")))
    in_block = F.greatest(F.lit(block_least), F.least(F.lit(BLOCK_MOST), F.floor(F.lit(block_tokens) / F.col("n"))))
    dealt = (several.withColumn("blocks", F.ceil(F.col("forms") / in_block).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("hash", F.lit("block")), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .groupBy("leaf", "n", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
             .agg(F.array_sort(F.collect_list(F.struct("first", "hash", "block", "t"))).alias("members")))

    def agree(x: Column, y: Column) -> Column:
        same = F.filter(x["t"], lambda w, i: w == F.get(y["t"], i))
        return ((y["first"] < x["first"]) & ((F.col("a") == F.col("b")) | (x["block"] != y["block"]))
                & (F.size(same) >= agreeing(F.col("n"))))

    later = F.filter("members", lambda x: F.exists("members", lambda y: agree(x, y)))
    return dealt.select(F.explode(F.transform(later, lambda x: x["hash"])).alias("hash")).distinct()


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_hash, dropped): places of the lines to drop, per document that loses any.

    Counting combines in the map tasks; a line in very many documents is one row per task.
    """
    parsed = stored(lines(docs, id_col, text_col), "line_forms", compression="zstd")
    forms = stored(parsed.groupBy("hash", "leaf").agg(F.min("doc").alias("first"), F.max("doc").alias("high")),
                   "line_distinct")
    later = later_forms(parsed, forms).withColumn("later", F.lit(True))
    recurring = (forms.join(later, "hash", "left").filter("later or first <> high")
                 .select("hash", "first", F.coalesce("later", F.lit(False)).alias("later")))
    return (parsed.select("doc", "text_hash", "line", "hash").join(recurring, "hash").filter("later or doc > first")
            .groupBy("doc", "text_hash").agg(F.collect_set("line").alias("dropped")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: bool = False) -> DataFrame:
    """``docs`` without the lines of templates that recur in an earlier document.

    All rows and columns stay; a document may be left with an empty text.  With
    ``marks`` the columns n_lines and n_dropped are added, under the first free
    name with a number if ``docs`` has such a column.  Rows equal in id and
    text are one document, so are rows of one id as to what counts as several
    documents; rows without an id count as one document after all others.  Null
    and empty texts have one empty line and stay as they are.  An empty table
    gives an empty result.
    """
    return without_lines(docs, dropped_lines(docs, id_col, text_col), id_col, text_col, marks)


def without_lines(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str, marks: bool) -> DataFrame:
    """``docs`` without the places of ``dropped`` (doc, text_hash, dropped)."""
    found = dropped.select(
        F.col("doc").alias("__line_doc"), F.col("text_hash").alias("__line_hash"), F.col("dropped").alias("__dropped"))
    joined = docs.join(found, (F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)) == found["__line_doc"])
                       & (F.xxhash64(docs[text_col]) == found["__line_hash"]), "left")
    parts = F.split(F.col(text_col), "\n")
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__dropped")),
                                    lambda i: F.get(F.col("__parts"), i)), "\n")
    out = (joined.withColumn("__parts", F.when(F.col("__dropped").isNotNull(), parts))
           .withColumn("__n", F.size(F.split(text_or_empty(text_col), "\n")).cast("long"))
           .withColumn(text_col, F.when(F.col("__dropped").isNotNull(), kept).otherwise(F.col(text_col))))
    names = [free_name(n, docs.columns) for n in ("n_lines", "n_dropped")]
    extra = [F.col("__n").alias(names[0]),
             F.when(F.col("__dropped").isNull(), 0).otherwise(F.size("__dropped")).cast("long").alias(names[1])]
    return out.select(*docs.columns, *(extra if marks else []))
