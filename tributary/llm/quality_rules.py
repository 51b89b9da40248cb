"""Operator 2: quality rules by weak supervision [DataFrame functions only].

Each rule looks at a document's counts and votes good (1), bad (-1) or
abstains (0).  Rules are taken as independent given the hidden quality:
expectation-maximisation estimates from all documents how often each rule votes
which way on good and on bad text, and a document is kept if the posterior
probability that it is good reaches a half.  A rule that finds one kind of junk
abstains on all other text, so that its silence weighs as little as the data say.

The votes of a document are one of at most 3^rules patterns, so the corpus is
reduced to a table of pattern counts by one aggregate; every
expectation-maximisation step is an aggregate over that table, of which one row of
rates comes back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CLASS, WORD_CLASS, stored, text_or_empty

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Fewest words, and most percent of repeated words, of the base check (fixed values).
LEAST_WORDS = 20
MOST_REPEATED = 30


# ------------------------------------------------------------------ counts

def with_repeated_words(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """``df`` (with an array ``words``) plus n_repeat_words: words in a window of words found twice or more.

    Windows are compared by their 64-bit hashes.  Only if some hash occurs
    twice are the (hash, place) pairs sorted; equal neighbours are the repeated
    windows, and the words they cover are the gaps between their places, each
    at most a window long.
    """
    n = F.size("words")
    hashes = F.when(n > window, F.transform(F.sequence(F.lit(1), n - (window - 1)),
                                            lambda i: F.xxhash64(F.slice("words", i, window))))
    some = F.size(F.array_distinct("w_hashes")) < F.size("w_hashes")
    pairs = F.when(some, F.array_sort(F.transform("w_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    at = lambda k: F.get("w_pairs", k)["h"]
    places = F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("w_pairs") - 1),
                 lambda k: F.coalesce(at(k) == at(k + 1), F.lit(False)) | F.coalesce(at(k) == at(k - 1), F.lit(False))),
        lambda k: F.get("w_pairs", k)["i"]))
    covered = F.aggregate(
        "w_places", F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return (df.withColumn("w_hashes", hashes).withColumn("w_pairs", pairs)
            .withColumn("w_places", F.when(F.col("w_pairs").isNotNull(), places))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("w_hashes", "w_pairs", "w_places"))


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts that the rules look at, one row per row of ``docs``.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines
    with a word that equal an earlier line), n_repeat_words, n_chars, n_lines
    (lines with a word), n_letters, n_upper (capitals), n_marks (! and ?),
    n_stutters (words that equal the word before), n_bare (words without letter or digit),
    n_distinct (different words).
    A null text counts as an empty one.
    """
    text = F.col("text")
    words = F.filter(F.split(text, BLANK_CLASS + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CLASS))
    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return (with_repeated_words(narrow.withColumn("words", words).withColumn("lines", lines))
            .select("doc_id",
                    F.size("words").cast("long").alias("n_words"),
                    F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                    (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                    (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                    "n_repeat_words",
                    F.length(text).cast("long").alias("n_chars"),
                    F.size("lines").cast("long").alias("n_lines"),
                    (F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))).cast("long").alias("n_letters"),
                    (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
                    F.size(F.filter("words", lambda w, i: F.coalesce(w == F.get("words", i - 1), F.lit(False))))
                    .cast("long").alias("n_stutters"),
                    (F.size("words") - F.size(F.filter("words", lambda w: w.rlike(r"[\p{L}\p{N}]"))))
                    .cast("long").alias("n_bare"),
                    F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
                    (F.length(text) - F.length(F.translate(text, "!?", ""))).cast("long").alias("n_marks")))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


# ------------------------------------------------------------------ rules

@dataclass(frozen=True)
class Rule:
    """Bad if ``bad`` holds, else good if ``good`` holds, else no vote."""
    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        return (F.when(self.bad, F.lit(-1)).when(self.good, F.lit(1)).otherwise(F.lit(0))).cast("int")


def default_rules() -> list[Rule]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    letters = F.greatest(F.col("n_letters"), F.lit(1))
    length = F.col("word_chars") / words
    never = F.lit(False)
    return [
        Rule("symbols", F.col("n_symbols") > 0.1 * words, never),
        Rule("letters", F.col("n_letters") < 0.75 * chars, F.col("n_letters") >= 0.85 * chars),
        Rule("bare", F.col("n_bare") > 0.2 * words, never),
        Rule("repeats", F.col("n_repeat_words") > 0.3 * words, never),
        Rule("lines", (F.col("n_lines") >= 4) & (F.col("n_dup_lines") > 0.5 * F.col("n_lines")), never),
        Rule("stutter", F.col("n_stutters") > 0.2 * words, never),
        # Different words grow with the root of the length: the share asked for falls from 256 words on.
        Rule("vocabulary", F.col("n_distinct") < F.least(0.25 * words, 4 * F.sqrt(words)), never),
        Rule("words", (length < 2) | (length > 15), (length >= 3) & (length <= 9)),
        Rule("capitals", (F.col("n_upper") > 0.5 * letters) & (F.col("n_words") >= LEAST_WORDS), never),
        Rule("marks", F.col("n_marks") > 0.2 * words, never),
        Rule("size", never, F.col("n_words") >= 50),
    ]


# ------------------------------------------------------------------ expectation-maximisation

@dataclass(frozen=True)
class Model:
    """Share of good documents, and per rule the chances of a good and a bad vote given either quality."""
    prior: float
    rates: dict[str, tuple[float, float, float, float]]  # P(+|good), P(-|good), P(+|bad), P(-|bad)

    def log_odds(self) -> Column:
        """log P(good | votes) - log P(bad | votes) of a row with one column of votes per rule."""
        odds = F.lit(math.log(self.prior) - math.log(1 - self.prior))
        for name, (up_good, down_good, up_bad, down_bad) in self.rates.items():
            vote = F.col(name)
            odds = odds + F.when(vote > 0, F.lit(math.log(up_good) - math.log(up_bad))).when(
                vote < 0, F.lit(math.log(down_good) - math.log(down_bad))).otherwise(
                F.lit(math.log(1 - up_good - down_good) - math.log(1 - up_bad - down_bad)))
        return odds

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def start_model(names: list[str]) -> Model:
    """A bad vote is taken to be rare on good text, a good vote weak evidence; that also fixes which side is good."""
    return Model(0.7, {n: (0.6, 0.01, 0.3, 0.3) for n in names})


def step(patterns: DataFrame, names: list[str], model: Model, start: Model, hold: float = 0.01) -> Model:
    """One expectation-maximisation step over (votes..., n).

    The starting rates count as observations of ``hold`` times the corpus (and
    one document) on either side, so a rule that hardly ever speaks keeps its meaning.
    """
    weighted = patterns.withColumn("g", F.col("n") * model.posterior()).withColumn("b", F.col("n") - F.col("g"))
    sums = [F.sum("g").alias("g"), F.sum("b").alias("b")]
    for name in names:
        for side in ("g", "b"):
            sums.append(F.sum(F.when(F.col(name) > 0, F.col(side)).otherwise(0.0)).alias(f"{name}_{side}_up"))
            sums.append(F.sum(F.when(F.col(name) < 0, F.col(side)).otherwise(0.0)).alias(f"{name}_{side}_down"))
    row = weighted.agg(*sums).first()
    g, b = row["g"] or 0.0, row["b"] or 0.0
    held = 1 + hold * (g + b)

    def rates(name: str) -> tuple:
        ways = (("g", "up", g), ("g", "down", g), ("b", "up", b), ("b", "down", b))
        return tuple(((row[f"{name}_{side}_{way}"] or 0.0) + held * first) / (whole + held)
                     for (side, way, whole), first in zip(ways, start.rates[name]))

    return Model((g + held * start.prior) / (g + b + held), {n: rates(n) for n in names})


def fit(votes: DataFrame, names: list[str], most_steps: int = 30, tolerance: float = 1e-4) -> Model:
    """Estimate the model from all rows of ``votes`` (one column per rule)."""
    patterns = stored(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "rules_patterns")
    model = start = start_model(names)
    for _ in range(most_steps):
        after = step(patterns, names, model, start)
        moved = max([abs(after.prior - model.prior)] + [
            abs(x - y) for n in names for x, y in zip(after.rates[n], model.rates[n])])
        model = after
        if moved < tolerance:
            break
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Counts, votes, base_failed, quality (posterior) and kept per row of ``docs``.

    kept: the base check holds and quality is at least a half.  Null and empty
    texts fail the base check.  Repeated rows are judged each; ids are not
    looked at and may be null.  Only the two named columns are read.  An empty
    table gives an empty result.
    """
    rules = rules or default_rules()
    names = [f"vote_{r.name}" for r in rules]
    counted = stored(counts(docs, id_col, text_col), "rules_counts")
    voted = counted.withColumns({n: r.vote() for n, r in zip(names, rules)})
    model = fit(voted, names)
    return (voted.withColumn("base_failed", base_failed()).withColumn("quality", model.posterior())
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)))
