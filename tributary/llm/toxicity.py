"""Operator 4: toxicity by a weighted lexicon.

Texts are folded first: case, compatibility forms, homoglyphs of Latin letters,
digits and signs that stand for letters; l and i, which share their
substitutes, become one letter.  Lexicon entries are whole words or word
beginnings with weights; one Aho-Corasick automaton finds them all in a pass over
the folded words.  An entry inside an exception phrase does not count, and of
several entries at one word the heaviest does.  The score is a logistic function
of the heaviest entry and of the summed weights normalised by length.

Entries, weights, exceptions and the logistic are learned from labelled
documents: a bounded sample of them, part for the entries, part for the scale.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import free_name, ship_package

# Letters of other alphabets that look like Latin ones (fixed values).
HOMOGLYPHS = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԛ": "q", "ԝ": "w", "ѵ": "v",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʀ": "r", "ѐ": "e", "ո": "n", "օ": "o", "ս": "u"})
# Digits and signs written for letters (fixed values).
SUBSTITUTES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
                             "@": "a", "$": "s", "!": "i", "|": "i"})
_FOREIGN = re.compile("[­ıɐ-ʯͰ-֏ᴀ-᷿​-‍⁠℀-⅏ﬀ-ﬆ"
                      "﻿＀-￯\U0001d400-\U0001d7ff]")
_HIDDEN = re.compile("[­​-‍⁠﻿]")
_MIXED = re.compile(r"[^\W\d_][0-9@$!|]+[^\W\d_]|[0-9@$][^\W\d_]{2}|[^\W\d_]{2}[0-9@$]")
_MIXED_WORD = re.compile(r"[0-9@$]*[^\W\d_](?:[^\W_]|[@$]|[!|](?=[^\W\d_]))*")
_WORD = re.compile(r"[^\W\d_]+")

#: Labelled documents that entries and scale are learned from, at most; drawn by hash of the id.
SAMPLE = 12_000
#: Entries that the lexicon holds at most, heaviest evidence first.
ENTRIES = 20_000
#: Toxic documents that an entry occurs in at least; and the share of the sample the scale is fitted on.
LEAST = 4
SCALE_SHARE = 3
THRESHOLD = 0.3


# ------------------------------------------------------------------ folding and matching

def fold(text: str) -> str:
    """The text with case, homoglyphs and substitutes of letters folded."""
    text = text.lower()
    if not text.isascii() and _FOREIGN.search(text):
        text = unicodedata.normalize("NFKC", _HIDDEN.sub("", text)).lower().translate(HOMOGLYPHS)
    if _MIXED.search(text):
        text = _MIXED_WORD.sub(lambda m: m[0].translate(SUBSTITUTES), text)
    return text.replace("l", "i")


def folded_words(text: str | None) -> list[str]:
    return _WORD.findall(fold(text)) if text else []


@dataclass(frozen=True)
class Lexicon:
    """Entries begin with a blank; one that ends with a blank is a whole word, else a word beginning."""
    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = ()
    #: Logistic weights: constant, heaviest entry, summed weights per root of the length, per length.
    scale: tuple[float, float, float, float] = (-4.0, 1.0, 0.0, 0.0)

    def matcher(self) -> Callable[[list[str]], dict[int, float]]:
        """From words to the weight of each word (by place) that counts."""
        import ahocorasick
        automaton = ahocorasick.Automaton()
        for entry, weight in self.entries:
            automaton.add_word(entry, (len(entry), weight, entry.endswith(" ")))
        for phrase in self.exceptions:
            automaton.add_word(phrase, (len(phrase), None, True))
        if not len(automaton):
            return lambda words: {}
        automaton.make_automaton()

        def run(words: list[str]) -> dict[int, float]:
            hits: dict[int, float] = {}
            covered: list[tuple[int, int]] = []
            for end, (length, weight, _) in automaton.iter(" " + " ".join(words) + " "):
                start = end - length + 1
                if weight is None:
                    covered.append((start, end))
                elif weight > hits.get(start, 0.0):
                    hits[start] = weight
            for start, end in covered:
                for at in [h for h in hits if start <= h < end]:
                    del hits[at]
            return hits
        return run


def features(words: list[str], hits: dict[int, float]) -> tuple[float, float, float]:
    total = sum(hits.values())
    n = len(words) + 10
    return max(hits.values(), default=0.0), total / math.sqrt(n), 10 * total / n


_scorers: dict[Lexicon, Callable] = {}


def scorer(lexicon: Lexicon) -> Callable[[str | None], float]:
    """The score of a text, from 0 to 1; the automaton is built once per process."""
    if lexicon not in _scorers:
        match = lexicon.matcher()
        constant, *weights = lexicon.scale

        def score(text: str | None) -> float:
            words = folded_words(text)
            x = constant + sum(w * f for w, f in zip(weights, features(words, match(words))))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
        _scorers[lexicon] = score
    return _scorers[lexicon]


def score_column(lexicon: Lexicon, text: Column) -> Column:
    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = scorer(lexicon)
        for texts in batches:
            yield pa.array([run(t.as_py()) for t in texts], pa.float64())  # one text at a time as a string
    return score(text)


# ------------------------------------------------------------------ learning

def terms_of(words: list[str]) -> set[str]:
    """What could become entries: the words, and beginnings of three to eight letters."""
    found = set()
    for word in set(words):
        found.add(f" {word} ")
        for n in range(3, min(len(word), 9)):
            found.add(f" {word[:n]}")
    return found


def _counts(make: Callable[[str], set[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[toxic].update(make(text))
            both = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict(
                {"term": pa.array(both, pa.string()), "pos": pa.array([counts[1][t] for t in both], pa.int64()),
                 "neg": pa.array([counts[0][t] for t in both], pa.int64())})
    return run


def count_terms(sample: DataFrame, make: Callable[[str], set[str]]) -> DataFrame:
    """(term, pos, neg): toxic and other documents of the sample that a term occurs in."""
    return (sample.mapInArrow(_counts(make), "term string, pos long, neg long")
            .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method; the first column is the constant."""
    w = np.zeros(x.shape[1])
    hold = np.full(x.shape[1], ridge * max(1, len(y)) / 100)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + hold * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(hold + 1e-9)
        move = np.linalg.solve(hessian, gradient)
        w -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    return w


def learning_rows(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic",
                  sample: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic) of at most ``sample`` labelled documents that are not held out, drawn by hash.

    Held out are ids whose crc32 (as text) leaves 2 when divided by 4.  Null ids
    and labels are left out; of repeated labels of an id the largest counts.
    """
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) > 0).cast("int").alias("toxic"))
             .dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    return known.orderBy(F.xxhash64("doc_id", F.lit("toxicity")), "doc_id").limit(sample)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    """A lexicon from the texts of at most ``sample`` labelled documents.

    Null texts are empty ones; null ids are in no sample.  Of rows that repeat
    an id one text counts, that of the smallest hash, so that ``sample`` bounds
    rows.  Terms of equal evidence are taken in alphabetical order.  Other
    columns are not read.  Without both labels, or with an empty table, the
    lexicon is empty and scores all texts alike.
    """
    ship_package(docs.sparkSession)
    chosen = learning_rows(labels, id_col, label_col, sample)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # At most ``sample`` ids and labels, 16 bytes each; only the texts of these move, one per id.
    rows = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
            .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))).withColumn(
        "scale", F.pmod(F.xxhash64("doc_id", F.lit("scale")), F.lit(10)) < SCALE_SHARE).cache()
    try:
        entries_from, scale_from = rows.filter("not scale"), rows.filter("scale")
        sizes = {r["toxic"]: r["n"] for r in entries_from.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        pos, neg = sizes.get(1, 0), sizes.get(0, 0)
        if not pos or not neg:
            return Lexicon((), (), (-4.0, 0.0, 0.0, 0.0))
        odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
        evidence = odds - 1.64 * F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
        best = (count_terms(entries_from, lambda t: terms_of(folded_words(t))).filter(F.col("pos") >= LEAST)
                .withColumn("weight", evidence).filter("weight > 0").orderBy(F.desc("weight"), "term").limit(ENTRIES))
        entries = tuple((r["term"], round(r["weight"], 6)) for r in best.collect())
        bare = Lexicon(entries)
        exceptions = _exceptions(entries_from, bare)
        lexicon = Lexicon(entries, exceptions)
        measured = scale_from.select("toxic", "text").mapInArrow(
            _features_of(lexicon), "toxic int, a double, b double, c double").collect()
        x = np.array([[1.0, r["a"], r["b"], r["c"]] for r in measured]).reshape(-1, 4)
        y = np.array([r["toxic"] for r in measured], float)
        if not 0 < y.sum() < len(y):
            return lexicon
        return Lexicon(entries, exceptions, tuple(round(float(w), 6) for w in fit_logistic(x, y)))
    finally:
        rows.unpersist()


def _features_of(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = lexicon.matcher()
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                words = folded_words(text)
                found.append(features(words, match(words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), *(pa.array([f[i] for f in found], pa.float64()) for i in range(3))],
                names=["toxic", "a", "b", "c"])
    return run


def _exceptions(sample: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Two-word phrases around an entry that occur in other documents only, five at least."""
    def phrases(text: str, kept: dict = {}) -> set[str]:  # noqa: B006  the automaton of this process
        if "match" not in kept:
            kept["match"] = lexicon.matcher()
        words = folded_words(text)
        hits = kept["match"](words)
        if not hits:
            return set()
        found, at = set(), 0
        for i, word in enumerate(words):
            if at in hits:
                if i:
                    found.add(f" {words[i - 1]} {word} ")
                if i + 1 < len(words):
                    found.add(f" {word} {words[i + 1]} ")
            at += len(word) + 1
        return found

    rows = count_terms(sample, phrases).filter("pos = 0 and neg >= 5").orderBy(F.desc("neg"), "term").limit(ENTRIES)
    return tuple(r["term"] for r in rows.collect())


def with_score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; null and empty texts get the score of no words.

    Rows and columns stay as they are, repeated rows get the same score each.
    A column that is called ``score_col`` already stays too: the score is then
    called ``score_1`` (or the next number that is free).  An empty table stays
    empty.
    """
    ship_package(docs.sparkSession)
    return docs.withColumn(free_name(score_col, docs.columns), score_column(lexicon, F.col(text_col)))


def without_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, columns as they were.

    Null and empty texts score as no words do and stay with the default
    threshold; repeated rows stay or go together; no column is added, so no
    name clashes; an empty table stays empty.
    """
    ship_package(docs.sparkSession)
    return docs.filter(score_column(lexicon, F.col(text_col)) < threshold)
