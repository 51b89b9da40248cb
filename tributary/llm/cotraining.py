"""Operator 9: quality classifier by co-training.

Two views of a document: the words of its text, and its page metadata (source,
language, size and layout counts).  Each view has a logistic classifier.  Over
some rounds each classifier labels the unlabelled documents it is most sure of
and hands them to the other one's training rows.  The views are then calibrated
on labelled documents that trained neither, combined by a logistic over their
two log-odds, and every document is scored.

Only the sample of labelled documents is bounded.  The features of every document
are taken once and stored; in each round Spark tasks score all unlabelled documents,
the surest shares of the whole corpus are handed over (cut at a histogram of the
scores), and both classifiers are fitted on all rows handed over so far, by
gradients that the tasks add up in whole numbers, so that results do not depend on
how rows are dealt to tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import free_name, ship_package, small_batches, stored
from .toxicity import fit_logistic, held_out

#: Labelled documents that the classifiers see, at most; drawn by hash of the id.
LABELLED = 6000
#: Hashed features of the text view.
TEXT_DIMENSIONS = 1 << 12
ROUNDS = 4
#: Share of the unlabelled pool that each view hands over per round and class, and how sure it has to be.
SHARE, SURE = 0.05, 0.9
#: Steps of a unit of log-odds at which shares are cut, and how many of them are told apart.
CUTS, MOST_CUTS = 64, 1024
#: Evaluations of a fit, at most, and the unit in which gradients are added up.
EVALUATIONS, UNIT = 20, float(1 << 30)
#: Labelled documents (in tenths) that only calibrate.
CALIBRATE_TENTHS = 3

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the hashed features: kinds of token, their neighbours, repeats; unit length.

    Words are seen by their shape and length, which carries over to words and
    languages that the sample lacks, and by their first letters.
    """
    tokens = _TOKEN.findall(text or "")
    named: dict[str, float] = {}

    def put(name: str, value: float = 1.0) -> None:
        named[name] = named.get(name, 0.0) + value

    last, before, seen = "", "", set()
    for token in tokens:
        first = token[0]
        kind = ("U" if len(token) > 1 and token.isupper() else "W" if first.isupper() else "w") if first.isalpha() \
            else "d" if first.isdigit() else "p" + token[:3]
        put(f"k{kind}")
        put(f"b{last}{kind}")
        low = token.lower()
        put("repeat" if low in seen else "new")
        if low == before:
            put("stutter")
        if first.isalpha():
            put(f"f{low[:3]}", 0.3)
            put(f"l{min(len(token), 20)}", 0.5)
        seen.add(low)
        last, before = kind[0], low
    if not named:
        return np.zeros(0, np.int64), np.zeros(0)
    counts: dict[int, float] = {}
    for name, value in named.items():
        at = zlib.crc32(name.encode()) % TEXT_DIMENSIONS
        counts[at] = counts.get(at, 0.0) + value
    places = np.fromiter(counts.keys(), np.int64, len(counts))
    values = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)))
    return places, values / np.linalg.norm(values)


#: Metadata of a document: layout counts first, then one-hot source and language, hashed.
LAYOUT, HASHED = 10, 54


def metadata_features(text: str | None, source: str | None, lang: str | None) -> np.ndarray:
    """Layout counts of the page, its source and its language."""
    text = text or ""
    out = np.zeros(LAYOUT + HASHED)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n, w, m = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    signs = sum(map(text.count, "#*$%&|<>"))
    out[:LAYOUT] = [np.log1p(len(text)) / 10, np.log1p(len(words)) / 10, np.log1p(len(lines)) / 5,
                    min(1.0, len(text) / w / 20), min(2.0, 10 * signs / n), 1 - len(set(lines)) / m,
                    1 - len(set(words)) / w, sum(map(text.count, "!?")) / w, min(1.0, w / m / 100),
                    sum(map(text.count, ".,;:")) / w]
    for name in (f"s{source}", f"g{lang}"):
        out[LAYOUT + zlib.crc32(name.encode()) % HASHED] += 0.3
    return out


@dataclass(frozen=True)
class Model:
    text: tuple[float, ...]  # constant first
    metadata: tuple[float, ...]
    combine: tuple[float, float, float]  # constant, log-odds of the text view, of the metadata view
    #: Unlabelled documents that the text and the metadata view had handed over, by round.
    taught: tuple[tuple[int, int], ...] = ()

    def odds(self, text: str | None, source: str | None, lang: str | None) -> tuple[float, float]:
        w, m = _arrays(self)
        places, values = text_features(text)
        meta = metadata_features(text, source, lang)
        return float(w[0] + values @ w[1:][places]), float(m[0] + meta @ m[1:])

    def score(self, text: str | None, source: str | None, lang: str | None) -> float:
        a, b = self.odds(text, source, lang)
        x = self.combine[0] + self.combine[1] * _clip(a) + self.combine[2] * _clip(b)
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


_kept: dict[int, tuple] = {}


def _arrays(model: Model) -> tuple[np.ndarray, np.ndarray]:
    if id(model) not in _kept or _kept[id(model)][0] is not model:
        _kept.clear()
        _kept[id(model)] = model, np.array(model.text), np.array(model.metadata)
    return _kept[id(model)][1:]


def _clip(x: float) -> float:
    return max(-8.0, min(8.0, x))


# ------------------------------------------------------------------ the corpus as stored features

FEATURES = "doc_id long, label int, calibrate int, places binary, vals binary, meta binary"
#: Values are stored in whole steps of this size.
STEP = 1 / 65535


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 256):
        rows = batch.to_pydict()
        out: dict[str, list] = {"doc_id": rows["doc_id"], "places": [], "vals": [], "meta": []}
        for text, source, lang in zip(rows["text"], rows["source"], rows["lang"]):
            places, values = text_features(text)
            out["places"].append(places.astype(np.uint16).tobytes())
            out["vals"].append(np.rint(values / STEP).astype(np.uint16).tobytes())
            out["meta"].append(metadata_features(text, source, lang).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), *(pa.array(out[k], pa.binary()) for k in (
            "places", "vals", "meta"))], names=list(out))


def featured(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
             labelled: int = LABELLED) -> DataFrame:
    """Stored features of every row of ``docs``; label is 0 or 1 in the sample, -1 without label, -2 for all others.

    Held out are ids whose crc32 (as text) leaves 2 when divided by 4; their
    labels are not read.  Null ids are neither labelled nor unlabelled.  Null
    texts, sources and languages are kinds of their own, an empty text has no
    tokens.  Repeated rows get features each; of repeated labels of an id the
    largest counts.  Other columns are not read.  An empty table gives none.
    """
    ship_package(docs.sparkSession)
    draw = F.xxhash64("doc_id", F.lit("cotraining"))
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) > 0).cast("int").alias("label"))
             .dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label")))
    chosen = known.orderBy(draw, "doc_id").limit(labelled)
    marked = (labels.select(F.col(id_col).cast("long").alias("doc_id")).dropna().distinct()
              .join(F.broadcast(chosen), "doc_id", "left").withColumn("label", F.coalesce("label", F.lit(-2))))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text", "source", "lang").mapInArrow(
        _features_of, "doc_id long, places binary, vals binary, meta binary")
    label = F.when(F.col("doc_id").isNull(), -2).otherwise(F.coalesce("label", F.lit(-1)))
    part = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(10)) < CALIBRATE_TENTHS
    return stored(rows.join(marked, "doc_id", "left").select(
        "doc_id", label.alias("label"), (part & (label >= 0)).cast("int").alias("calibrate"), "places", "vals", "meta"),
        "cotraining_features", compression="zstd")


@dataclass
class _Rows:
    """Features of a batch: those of the text in one run, where each row's begin, and the dense ones of the page."""
    places: np.ndarray
    values: np.ndarray
    row: np.ndarray
    meta: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> _Rows:
        places = [np.frombuffer(x, np.uint16) for x in batch.column("places").to_pylist()]
        values = np.frombuffer(b"".join(batch.column("vals").to_pylist()), np.uint16) * STEP
        meta = np.frombuffer(b"".join(batch.column("meta").to_pylist()), np.float32)
        row = np.repeat(np.arange(len(places)), [len(x) for x in places])
        return _Rows(np.concatenate([np.zeros(0, np.uint16), *places]).astype(np.int64), values, row,
                     meta.reshape(-1, LAYOUT + HASHED).astype(np.float64))

    def odds(self, view: int, w: np.ndarray) -> np.ndarray:
        if view:
            return w[0] + (self.meta * w[1:]).sum(axis=1)
        return w[0] + np.bincount(self.row, self.values * w[1:][self.places], len(self.meta))

    def total(self, view: int, weight: np.ndarray) -> np.ndarray:
        """Sum of the rows times ``weight``, constant first, in whole units."""
        first = [np.rint(weight * UNIT).sum()]
        if view:
            return np.concatenate([first, np.rint(self.meta * (weight * UNIT)[:, None]).sum(axis=0)])
        return np.concatenate([first, np.bincount(self.places, np.rint(self.values * (weight * UNIT)[self.row]),
                                                  TEXT_DIMENSIONS)])


#: Partial sums that one task of the tree adds up, and that the driver gets at most.
FAN_IN = 64


def _summed(rows: DataFrame, of_batch, width: int) -> np.ndarray:
    """Sum over all rows of ``of_batch`` (a batch to ``width`` whole numbers, so the order does not matter).

    One vector per task, added up by a tree of tasks: the driver gets at most
    ``FAN_IN`` vectors however many tasks there are.
    """
    def added(vectors: Iterator[np.ndarray]) -> pa.RecordBatch:
        total = np.zeros(width)
        for v in vectors:
            total += v
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield added(of_batch(b) for b in small_batches(batches, 2048))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield added(np.frombuffer(x.as_py()) for b in batches for x in b.column("total"))

    sums, n = rows.mapInArrow(task, "total binary"), rows.rdd.getNumPartitions()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        sums = sums.repartition(n).mapInArrow(join, "total binary")
    total = np.zeros(width)
    for r in sums.collect():
        total += np.frombuffer(r["total"])
    return total


# ------------------------------------------------------------------ rounds

WIDTHS = (TEXT_DIMENSIONS + 1, LAYOUT + HASHED + 1)


def _losses(batch: pa.RecordBatch, weights: list) -> np.ndarray:
    """Per view and class: rows, loss and gradient."""
    rows, out = _Rows.of(batch), []
    for v in (0, 1):
        given = batch.column(f"given{v}").to_numpy()
        odds = np.clip(rows.odds(v, weights[v]), -30, 30)
        for value in (0, 1):
            mine = given == value
            loss = np.where(mine, np.log1p(np.exp(-odds if value else odds)), 0.0)
            out += [[mine.sum(), np.rint(loss * UNIT).sum()],
                    rows.total(v, np.where(mine, 1 / (1 + np.exp(-odds)) - value, 0.0))]
    return np.concatenate(out)


def _descent(w: np.ndarray, most: int = EVALUATIONS, memory: int = 8):
    """L-BFGS as a generator: yields points, is sent (loss, gradient) there, returns the best point."""
    loss, g = yield w
    pairs: list = []
    done, size = 1, 1.0
    while done < most and np.abs(g).max() > 1e-5:
        d, steps = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ d) / (s @ y)
            steps.append(a)
            d -= a * y
        d *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 4.0
        for (s, y), a in zip(pairs, reversed(steps)):
            d += s * (a - (y @ d) / (s @ y))
        size = 1.0
        while done < most:
            after = w - size * d
            after_loss, after_g = yield after
            done += 1
            if after_loss <= loss - 1e-4 * size * (g @ d):
                if (after - w) @ (after_g - g) > 1e-12:
                    pairs = [*pairs, (after - w, after_g - g)][-memory:]
                w, loss, g = after, after_loss, after_g
                break
            size /= 4
    return w


def _fit(rows: DataFrame, weights: list[np.ndarray], ridge: float = 1e-4) -> list[np.ndarray] | None:
    """Both classifiers on all rows with given0 and given1 (-1: not given); None if a class has no rows."""
    descents = [_descent(w) for w in weights]
    at: list = [next(d) for d in descents]
    found: list = [None, None]
    while any(f is None for f in found):
        points = list(at)
        sums, begin = _summed(rows, lambda batch: _losses(batch, points), 2 * sum(WIDTHS) + 8), 0
        for v in (0, 1):
            loss, g = ridge / 2 * (at[v] @ at[v]), ridge * at[v]
            for _ in (0, 1):
                n, part = sums[begin], sums[begin + 1:begin + 2 + WIDTHS[v]] / UNIT
                begin += 2 + WIDTHS[v]
                if not n:
                    return None
                loss, g = loss + 0.5 / n * part[0], g + 0.5 / n * part[1:]  # classes weigh the same
            if found[v] is None:
                try:
                    at[v] = descents[v].send((loss, g))
                except StopIteration as end:
                    found[v] = at[v] = end.value
    return found


@dataclass(frozen=True)
class _Round:
    """Weights of both views, and per view the log-odds down and up to which documents are handed over."""
    weights: tuple
    cuts: tuple = ((-np.inf, np.inf), (-np.inf, np.inf))


def _given(rows: _Rows, before: list[_Round]) -> list[np.ndarray]:
    """What view 0 and view 1 have been given of the unlabelled ``rows``; view v is taught by the other."""
    given = [np.full(len(rows.meta), -1), np.full(len(rows.meta), -1)]
    for r in before:
        for v in (0, 1):
            odds, (low, high) = rows.odds(v, r.weights[v]), r.cuts[v]
            chosen = np.where(odds >= high, 1, np.where(odds <= low, 0, -1))
            given[1 - v] = np.where(given[1 - v] < 0, chosen, given[1 - v])
    return given


LIMIT = float(np.log(SURE / (1 - SURE)))


def _sure_counts(batch: pa.RecordBatch, before: list[_Round], now: list) -> np.ndarray:
    """Per view: open documents, then those sure to be bad and to be good by how sure they are."""
    rows, out = _Rows.of(batch), []
    given = _given(rows, before)
    for v in (0, 1):
        odds = rows.odds(v, now[v])[given[1 - v] < 0]
        out.append([len(odds)])
        for sign in (-1, 1):
            sure = (sign * odds)[sign * odds >= LIMIT]
            out.append(np.bincount(np.minimum(MOST_CUTS - 1, ((sure - LIMIT) * CUTS).astype(int)), minlength=MOST_CUTS))
    return np.concatenate(out).astype(float)


def _cuts(counts: np.ndarray) -> tuple[tuple[float, float], tuple[int, int]]:
    """Log-odds from which the surest share is handed over, for bad and good, and how many these are."""
    many = max(1, int(SHARE * counts[0]))
    at, taken = [], []
    for side in counts[1:].reshape(2, MOST_CUTS):
        tail = np.cumsum(side[::-1])[::-1]
        k = max([0, *np.flatnonzero(tail >= many)])  # the cut that reaches the share, or all that are sure
        at.append(LIMIT + k / CUTS)
        taken.append(int(tail[k]))
    return (-at[0], at[1]), tuple(taken)


def _handed_over(batches: Iterator[pa.RecordBatch], before: list[_Round], now: _Round) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 2048):
        rows = _Rows.of(batch)
        old, new = _given(rows, before), _given(rows, [*before, now])
        fresh = [np.where(o < 0, n, -1).astype(np.int32) for o, n in zip(old, new)]
        some = pa.array((fresh[0] >= 0) | (fresh[1] >= 0))
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(f).filter(some) for f in fresh), *(batch.column(c).filter(some) for c in ("places", "vals", "meta"))],
            names=["given0", "given1", "places", "vals", "meta"])


TAUGHT = "given0 int, given1 int, places binary, vals binary, meta binary"


def _one_per_id(sample: DataFrame) -> DataFrame:
    """One row of each labelled id, so that the sample's bound holds for rows: that of the smallest hash."""
    row = ["label", "calibrate", "places", "vals", "meta"]
    return (sample.groupBy("doc_id").agg(F.min_by(F.struct(*row), F.xxhash64("places", "vals", "meta")).alias("r"))
            .select("doc_id", *[f"r.{c}" for c in row]))


def learn_from(features: DataFrame) -> Model:
    """A model from stored features: the labelled sample, and all unlabelled documents as the pool.

    Repeated rows of a labelled id count once, unlabelled ones each.  Without
    rows of both labels, or in an empty table, both views are silent and every
    score is a half.
    """
    silent = Model(*((0.0,) * n for n in WIDTHS), (0.0, 0.0, 0.0))
    few = lambda df: df.repartition(max(2, features.rdd.getNumPartitions() // 8))
    pool = features.filter("label = -1").select("places", "vals", "meta")
    sample = stored(_one_per_id(features.filter("label >= 0")), "cotraining_sample")
    train = stored(few(sample.filter("calibrate = 0").select(
        F.col("label").alias("given0"), F.col("label").alias("given1"), "places", "vals", "meta")), "cotraining_rows")
    weights = _fit(train, [np.zeros(n) for n in WIDTHS])
    if weights is None:
        return silent
    before: list[_Round] = []
    taught = []
    for _ in range(ROUNDS):
        counts = _summed(pool, lambda b: _sure_counts(b, before, weights), 2 + 4 * MOST_CUTS).reshape(2, -1)
        cuts, taken = zip(*(_cuts(c) for c in counts))
        taught.append(tuple(map(sum, taken)))
        if not sum(taught[-1]):
            break
        now = _Round(tuple(weights), cuts)
        train = train.unionByName(stored(few(pool.mapInArrow(
            lambda batches: _handed_over(batches, before, now), TAUGHT)), "cotraining_rows"))
        before = [*before, now]
        weights = _fit(train, weights)
    w, m = (np.round(x, 6) for x in weights)
    kept = sample.filter("calibrate = 1").select("label", "places", "vals", "meta").toArrow()
    combine, parts = (0.0, 0.5, 0.5), [(_Rows.of(b), b.column("label").to_numpy()) for b in kept.to_batches() if len(b)]
    if parts:
        x = np.concatenate([np.stack([np.ones(len(y)), np.clip(r.odds(0, w), -8, 8), np.clip(r.odds(1, m), -8, 8)], axis=1)
                            for r, y in parts])
        y = np.concatenate([y for _, y in parts]).astype(float)
        if 0 < y.sum() < len(y):
            combine = tuple(round(float(c), 6) for c in fit_logistic(x, y))
    return Model(tuple(w.tolist()), tuple(m.tolist()), combine, tuple(taught))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          labelled: int = LABELLED) -> Model:
    """A model from labelled documents that are not held out and all documents without labels.

    Null ids and labels are left out.  With one label only, both views are
    silent and every score is a half.
    """
    return learn_from(featured(docs, labels, id_col, label_col, labelled))


def scored(features: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of stored features, repeated rows and null ids included."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, m = _arrays(model)
        for batch in small_batches(batches, 2048):
            rows = _Rows.of(batch)
            x = (model.combine[0] + model.combine[1] * np.clip(rows.odds(0, w), -8, 8)
                 + model.combine[2] * np.clip(rows.odds(1, m), -8, 8))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))))],
                                             names=["doc_id", "score"])
    return features.select("doc_id", "places", "vals", "meta").mapInArrow(score, "doc_id long, score double")


def score_column(model: Model, text: Column, source: Column, lang: Column) -> Column:
    @pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, sources, langs in batches:
            yield pd.Series([model.score(*row) for row in zip(texts, sources, langs)], dtype="float64")
    return score(text, source, lang)


def with_quality(docs: DataFrame, model: Model, score_col: str = "quality_score") -> DataFrame:
    """``docs`` with the chance that each row is of good quality; every column may be null, texts empty or long.

    Rows and columns stay as they are; a column that is called ``score_col``
    already stays too, and the chance gets the first free name with a number.
    """
    ship_package(docs.sparkSession)
    return docs.withColumn(free_name(score_col, docs.columns), score_column(model, F.col("text"), F.col("source"), F.col("lang")))
