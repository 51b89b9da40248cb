"""Operator 9: held-out accuracy, what co-training adds, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import cotraining as C

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, C.learn(docs, labels)


def test_held_out_accuracy(learned):
    docs, labels, model = learned
    rows = (C.with_quality(docs.join(labels, "doc_id").filter(C.held_out(F.col("doc_id"))), model)
            .select("quality", "quality_score").collect())
    good = [r.quality_score for r in rows if r.quality]
    bad = [r.quality_score for r in rows if not r.quality]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert sum(g >= 0.5 for g in good) / len(good) > 0.95 and sum(b < 0.5 for b in bad) / len(bad) > 0.8


class Plain:
    """The rounds on dense arrays, by the definition: sort by sureness, hand over, fit on everything given."""

    def __init__(self, rows):
        self.x = [np.zeros((len(rows), n - 1)) for n in C.WIDTHS]
        for i, r in enumerate(rows):
            np.add.at(self.x[0][i], np.frombuffer(r.places, np.uint16).astype(int), np.frombuffer(r.vals, np.uint16) * C.STEP)
            self.x[1][i] = np.frombuffer(r.meta, np.float32)
        self.label = np.array([r.label for r in rows])
        self.calibrate = np.array([r.calibrate for r in rows]) == 1

    def odds(self, v, w):
        return w[0] + self.x[v] @ w[1:]

    def fit(self, v, w, given):
        def at(w):
            loss, g = 5e-5 * w @ w, 1e-4 * w
            for value in (0, 1):
                mine = given == value
                z = np.clip(self.odds(v, w)[mine], -30, 30)
                off = 1 / (1 + np.exp(-z)) - value
                loss += 0.5 / mine.sum() * np.log1p(np.exp(-z if value else z)).sum()
                g = g + 0.5 / mine.sum() * np.concatenate([[off.sum()], self.x[v][mine].T @ off])
            return loss, g
        descent = C._descent(w)
        point = next(descent)
        while True:
            try:
                point = descent.send(at(point))
            except StopIteration as end:
                return end.value

    def run(self):
        pool, train = self.label == -1, (self.label >= 0) & ~self.calibrate
        given = [np.where(train, self.label, -1) for _ in (0, 1)]
        w = [self.fit(v, np.zeros(C.WIDTHS[v]), given[v]) for v in (0, 1)]
        taught = []
        for _ in range(C.ROUNDS):
            handed, counts = [g.copy() for g in given], []
            for v in (0, 1):
                open_ = np.flatnonzero(pool & (given[1 - v] < 0))
                odds, many = self.odds(v, w[v])[open_], max(1, int(C.SHARE * len(open_)))
                n = 0
                for value, sure in ((0, -odds), (1, odds)):
                    # The share is cut at a step of the scale: all that are as sure as the last one's step go along.
                    step = np.minimum(C.MOST_CUTS - 1, np.floor((sure - C.LIMIT) * C.CUTS))
                    ranked = sorted(step[sure >= C.LIMIT])[::-1]
                    if ranked:
                        chosen = (sure >= C.LIMIT) & (step >= ranked[min(many, len(ranked)) - 1])
                        handed[1 - v][open_[chosen]] = value
                        n += int(chosen.sum())
                counts.append(n)
            taught.append(tuple(counts))
            if not sum(counts):
                break
            given = handed
            w = [self.fit(v, w[v], given[v]) for v in (0, 1)]
        return w, taught, given


def test_rounds_against_plain_arrays(spark):
    """Hand-over sets and weights of the path that the query runs, on a small table with repeated ids."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    few = labels.filter("doc_id % 3 = 0")
    features = C.featured(docs, few)
    rows = features.collect()
    plain = Plain(rows)
    w, taught, given = plain.run()
    model = C.learn_from(features)
    assert model.taught == tuple(taught) and sum(map(sum, taught)) > 20
    for mine, want in zip((model.text, model.metadata), w):
        assert np.abs(np.array(mine) - want).max() < 2e-3
    # What was handed over is right for the documents whose label was kept back.
    truth = {r.doc_id: r.quality for r in labels.filter("doc_id % 3 <> 0").collect()}
    for g in given:
        handed = [(int(v), truth[r.doc_id]) for r, v, lab in zip(rows, g, plain.label) if lab == -1 and v >= 0 and r.doc_id in truth]
        assert handed and sum(a == b for a, b in handed) / len(handed) > 0.9


def test_sums_reach_the_driver_as_few_vectors(spark):
    rows = spark.range(2000).selectExpr("cast(id as int) as given0").repartition(200)
    seen = []
    collect = type(rows).collect

    def counted(self):
        got = collect(self)
        seen.append(len(got))
        return got
    type(rows).collect = counted
    try:
        total = C._summed(rows, lambda b: np.array([b.num_rows, sum(b.column("given0").to_pylist())], float), 2)
    finally:
        type(rows).collect = collect
    assert total.tolist() == [2000, 1999000] and seen == [4]


def test_labelled_rows_are_bounded(spark):
    """One labelled id that thousands of rows repeat is one row of the sample."""
    docs = spark.createDataFrame([(1, "good words of text") for _ in range(300)] + [(2, "### $$$")] + [(9, "more")],
                                 "doc_id long, text string").selectExpr("*", "'s' as source", "'en' as lang")
    features = C.featured(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    sample = C._one_per_id(features.filter("label >= 0"))
    assert features.count() == 302 and sorted(r.doc_id for r in sample.collect()) == [1, 2]


def test_a_column_of_the_scores_name_stays(spark, learned):
    docs = spark.createDataFrame([(1, "some text", "s", "en", 7.0)], "doc_id long, text string, source string, lang string, quality_score double")
    got = C.with_quality(docs, learned[2])
    assert got.columns == [*docs.columns, "quality_score_1"] and got.first().quality_score == 7.0


def test_held_out_labels_are_not_read(learned):
    docs, labels, model = learned
    flipped = labels.withColumn("quality", F.when(C.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    assert C.learn(docs, flipped) == model


def test_odd_rows(spark, learned):
    docs = spark.createDataFrame(
        [(1, None, None, None, 1), (2, "", "src1", "en", 2), (None, "w " * 60_000, None, "xx", 3),
         (3, "### $$$ %%%", "src1", None, 4), (3, "### $$$ %%%", "src1", None, 4)],
        "doc_id long, text string, source string, lang string, label int")
    got = C.with_quality(docs, learned[2])
    assert got.columns == [*docs.columns, "quality_score"]
    assert all(0 <= r.quality_score <= 1 and math.isfinite(r.quality_score) for r in got.collect())
    silent = C.learn(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.quality_score for r in C.with_quality(docs, silent).collect()} == {0.5}
    assert C.with_quality(docs.limit(0), silent).count() == 0


def test_all_unlabelled_documents_take_part(spark):
    """9,000 unlabelled documents of two plain kinds: a pool of 2,000 could hand over 2 x 5 % of 2,000 a round, no more."""
    docs = spark.range(9400).selectExpr(
        "id as doc_id", "if(id % 2 = 0, concat('Some good words of text, number ', id), '### $$$ %%% ### $$$') as text",
        "if(id % 2 = 0, 'page', 'junk') as source", "'en' as lang")
    model = C.learn(docs, docs.filter("doc_id < 400").selectExpr("doc_id", "1 - doc_id % 2 as quality"))
    assert all(n > 900 for r in model.taught[:1] for n in r) and sum(n for n, _ in model.taught) > 2000
    features = C.featured(docs, docs.filter("doc_id < 400").selectExpr("doc_id", "1 - doc_id % 2 as quality"))
    assert features.filter("label = -1").count() == 9000
    got = {r.doc_id: r.score for r in C.scored(features, model).collect()}
    assert len(got) == 9400 and all((s > 0.5) == (i % 2 == 0) for i, s in got.items())
    assert C.learn_from(features.repartition(7)) == model


def test_stored_features_score_as_texts_do(spark, learned):
    docs, labels, model = learned
    want = {r.doc_id: r.quality_score for r in C.with_quality(docs, model).collect()}
    got = {r.doc_id: r.score for r in C.scored(C.featured(docs, labels), model).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 0.01 for i in want)
