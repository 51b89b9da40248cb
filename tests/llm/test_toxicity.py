"""Operator 4: folding and matching against plain search, and held-out accuracy."""

import math

import pytest
from pyspark.sql import functions as F

from tributary.llm import toxicity as X


def test_folding():
    same = ["Loser", "lоsеr", "l0ser", "1oser", "LO5ER", "ｌｏｓｅｒ", "lo​ser", "l0$er", "|oser", "ιοser"]
    for text in same[:-2]:
        assert X.folded_words(f"a {text} b") == ["a", "ioser", "b"], text
    assert X.folded_words("1d10t!") == ["idiot"] and X.folded_words("DE!! UNE!!") == ["de", "une"]
    assert X.folded_words("in 2024, 17% of 3 cost $5") == ["in", "of", "cost"]
    assert X.folded_words("été niño") == ["été", "niño"]
    assert X.folded_words(None) == [] == X.folded_words(" \n")


def test_matching_and_exceptions():
    lexicon = X.Lexicon(((" trash ", 3.0), (" tra", 1.0), (" idi", 2.0)), (" trash can ",))
    match = lexicon.matcher()

    def plain(words):
        out, at = {}, 0
        for i, w in enumerate(words):
            weights = [x for e, x in lexicon.entries if (w == e.strip() if e.endswith(" ") else w.startswith(e[1:]))]
            if weights and not (w == "trash" and words[i + 1:i + 2] == ["can"]):
                out[at] = max(weights)
            at += len(w) + 1
        return out

    for words in (["trash"], ["trash", "can"], ["a", "trash", "trash", "can", "tray"], ["idiot", "trashy"], [], ["can"]):
        assert match(words) == plain(words)
    assert X.features(["trash"] * 90, match(["trash"] * 90))[2] > X.features(
        ["x"] * 89 + ["trash"], match(["x"] * 89 + ["trash"]))[2]


@pytest.fixture(scope="module")
def learned(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, X.learn(docs, labels)


def test_held_out_accuracy(learned):
    docs, labels, lexicon = learned
    rows = (X.with_score(docs.join(labels, "doc_id").filter(X.held_out(F.col("doc_id"))), lexicon)
            .select("toxic", "score").collect())
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) > 0.93
    assert sum(p >= X.THRESHOLD for p in pos) / len(pos) > 0.9
    assert sum(n >= X.THRESHOLD for n in neg) / len(neg) < 0.03


def test_learning_ignores_held_out_rows_and_is_stable(spark, learned):
    docs, labels, lexicon = learned
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.learn(docs, flipped) == lexicon
    assert X.learning_rows(labels, sample=50).count() == 50


def test_odd_rows(spark, learned):
    lexicon = learned[2]
    rows = [(1, None), (2, ""), (None, "you idiot"), (3, "w " * 60_000), (3, "w " * 60_000), (4, "уоu іdіоt, 1d10t")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score int, toxic string")
    got = X.with_score(docs, lexicon, score_col="s")
    assert got.columns == [*docs.columns, "s"]
    by = {r.doc_id: r.s for r in got.collect()}
    assert all(0 <= s <= 1 and math.isfinite(s) for s in by.values())
    assert by[1] == by[2] < X.THRESHOLD and by[None] >= X.THRESHOLD and by[4] >= X.THRESHOLD
    kept = X.without_toxic(docs, lexicon)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 3]
    empty = X.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.s for r in X.with_score(docs, empty, score_col="s").collect()} == {1 / (1 + math.exp(4.0))}
    assert X.without_toxic(docs.limit(0), lexicon).count() == 0


def test_query_against_plain_search(spark, tmp_path):
    """The registered query on whole tables: every score by looking up each word and each of its beginnings."""
    from tributary.llm.queries import LLM_QUERIES
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(None, None), (-1, ""), (-2, "!!! 123"), (-3, None)], "doc_id long, text string")
    for name, df in (("documents", docs.select("doc_id", "text").unionByName(odd)), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    lexicon = X.learn(docs, labels)
    entries, exceptions = dict(lexicon.entries), {tuple(e.split()) for e in lexicon.exceptions}

    def plain(text):
        words = X.folded_words(text)
        spared = {j for i in range(len(words) - 1) if (words[i], words[i + 1]) in exceptions for j in (i, i + 1)}
        weights = [max((entries.get(e, 0.0) for e in (f" {w} ", *(f" {w[:n]}" for n in range(1, len(w) + 1)))), default=0.0)
                   for i, w in enumerate(words) if i not in spared]
        weights = [x for x in weights if x > 0]
        n = len(words) + 10
        x = sum(a * b for a, b in zip(lexicon.scale, (1.0, max(weights, default=0.0), sum(weights) / math.sqrt(n), 10 * sum(weights) / n)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))

    want = sorted((str(r.doc_id), plain(r.text)) for r in docs.collect())
    got = sorted((str(r.doc_id), r.score, r.predicted) for r in LLM_QUERIES["op4_toxicity"](spark, str(tmp_path)).collect())
    assert [g[0] for g in got] == [w[0] for w in want]
    for (_, score, predicted), (_, expected) in zip(got, want):
        assert score == pytest.approx(expected, abs=1e-9) and predicted == int(score >= 0.3)
    assert entries and any(g[1] > 0.5 for g in got)


def test_sample_bounds_rows(spark):
    """Rows that repeat a labelled id are one row of the sample; a column named score stays."""
    docs = spark.createDataFrame([(1, f"nasty word {i}") for i in range(400)] + [(i, "plain text") for i in range(2, 40)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 40)], "doc_id long, toxic int")
    lexicon = X.learn(docs, labels)          # one toxic row is too little for an entry, four hundred copies are not more
    assert lexicon.entries == ()
    named = docs.limit(3).withColumn("score", F.lit("kept"))
    got = X.with_score(named, lexicon)
    assert got.columns == ["doc_id", "text", "score", "score_1"] and {r.score for r in got.collect()} == {"kept"}
