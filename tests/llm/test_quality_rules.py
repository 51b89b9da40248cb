"""Operator 2 against plain Python: counts, and expectation-maximisation row by row."""

import math
import random
import re

import pytest

from tributary.llm import quality_rules as Q


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + d for places in seen.values() if len(places) > 1 for i in places for d in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: plain(r.text) for r in docs.collect()}
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in Q.counts(docs).collect()}
    assert got == want


def test_odd_rows(spark):
    cycle = " ".join(f"w{i % 10}" for i in range(20_000))
    texts = [None, "", " \n\t\x0b\x0c\r ", "a", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 9, "x " * 8,
             "one\n\none\n \none", "é #   *", cycle, "p q r s t u v w x y p q r s t u v w z"]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in enumerate(texts)] + [(None, "a", 1, 2, 3)] * 2,
                                 "doc_id long, text string, words int, n_words int, kept int")
    rows = Q.judge(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        want = plain("a" if r.doc_id is None else texts[r.doc_id])
        assert tuple(r[c] for c in COUNTS) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)
    assert Q.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_expectation_maximisation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rules = Q.default_rules()
    names = [f"vote_{r.name}" for r in rules]
    votes = Q.counts(docs).withColumns({n: r.vote() for n, r in zip(names, rules)})
    rows = [tuple(r) for r in votes.select(*names).collect()]
    prior, rates = 0.7, [(0.6, 0.01, 0.3, 0.3)] * len(names)

    def posterior(row):
        good, bad = prior, 1 - prior
        for vote, (ug, dg, ub, db) in zip(row, rates):
            good *= ug if vote > 0 else dg if vote < 0 else 1 - ug - dg
            bad *= ub if vote > 0 else db if vote < 0 else 1 - ub - db
        return good / (good + bad)

    for _ in range(30):
        p = [posterior(r) for r in rows]
        g, b = sum(p), len(p) - sum(p)
        held = 1 + 0.01 * len(p)
        after = [((sum(x for x, r in zip(p, rows) if r[k] > 0) + held * 0.6) / (g + held),
                  (sum(x for x, r in zip(p, rows) if r[k] < 0) + held * 0.01) / (g + held),
                  (sum(1 - x for x, r in zip(p, rows) if r[k] > 0) + held * 0.3) / (b + held),
                  (sum(1 - x for x, r in zip(p, rows) if r[k] < 0) + held * 0.3) / (b + held))
                 for k in range(len(names))]
        moved = max([abs((g + held * 0.7) / (g + b + held) - prior)] + [abs(x - y) for a, c in zip(after, rates)
                                                             for x, y in zip(a, c)])
        prior, rates = (g + held * 0.7) / (g + b + held), after
        if moved < 1e-4:
            break
    model = Q.fit(votes, names)
    assert model.prior == pytest.approx(prior, abs=1e-9)
    for name, rate in zip(names, rates):
        assert model.rates[name] == pytest.approx(rate, abs=1e-9)
    assert all(math.isfinite(x) for r in rates for x in r)


def test_agrees_with_labels(spark):
    """Labels are never read by the operator; documents labelled good are kept, junk goes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.judge(docs).join(labels.withColumnRenamed("quality", "label"), "doc_id").collect()
    good, bad = [r.kept for r in rows if r.label == 1], [r.kept for r in rows if r.label == 0]
    assert sum(good) / len(good) > 0.9 and sum(bad) / len(bad) < 0.1


def test_few_words_get_one_vote_at_every_length(spark):
    """Texts shuffled from eight words: no length at which the vocabulary rule falls silent."""
    rnd = random.Random(5)
    words = ["lorem", "ipsum", "dolor", "amet", "magna", "aliqua", "tempor", "labore"]
    rows = [(n, " ".join(rnd.choice(words) for _ in range(n))) for n in (60, 255, 256, 999, 1000, 1001, 20_000)]
    varied = " ".join(f"w{i % 700}" for i in range(2000))
    counted = Q.counts(spark.createDataFrame([*rows, (-1, varied)], "doc_id long, text string"))
    rule = next(r for r in Q.default_rules() if r.name == "vocabulary")
    votes = {r.doc_id: r.v for r in counted.select("doc_id", rule.vote().alias("v")).collect()}
    assert votes == {**{n: -1 for n, _ in rows}, -1: 0}
