"""Operator 6 against plain Python, and the laws of a multiset hash."""

import hashlib
import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tributary.llm import fingerprint as P


def plain(text, k=P.SHINGLE):
    mask = P.MODULUS - 1
    identity, counts, n = [0] * (P.IDENTITY + 1), [0] * 64, 0
    for paragraph in text.split("\n"):
        for seed in range(P.IDENTITY):
            # Spark hashes columns in turn, each with the hash before as its seed.
            first = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
            identity[seed] = identity[seed] + xxhash.xxh64_intdigest(paragraph.encode(), first) & mask
        identity[-1] += 1
        words = [w.encode() for w in re.split(r"[\x20\x09-\x0D]+", paragraph) if w]
        for i in range(max(1, len(words) - k + 1) if words else 0):
            h = 42
            for w in words[i:i + k]:
                h = xxhash.xxh64_intdigest(w, h)
            n += 1
            for b in range(64):
                counts[b] += h >> b & 1
    return identity, [*counts, n]


def plain_near(a, b):
    if a == b:
        return 1.0
    x, y = ([c - v[1][-1] / 2 for c in v[1][:64]] for v in (a, b))
    size = sum(p * p for p in x) * sum(p * p for p in y)
    return min(1.0, max(0.0, sum(p * q for p, q in zip(x, y)) / math.sqrt(size))) if size else 0.0


def text_of(v):
    return "".join(f"{x:08x}" for x in [*v[0], *v[1]])


def expected(rows):
    """rows: (id, text) in order."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, next_one = plain(text), plain(edited), plain(following)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(own), text_of(other),
                    plain_near(own, other), plain_near(own, next_one)))
    return out


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == w[:5]
        assert tuple(g)[5:] == pytest.approx(w[5:], abs=1e-9)


@pytest.mark.parametrize("bucket", [1000, 7])
def test_whole_table(spark, monkeypatch, bucket):
    monkeypatch.setattr(P, "BUCKET_ROWS", bucket)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = sorted(P.edit_likeness(docs).collect())
    same(got, expected(rows))
    edited, following = [r.near_edited for r in got], [r.near_next for r in got]
    assert sum(e > f for e, f in zip(edited, following)) > 0.9 * len(got)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (4, "\n\n"), (5, "é ü\nx"), (6, " "), (7, "w " * 30_000), (8, "😀b")]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows],
                                 "doc_id long, text string, bucket int, place int, identity string")
    same(sorted(P.edit_likeness(docs).collect()), expected(rows))
    one = spark.createDataFrame([(5, "p q r s")], "doc_id long, text string")
    same(P.edit_likeness(one).collect(), expected([(5, "p q r s")]))
    assert P.edit_likeness(one.filter("doc_id < 0")).count() == 0
    ties = spark.createDataFrame([(None, "a b"), (None, "c d"), (3, "e f"), (3, "e f"), (3, "e f")],
                                 "doc_id long, text string")
    got = P.edit_likeness(ties).collect()
    assert [r.doc_id for r in got].count(None) == 2 and len(got) == 5


def test_order_insertion_deletion(spark):
    dice = random.Random(3)
    paragraphs = [" ".join(dice.choices("abcdefgh", k=dice.randrange(6))) for _ in range(40)]
    shuffled = dice.sample(paragraphs, len(paragraphs))
    texts = {"all": "\n".join(paragraphs), "shuffled": "\n".join(shuffled), "some": "\n".join(paragraphs[:25]),
             "rest": "\n".join(paragraphs[25:])}
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    v = {r["name"]: (list(r.identity), list(r.likeness)) for r in P.fingerprints(df, ["name"]).collect()}
    assert v["all"] == v["shuffled"] != v["some"]
    for part in (0, 1):
        row = spark.createDataFrame([(v["all"][part], v["some"][part], v["rest"][part])],
                                    "a array<long>, s array<long>, r array<long>").select(
            P.add(F.col("s"), F.col("r")).alias("sum"), P.subtract(F.col("a"), F.col("r")).alias("less")).first()
        assert list(row["sum"]) == v["all"][part] and list(row["less"]) == v["some"][part]
