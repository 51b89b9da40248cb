"""Operator 13: filters round trip, merge and stay lossless; phrases against a plain count."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import quotient_filter as Q
from tributary.llm.collocations import collocations, phrase_counts


def _halves(keys, half):
    mask = (1 << half) - 1
    return (np.array([k >> half for k in keys], np.uint64), np.array([k & mask for k in keys], np.uint64))


@given(st.sampled_from([1, 3, 17, 32, 33, 64]), st.data())
@settings(max_examples=150, deadline=None)
def test_filters_are_lossless(half, data):
    keys = st.lists(st.integers(0, (1 << min(2 * half, 9)) - 1).map(lambda k: k << (2 * half - min(2 * half, 9))), max_size=60)
    shards = data.draw(st.lists(keys, min_size=1, max_size=4))
    bits = data.draw(st.integers(0, min(half, 3)))
    by_segment = defaultdict(list)
    for one in shards:
        for segment, entries in Q.segments(Q.counted(*_halves(one, half), half), half, bits):
            back, same_half = Q.unpack(Q.pack(entries, half, bits), segment)
            assert same_half == half and all((a == b).all() for a, b in zip(back, entries))
            by_segment[segment].append(back)
    found = Counter()
    for parts in by_segment.values():
        high, low, counts = Q.merge(parts, half)
        a, b = Q.unpermute(high, low, half)
        for x, y, c in zip(a.tolist(), b.tolist(), counts.tolist()):
            found[x << half | y] += c
    assert found == Counter(k for one in shards for k in one)


def test_large_counts_and_size():
    entries = Q.counted(*_halves([5] * 1000 + [7], 20), 20)
    assert sorted(Q.unpack(Q.pack(entries, 20, 0), 0)[0][2].tolist()) == [1, 1000]
    keys = np.random.default_rng(1).integers(0, 1 << 40, 100_000).tolist()
    assert len(Q.pack(Q.counted(*_halves(keys, 20), 20), 20, 0)) < 6 * len(keys)  # 13 bytes as numbers and a byte


def plain(rows, least, keep, covered=80):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang or "und"][tuple(words[i:i + k])] += 1
    out = []
    for lang, found in f.items():
        scored = []
        for g, a in found.items():
            if len(g) < 2 or a < least:
                continue
            score, _, l, r = min((2000000 * a // (found[g[:k]] + found[g[k:]]), k, found[g[:k]], found[g[k:]])
                                 for k in range(1, len(g)))
            longer = [c for h, c in found.items() if len(h) > len(g) and c >= least
                      and any(h[i:i + len(g)] == g for i in range(len(h)))]
            if any(100 * c >= covered * a for c in longer):
                continue
            scored.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (s, a, g, l, r) in enumerate(sorted(scored)[:keep], 1):
            out.append((lang, rank, g.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def _texts():
    rnd = random.Random(7)
    words = ["a", "B", "c", "d\x1ce", "été", "é", "İ", "\U0001f600", "x\x00y", "\x00"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", "\x0c", "\r\n", " ; ", "! "]
    rows = [("".join(rnd.choice(words) + rnd.choice(ends if rnd.random() < .2 else [" "]) for _ in range(rnd.randrange(40))),
             rnd.choice(["en", "fr", None, "und"])) for _ in range(150)]
    long_text = " ".join(rnd.choice(words[:4]) for _ in range(30_000))
    return rows + [("", "en"), (None, "xx"), (None, None), (" \t.", "de"), (long_text, "en"), ("a b c d. " * 50, "en")] + rows[:5] * 3


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 300, "segment_words": 700}])
def test_against_plain_counts(spark, options):
    rows = _texts()
    docs = spark.createDataFrame([(t, l, "clash", 1) for t, l in rows], "text string, lang string, word string, n int")
    got = collocations(docs.repartition(3), least=6, keep=40, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 6, 40)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations(empty).count() == 0
    blank = spark.createDataFrame([(None, None), ("", "en"), ("one two", "en")], "text string, lang string")
    assert collocations(blank).count() == 0
    totals, words, phrases = phrase_counts(blank, least=1)
    assert {tuple(r) for r in totals.collect()} == {("en", 2), ("und", 0)}
    assert words.count() == 2 and phrases.count() == 3
    with pytest.raises(ValueError):
        phrase_counts(blank, longest=5)
