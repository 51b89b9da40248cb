"""Operator 10: every id once, whole windows, mixtures held, against whole-text encoding."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import packing as P
from tributary.llm.tokens import default_vocabulary


@given(st.lists(st.integers(0, 3000), min_size=1, max_size=6), st.integers(1, 200), st.data())
@settings(max_examples=200, deadline=None)
def test_round_robin_is_exact(totals, cap, data):
    total = sum(totals)
    caps = [cap] * (total // cap) + [total % cap] * bool(total % cap)
    if not caps:
        return
    takes = P.deficit_round_robin(totals, caps)
    assert (takes >= 0).all()
    assert takes.sum(axis=0).tolist() == totals and takes.sum(axis=1).tolist() == caps
    ideal = np.outer(np.cumsum(caps), totals) / total
    assert (np.abs(np.cumsum(takes, axis=0) - ideal) <= len(totals)).all()  # the deficit stays bounded


@given(st.lists(st.integers(0, 800), min_size=1, max_size=4), st.sampled_from([4, 16, 64]), st.sampled_from([2, 3, 256]))
@settings(max_examples=100, deadline=None)
def test_layout_places_every_token_once(totals, capacity, fan):
    layout = P.Layout(totals, capacity, fan=fan)
    places = defaultdict(list)
    for queue, total in enumerate(totals):
        for start in range(0, total, 7):
            n = min(7, total - start)
            got = list(layout.pieces(queue, start, n))
            assert sum(x[3] for x in got) == n
            for window, offset, _, length in got:
                places[window].extend(range(offset, offset + length))
    sizes = []
    for window in sorted(places):
        assert sorted(places[window]) == list(range(len(places[window])))
        sizes.append(len(places[window]))
    assert sorted(places) == list(range(layout.windows))
    full, rest = divmod(sum(totals), capacity)
    assert sizes[:full] == [capacity] * full and sum(sizes[full:]) == rest
    assert all(n & (n - 1) == 0 for n in sizes)


def test_shares_empty_a_queue_first():
    takes = P.deficit_round_robin([100, 100], [20] * 10, [3, 1])
    assert takes[:5].tolist() == [[15, 5]] * 5
    assert takes.sum(axis=0).tolist() == [100, 100]


def check(spark, docs, capacity=P.CAPACITY):
    model = Tokenizer.from_file(default_vocabulary())
    rows = docs.select("doc_id", "text", "source").collect()
    want = defaultdict(list)
    for r in rows:
        ids = [*model.encode(r.text or "", add_special_tokens=False).ids, 2]
        want[r.doc_id].append(np.array(ids, "<u4"))
    got = P.pack(docs, capacity=capacity, with_ids=True).collect()
    sequences, per_doc = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length > 0 and zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        per_doc[r.doc_id].append((r.start, r.length, r.doc_tokens, bytes(r.ids)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0
    total = sum(len(i) for x in want.values() for i in x)
    assert sum(length for x in sequences.values() for _, length in x) == total
    assert set(per_doc) == set(want)
    for doc_id, texts in want.items():
        if len(texts) == 1:
            parts = sorted(per_doc[doc_id])
            assert b"".join(p[3] for p in parts) == texts[0].tobytes()
            assert [p[0] for p in parts] == np.cumsum([0] + [p[1] for p in parts])[:-1].tolist()
            assert {p[2] for p in parts} == {len(texts[0])}
    return got


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    got = check(spark, docs)
    share = defaultdict(lambda: defaultdict(int))
    totals = defaultdict(int)
    for r in got:
        share[r.sequence_id][r.source] += r.length
        totals[r.source] += r.length
    total = sum(totals.values())
    for window, held in share.items():
        if sum(held.values()) == P.CAPACITY:
            for source in totals:
                assert abs(held[source] - P.CAPACITY * totals[source] / total) <= 2 * len(totals)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x " * 9000, "a"), (4, "one", "b"), (4, "one", "b"), (None, "é", None),
            (5, "<|endoftext|> z", "c")]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                                 "doc_id long, text string, source string, chunk int, `at` int, n_tokens int")
    check(spark, docs, 64)
    assert P.pack(spark.createDataFrame([], docs.schema)).count() == 0


def test_new_words_of_many_texts_are_encoded_together(monkeypatch):
    from tributary.llm import tokens as T
    monkeypatch.setattr(T, "TOGETHER", 200)
    texts = [None, "", "a <|b", "é".join("xyz") + "́", *(f"wort{'abcdefgh'[i % 8] * (i % 11)} zz{'qrst'[i % 4] * i}!, 7{i}." for i in range(120)), " \n"]
    mine, calls = T.WordTokenizer(default_vocabulary(), 50), []
    learn = mine._learn
    monkeypatch.setattr(mine, "_learn", lambda words: (calls.append(len(words)), learn(words)))
    model = Tokenizer.from_file(default_vocabulary())
    want = [np.array(model.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert mine.encode_all(texts) == want and len(calls) < 6
    assert [mine.encode(t) for t in texts] == want
