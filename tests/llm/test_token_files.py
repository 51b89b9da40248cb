"""Operator 5: exact round trips, and the query against encoding whole texts one by one."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import token_files as T
from tributary.llm.tokens import WordTokenizer, default_vocabulary, tokenizer

VALUES = st.one_of(st.integers(0, 1), st.integers(0, 49_407), st.integers(0, 2**60 - 1), st.integers(0, 2**64 - 1))


@given(st.lists(VALUES, max_size=300))
@settings(max_examples=300, deadline=None)
def test_words_round_trip(values):
    array = np.array(values, np.uint64)
    assert T.decode_block(T.encode_block(array)).tolist() == values


@given(st.lists(VALUES, max_size=300), st.integers(1, 70))
@settings(max_examples=200, deadline=None)
def test_blocks_round_trip_side_by_side(values, block_ids):
    array = np.array(values, np.uint64)
    words, offsets = T.encode_blocks(array, block_ids)
    assert T.decode_block(words).tolist() == values
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        assert T.decode_block(words[a:b]).tolist() == values[i * block_ids:(i + 1) * block_ids]
        assert words[a:b].tolist() == T.encode_block(array[i * block_ids:(i + 1) * block_ids]).tolist()


def test_words_are_dense():
    assert len(T.encode_block(np.ones(60, np.uint64))) == 1
    assert len(T.encode_block(np.full(8, 127, np.uint64))) == 1
    assert len(T.encode_block(np.full(4, 2**15 - 1, np.uint64))) == 1
    assert len(T.encode_block(np.array([2**60], np.uint64))) == 2


def test_file_round_trip_by_blocks():
    ids = np.random.default_rng(1).integers(0, 49_408, 3 * T.BLOCK_IDS + 17)
    counts = np.array([0, 5000, 1, len(ids) - 5001])
    data = T.pack_file([None, 3, 3, 9], counts, ids)
    found = T.TokenFile(data)
    assert found.doc_ids == [None, 3, 3, 9] and found.counts.tolist() == counts.tolist()
    assert found.ids(0, len(ids)).tolist() == ids.tolist()
    assert found.ids(4090, 20).tolist() == ids[4090:4110].tolist()
    with pytest.raises(ValueError):
        T.TokenFile(data[:-9] + data[-8:])
    with pytest.raises(ValueError):
        T.TokenFile(data[:40] + bytes([data[40] ^ 1]) + data[41:])


ODD = ["don't they'll, 's x.'s o'r,. a\u0085b c É! ٣. ²? x_. _. a1. İx. ǅ, ΑΣ. ΑΣ", "<|endoftext|> a <|StartOfText|>",
       "가. ﬁ, ½! ⅷ.​. 한국어. é. J̌ ǰ é. É", "I'M. IT'S, x'll. x'd? x'd'.", " \n\t ", "a" * 5000, "%%%. ***, a). b"]


@pytest.mark.parametrize("kept", [3, 10**6])
def test_words_are_encoded_as_the_whole(spark, kept):
    mine = WordTokenizer(default_vocabulary(), kept)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in ODD + texts:
        want = mine.model.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == want


#: Characters that blanks, lower-casing, composition and runs of marks could go wrong on.
TRICKY = [*"abzAZ019 .,;'\n\t_%-\x00\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0", "\u0130", "\u0131", "\u00e9", "\u00c9", "\u00df", "\u1e9e",
          "\u0301", "\u0307", "\u0327", "\u0338", "\u0149", "\u017f", "\ufb01", "\u03a3", "\u03c2", "\u03c3", "\u00b2", "\u00bd",
          "\u0663", "\u2177", "\ud55c", "\u1112", "\u1161", "\u304b", "\u3099", "\u093c", "\u0915", "\u200b", "\u2028", "\u3000",
          "\u01c5", "\u0416", "\u0436", "\u4e2d", "\u212a", "\u212b", "\u00b5", "\u0345", "\u1e9b", "\u0323", "\U0001f600",
          "'s", "'LL", "'re", ". ", ", ", ".\n", "word", "$$$", "!! "]


@given(st.lists(st.sampled_from(TRICKY), max_size=14).map("".join))
@settings(max_examples=4000, deadline=None)
def test_ids_are_the_librarys(text):
    mine = tokenizer(default_vocabulary())
    assert np.frombuffer(mine.encode(text), "<u4").tolist() == mine.model.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["T.C. \u0130. Bankas", "\u0130, evet", "end\x1c. next", "a\x1f, b", "x\u0301. y", "q!. z"])
def test_marks_after_marks(text):
    test_ids_are_the_librarys.hypothesis.inner_test(text)


def brute(rows):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(default_vocabulary())
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute(sorted((r.doc_id, r.text) for r in docs.collect()))
    got = [tuple(r) for r in T.token_digests(docs).collect()]
    assert sorted(got) == want


def test_odd_rows_and_small_files(spark, monkeypatch):
    rows = [(4, t) for t in ODD] + [(None, "x"), (None, None), (1, ""), (1, "")]
    docs = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, start int, file string")
    got = sorted((tuple(r) for r in T.token_digests(docs).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 1] + [4] * len(ODD)
    starts = np.cumsum([0] + [r[2] for r in got])
    assert [r[1] for r in got] == starts[:-1].tolist()
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in brute(rows))


def test_empty_table(spark):
    assert T.token_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
