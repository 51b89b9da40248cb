"""Operator 12: archives read back whole, and what is left of damaged ones."""

import gzip
import hashlib
import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import warc as W

DATE = "2024-01-01T00:00:00Z"


def _pages(n, rnd):
    texts = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(400))) for _ in range(n)]
    return [W.page_record(i, f"http://a.b/{i} é\r\n", t, hashlib.sha256(t).hexdigest(), len(t), DATE) for i, t in enumerate(texts)]


def _read(data):
    return list(W.salvage(io.BytesIO(data), len(data)))


@given(st.integers(0, 2**32), st.booleans(), st.integers(1, 3))
@settings(max_examples=120, deadline=None)
def test_damage_costs_only_the_records_it_hits(seed, compressed, hits):
    rnd = random.Random(seed)
    parts = [gzip.compress(p) if compressed or rnd.random() < .2 else p for p in _pages(rnd.randrange(1, 9), rnd)]
    data = bytearray(b"".join(parts))
    hurt = set()
    starts = [sum(map(len, parts[:i])) for i in range(len(parts))]
    for _ in range(hits):
        at, n = rnd.randrange(len(data)), rnd.randrange(1, 60)
        for k in range(at, min(at + n, len(data))):
            data[k] ^= rnd.randrange(1, 256)
        hurt |= {i for i, s in enumerate(starts) if s < at + n and at < s + len(parts[i])}
    found = _read(bytes(data))
    # Records and gaps cover the file in order, without holes.
    at = 0
    for offset, length, _ in found:
        assert offset == at and length > 0
        at += length
    assert at == len(data)
    whole = {offset for offset, _, r in found if isinstance(r, W.Record)}
    assert {starts[i] for i in range(len(parts)) if i not in hurt} <= whole
    for offset, length, r in found:
        if isinstance(r, W.Record):
            assert bytes(data[offset:offset + length]) in parts or starts.index(offset) in hurt


def test_cut_and_removed_stretches():
    rnd = random.Random(3)
    parts = [gzip.compress(p) for p in _pages(6, rnd)]
    data = b"".join(parts)
    assert [len(x) for _, _, x in [(0, 0, parts)]] == [6] and len(_read(data)) == 6
    cut = _read(data[:-5])
    assert [isinstance(r, W.Record) for _, _, r in cut] == [True] * 5 + [False]
    gone = b"".join(parts[:2]) + parts[2][:40] + parts[3][50:] + parts[4] + b"\0" * 3_000_000 + parts[5]
    kinds = [isinstance(r, W.Record) for _, _, r in _read(gone)]
    assert kinds == [True, True, False, True, False, True]
    assert _read(b"") == [] and [r for _, _, r in _read(b"nothing here")] == ["no version line"]


def test_wrong_length_and_digest():
    text = b"x" * 300
    good = W.page_record(1, None, text, hashlib.sha256(text).hexdigest(), 300, DATE)
    for bad in (good.replace(b"xxx", b"xyx", 1), good.replace(b"Content-Length: 3", b"Content-Length: 9", 1),
                good.replace(b"WARC-Type", b"WARC/Type")):
        found = _read(bad + good)
        assert [isinstance(r, W.Record) for _, _, r in found][-1] and isinstance(found[0][2], str)
        assert found[-1][0] == len(bad)


ROWS = [(5, "http://a/5", "p" * 200), (2, "http://a/2", "p" * 200), (None, "http://a/n", "p" * 200), (9, None, "p" * 99),
        (8, "u", "p" * 99), (7, "x y\nz", None), (6, "", ""), (2, "http://a/2", "p" * 200), (None, "a", "q" * 150),
        (None, "b", "q" * 150), (11, "é", "\U0001f600" * 25), (12, "é", "\U0001f600" * 25), (13, "l", "long " * 300_000),
        (14, "l", "long " * 300_000), (15, "w", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9)]


def plain(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = len(data) >= 100 and ids and page_id != min(ids)
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    min(ids) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"compressed": False, "file_bytes": 2000}])
def test_written_and_read_back(spark, scratch, options):
    pages = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, digest string, first int")
    folder = scratch("warc")
    manifest = W.write_archive(pages.repartition(3), folder, **options)
    assert sum(r.n_records for r in manifest.collect()) == len(ROWS)
    found = W.archived_pages(spark, folder)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()]
    assert sorted(got, key=str) == plain(ROWS)
    texts = {r.page_id: r.payload for r in found.collect() if r.record_type == "response"}
    assert texts[2] == b"p" * 200 and texts[7] == b"" and texts[13] == b"long " * 300_000
    # Every revisit refers to a record that is there.
    ids = {r.record_id for r in found.collect() if r.record_type == "response"}
    assert all(r.refers_to_id in ids for r in found.collect() if r.record_type == "revisit")


def test_gaps_are_logged(spark, scratch):
    folder = scratch("warc")
    pages = spark.createDataFrame([(i, "u", str(i) * 500) for i in range(40)], "page_id long, url string, html string")
    manifest = W.write_archive(pages.coalesce(1), folder)
    name = manifest.first()["file"]
    path = f"{folder}/archive/{name}".removeprefix("file:")
    with open(path, "r+b") as f:
        f.seek(os.path.getsize(path) // 2)
        f.write(b"\0" * 200)
    gaps = W.quarantined(W.read_archive(manifest, f"{folder}/archive")).collect()
    left = W.archived_pages(spark, folder).count()
    assert len(gaps) == 1 and gaps[0].file == name and gaps[0].reason and gaps[0].length >= 200
    assert 30 <= left < 40


def test_empty_table(spark, scratch):
    folder = scratch("warc")
    assert W.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), folder).count() == 0
    assert W.archived_pages(spark, folder).count() == 0
