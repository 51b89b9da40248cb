"""Operator 1 against a plain all-pairs version."""

import random

import pytest
import xxhash

from tributary.llm import simhash as S
from tributary.llm.components import connected_components


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) > k else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits):
    """Smallest id per row; prints: list of (id, fingerprint)."""
    rows = list(range(len(prints)))

    def root(i):
        while rows[i] != i:
            i = rows[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= max_bits:
                rows[root(i)] = root(j)
    lowest = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            lowest[root(i)] = min(doc, lowest.get(root(i), doc))
    return [lowest.get(root(i)) for i in range(len(prints))]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    component = plain_components(want, 4)
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in S.simhash_components(docs).collect()}
    assert got == {i: (f, c) for (i, f), c in zip(want, component)}


def test_odd_rows(spark):
    """Nulls, blanks, ties, repeated rows, few words, clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo"), (5, "ONE\ttwo"), (None, "one two"),
            (7, "É a b c d"), (8, "é a b c d"), (9, long), (10, long + " end"), (None, "nothing like it at all here")]
    docs = spark.createDataFrame([(i, t, "x", 0, 0, 0) for i, t in rows],
                                 "doc_id long, text string, fp string, root int, node int, component_id int")
    want = [(i, plain_fingerprint(t)) for i, t in rows]
    component = plain_components(want, 4)
    got = S.simhash_components(docs).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted([(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got], key=key) == sorted(
        [(i, f, c) for (i, f), c in zip(want, component)], key=key)
    kept = S.one_per_component(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {c if c is not None else f for (i, f), c in zip(want, component)}
    assert len(ids) == len(groups)
    assert {1, 4, 9} <= set(ids) and None in ids


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_components(docs).count() == 0
    assert S.one_per_component(docs).count() == 0


@pytest.mark.parametrize("chunk,blocks", [(20_000, None), (7, None), (20_000, 7)])
def test_links_lose_nothing(spark, monkeypatch, chunk, blocks):
    """Dense clusters, with keys that stay whole and keys that are split."""
    dice = random.Random(5)
    prints = set()
    for _ in range(4):
        base = dice.getrandbits(64)
        for _ in range(60):
            value = base
            for _ in range(dice.randrange(9)):
                value ^= 1 << dice.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p) for p in prints]
    if blocks:
        monkeypatch.setattr(S, "blocks_for", lambda n, k: blocks)
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = connected_components(S.links(nodes, 4, chunk)).collect()
    root = {r.node & (1 << 64) - 1: r.root for r in found}
    want = plain_components(list(enumerate(prints)), 4)
    groups = {}
    for p, c in zip(prints, want):
        groups.setdefault(c, set()).add(root.get(p, ("alone", p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_blocks_agree():
    for k in (0, 1, 4, 8):
        for n in (0, 10, 10**5, 10**9):
            blocks = S.blocks_for(n, k)
            assert blocks > k and sum(S.block_widths(blocks)) == 64
