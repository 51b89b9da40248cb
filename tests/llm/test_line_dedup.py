"""Operator 7 against plain Python that compares positions."""

import re
from collections import defaultdict

import pytest

from tributary.llm import line_dedup as T

NO_ID = (1 << 63) - 1


def tokens(line):
    t = [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]
    masked = tuple("<*>" if re.search("[0-9@]", w) else w for w in t)
    return masked if any(m != "<*>" for m in masked) else tuple(t)


def plain(rows):
    """rows: (id, text); (id, kept text, number of lines)."""
    leaves = defaultdict(lambda: defaultdict(set))
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if t := tokens(line):
                leaves[len(t), t[:3]][t].add(NO_ID if doc is None else doc)

    def goes(doc, t):
        n = len(t)
        vary = n // 2 if n >= 16 else n // 4
        return any(min(docs) < doc and sum(a != b for a, b in zip(t, other)) <= vary
                   for other, docs in leaves[n, t[:3]].items())

    out = []
    for doc, text in rows:
        kept = [x for x in (text or "").split("\n") if not ((t := tokens(x)) and goes(NO_ID if doc is None else doc, t))]
        out.append((doc, None if text is None else "\n".join(kept), (text or "").count("\n") + 1))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r))


def check(spark, rows, docs=None):
    docs = docs or spark.createDataFrame([(i, t, 1, "x", 0) for i, t in rows],
                                         "doc_id long, text string, line int, leaf string, doc int")
    got = [(r.doc_id, r.text, r.n_lines) for r in T.dedup_lines(docs, marks=True).collect()]
    assert ordered(got) == ordered(plain(rows))
    return {i: t for i, t, _ in got}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in docs.collect()], docs)


def test_positions_that_differ(spark):
    """Variable words at positions 5 and 8, which are of two residue classes by 4."""
    got = check(spark, [(1, "session was opened for ann from host alpha"), (2, "session was opened for bob from host beta"),
                        (3, "session was opened for eve out of spite"),
                        (4, "we had a visit from ann today"), (5, "we had a visit from bob today"),
                        (6, "a b c d e f g h i j k l m n o p"), (7, "a b c d 1x 2x 3x 4x 5x j k l m n o 6x"),
                        (8, "a b c x x x x x x x x l m n o p"), (9, "a b c d y y y y y y y y y n o p")])
    assert got[2] == got[5] == got[7] == got[8] == "" and got[3] and got[9]


def test_blocks(spark, monkeypatch):
    """A leaf of many blocks gives what one block gives."""
    dice = __import__("random").Random(5)
    rows = [(i % 60, " ".join(["on", "the", "way"] + [dice.choice("abcdef") for _ in range(dice.choice([4, 9, 14]))]))
            for i in range(400)]
    whole = check(spark, rows)
    find = T.later_forms
    monkeypatch.setattr(T, "later_forms", lambda p, f: find(p, f, block_tokens=40, block_least=2))
    assert check(spark, rows) == whole


@pytest.mark.parametrize("line", ["Les.", "And ornd.", "just these three", "hello 7 reader"])
def test_short_lines(spark, line):
    got = check(spark, [(i, f"{line}\nown{'x' * i}") for i in range(5)])
    assert got[0].startswith(line) and not any(got[i].startswith(line) for i in range(1, 5))


@pytest.mark.parametrize("documents", [2, 3, 4])
def test_few_documents(spark, documents):
    """One line each in two to four documents; copies within one document do not count."""
    lines = "just four short words\nthe cat sat on ann today with her old hat"
    got = check(spark, [(i, lines.replace("ann", "ann bob cid dan".split()[i])) for i in range(documents)]
                + [(9, "only here\nonly here\nonly here\nonly here\nonly here")])
    assert got[0] == lines and not any(got[i] for i in range(1, documents)) and got[9].count("only here") == 5


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "a b c d e f g h i\nx y"), (5, "a b c d e f g h i\nx y"),
            (5, "a b c d e f g h i\nx y"), (None, "a b c d e f g h i"), (None, "a b c d e f g h i\nz"),
            (6, " a  b\tc d e f g h i \n"), (9, "q r s"), (9, "q r s\nq r s"), (10, "1984"), (11, "1985"), (12, "1984"),
            (13, "in 1984"), (14, "in 1985"), (15, "1 2 3 4"), (16, "1 2 3 5"), (17, "w " * 5000 + "a"), (18, "w " * 5000 + "b")]
    got = check(spark, rows)
    assert got[11] and not got[12] and not got[14] and not got[16] and not got[18]
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.dedup_lines(docs).columns == docs.columns and T.dedup_lines(docs).count() == 0


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "same line here", "x"), (2, "same line here", "y")], "doc_id long, text string, n_lines string")
    got = T.dedup_lines(docs, marks=True)
    assert got.columns == ["doc_id", "text", "n_lines", "n_lines_1", "n_dropped"]
    assert sorted((r.doc_id, r.n_lines, r.n_lines_1, r.n_dropped) for r in got.collect()) == [(1, "x", 1, 0), (2, "y", 1, 1)]
