"""Operator 11: costs, audits and repaired rows against a plain search, whatever the blocks."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import turn_repair as R
from tributary.llm.queries import LLM_QUERIES


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen
                   else "" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Least (cost, audit) with its lines, state by state from the last row back."""
    due = {0: ("user", "q"), 1: ("user", "q"), "q": ("assistant", "a"), "a": ("user", "q")}
    keep = {(0, "s"): 1, (0, "u"): "q", (1, "u"): "q", ("q", "a"): "a", ("a", "u"): "q"}
    inf = (10**9, "", [])
    found = faults(rows)

    def with_inserts(ways):
        for _ in range(3):
            for s, (role, to) in due.items():
                c, a, lines = ways[to]
                ways[s] = min(ways[s], (c + 5, "I" + a, [f"{role}:"] + lines))
        return ways

    ways = with_inserts({0: (0, "", []), 1: inf, "q": inf, "a": (0, "", [])})
    for (role, text), fault in reversed(list(zip(rows, found))):
        extra = 5 * (fault == "truncated")
        new = {}
        for s in due:
            c, a, lines = ways[s]
            options = [(c + 2, "D" + a, lines)]
            if fault not in ("blank", "duplicate"):
                if (s, role[:1]) in keep:
                    c, a, lines = ways[keep[s, role[:1]]]
                    options.append((c + extra, "K" + a, [f"{role}:{text}"] + lines))
                c, a, lines = ways[due[s][1]]
                options.append((c + 1 + extra, "R" + a, [f"{due[s][0]}:{text}"] + lines))
            new[s] = min(options)
        ways = with_inserts(new)
    return ways[0]


def expected(rows):
    """(turn, role, text) in reading order -> the contract's columns."""
    said = [(r, t) for _, r, t in rows]
    f = faults(said)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(said, said[1:])]
    cost, audit, lines = plain_repair(said)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("blank"), f.count("duplicate"),
            f.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


ROLES = st.sampled_from(["system", "user", "assistant", "tool", " ", "sys", "A"])
TEXTS = st.sampled_from(["Yes.", "no", "", " \n", "What?", "Go! ", "end", "x.", "İ."])


@given(st.lists(st.lists(st.tuples(ROLES, TEXTS), min_size=1, max_size=9), min_size=1, max_size=5), st.data())
@settings(max_examples=200, deadline=None)
def test_arrays_against_plain_search(conversations, data):
    """Each conversation cut into stretches at any places gives the plain search's audit."""
    for rows in conversations:
        f = faults(rows)
        classes = np.array([R._GONE if x in ("blank", "duplicate") else 2 * ("sua".find(r[0]) % 4) + (x == "truncated")
                            for (r, _), x in zip(rows, f)])
        cuts = sorted(data.draw(st.sets(st.integers(1, len(rows) - 1)))) if len(rows) > 1 else []
        bounds = list(zip([0, *cuts], [*cuts, len(rows)]))
        ends, behind = [], R.AT_END
        for a, b in reversed(bounds):
            ends.append(behind)
            product = R._suffix_products(classes[a:b], np.full(b - a, b - a))[0]
            behind = (product + behind[None, :]).min(axis=1)
        cost, audit, _ = plain_repair(rows)
        assert behind[R.START] == cost
        found, state = "", R.START
        for (a, b), end in zip(bounds, reversed(ends)):
            _, _, letter, _, out = R.solve(classes[a:b], np.array([b - a]), np.array([state]), end[None, :],
                                           np.array([b == len(rows)]))
            found += "".join(R.LETTERS[x] for x in letter)
            state = int(out[0])
        assert found == audit


def _table():
    rnd = random.Random(11)
    texts = ["Yes.", "no", "", " \t", "Why?", "Go!", "end", "x."] + [f"t{i}." for i in range(30)]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rnd.randrange(1, 9)):
            rows.append((conv, turn * rnd.choice([1, 1, 2]) if rnd.random() < .95 else None,
                         rnd.choice(["system", "user", "assistant", "tool", None]), rnd.choice(texts + [None])))
    rows += [(100, t, rnd.choice(["user", "assistant"]), rnd.choice(texts)) for t in range(900)]  # a long one
    rows += [(101, 5, "user", "Same.")] * 70 + [(102, None, None, None)] * 3 + [(103, 1, "assistant", "long " * 100_000 + ".")]
    return rows


def _in_order(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", hashlib.sha256((" " if r[3] is None else r[3]).encode()).hexdigest())
    return [(t, r or " ", " " if x is None else x) for _, t, r, x in sorted(rows, key=key)]


@pytest.mark.parametrize("block_rows", [16, 1 << 15])
def test_tables_against_plain_search(spark, block_rows):
    rows = _table()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, block string, at int").repartition(5)
    fixed, audits = R.repair_conversations(df, block_rows=block_rows)
    shas = {r.conv: r.repaired_sha256 for r in R.digests(fixed).collect()}
    got = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                    shas.get(r.conv, hashlib.sha256(b"").hexdigest())) for r in audits.collect()}
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    assert got == {c: expected(_in_order(mine)) for c, mine in by_conv.items()}


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in rows:
        space = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{space(c)}:{space(t)}".encode()) % 20
        role, text = space(role), space(text)
        one = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [one] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(str, (tuple(r) for r in R.damaged(df).collect()))) == sorted(map(str, want))


def test_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    fixed, audits = R.repair_conversations(empty)
    assert fixed.count() == 0 and audits.count() == 0
    # A conversation all of whose rows are dropped is still returned.
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(dropped, 0, "user", "Hi.")], empty.schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in LLM_QUERIES["op11_repair"](spark, str(tmp_path)).collect()]
    assert got == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
