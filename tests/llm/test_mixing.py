"""Operator 8: slices are alike whatever the weights are, and rise with the key (results: SQL in test_queries)."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tributary.llm import mixing as M


@pytest.mark.parametrize("weight", ["0.1", "0.31", "1.0", "0.1 + 0.9 * rand(5)", "if(id % 50 = 0, 0.1, 0.95)", "if(id % 2 = 0, 0.12, 0.9)"])
def test_slices_are_alike(spark, weight):
    rows = (spark.range(40_000).selectExpr("if(id % 3 = 0, null, 's') as source", f"cast({weight} as double) as weight",
                                           "(xxhash64(id) / 18446744073709551616 + 0.5) as u")
            .select("source", "weight", (-F.ln("u") / F.col("weight")).alias("key"))).cache()
    sliced = M.sliced_keys(rows, 32)
    found = sliced.groupBy("source", "slice").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
    for source in (None, "s"):
        mine = sorted((r.slice, r.n, r.low, r.high) for r in found if r.source == source)
        assert max(n for _, n, _, _ in mine) < 2 * sum(n for _, n, _, _ in mine) / 32
        assert all(a[3] <= b[2] for a, b in zip(mine, mine[1:]))


def test_plan_stays_short(spark):
    """No step is planned again in each of its users: the driver plans and broadcasts little."""
    docs = spark.range(300).selectExpr("id % 290 as doc_id", "if(id % 4 = 0, null, concat('s', id % 3)) as source",
                                       "if(id % 7 = 0, null, repeat(concat('w', id % 290, ' '), int(id % 290 % 9))) as text")
    mixed = M.mixed_rows(docs)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        mixed.explain()
    assert plan.getvalue().count("Exchange") <= 8 and plan.getvalue().count("Window") <= 4
    want = sorted((r.doc_id, str(r.source)) for r in M.mix(docs).collect() for _ in range(r.epochs))
    assert sorted((r.doc_id, str(r.source)) for r in mixed.collect()) == want
