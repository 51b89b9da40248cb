"""Keyed state and maintained sums: small writes, every writer's rows, equal to the recompute."""

import random
import threading
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.operators import latest_version
from tributary.session import input_bytes
from tributary.storage.commits import CommitLog
from tributary.streaming import upsert as U
from tributary.streaming.sums import MaintainedSums, group_sums
from tributary.streaming.upsert import KeyedState, incremental_upsert, stream_latest

SCHEMA = "k long, ts long, v string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _state(spark, root, **options):
    from pyspark.sql.types import StructType
    return KeyedState(spark, root, StructType.fromDDL(SCHEMA), ["k"], ["ts"], ["v"], **options)


def test_a_small_batch_writes_little(spark, scratch):
    """A thousandth of the keys, in every bucket: under two percent of the state's bytes, also after many batches."""
    root = scratch("small")
    n = 400_000
    base = spark.range(n).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    state = _state(spark, root)
    state.merge(base)
    size = input_bytes(spark, [f"{root}/data"])
    assert len(state.head()[1]["directory"]) >= 16
    log = base
    for i in range(1, 5):
        batch = base.where(F.pmod(F.xxhash64("k", F.lit(i)), F.lit(1000)) == 0).select(
            "k", F.lit(i).cast("long").alias("ts"), F.sha2(F.concat("v", F.lit(i)), 256).alias("v"))
        before = input_bytes(spark, [root])
        done = state.merge(batch)
        written = input_bytes(spark, [root]) - before
        assert done.rows > 300 and written < 0.02 * size, (i, written, size)
        log = log.unionByName(batch)
    assert _rows(state.read().agg(F.count("*"), F.sum(F.xxhash64("k", "ts", "v").cast("decimal(30,0)")))) == _rows(
        latest_version(log, ["k"], ["ts"], ["v"]).agg(F.count("*"), F.sum(F.xxhash64("k", "ts", "v").cast("decimal(30,0)"))))


def test_buckets_split_and_layers_merge(spark, scratch, monkeypatch):
    monkeypatch.setattr(U, "LEAST_BUCKET_BYTES", 4_000)
    root, rnd = scratch("split"), random.Random(1)
    state = _state(spark, root, bucket_bytes=8_000)
    log = None
    for i in range(9):
        batch = spark.createDataFrame([(rnd.randrange(1500) if rnd.random() < .98 else None, rnd.randrange(40), f"{rnd.random()}" * 3)
                                       for _ in range(60 if i % 3 else 700)], SCHEMA)
        state.merge(batch)
        log = batch if log is None else log.unionByName(batch)
        assert _rows(state.read()) == _rows(latest_version(log, ["k"], ["ts"], ["v"]))
    entry = state.head()[1]
    names = entry["directory"]
    assert len(names) > 4 and len({len(x) for x in names}) >= 1
    # the names are a complete, prefix-free directory
    assert sum(2.0 ** -len(x) for x in names) == 1
    assert max(len(g) for g in U._by_bucket(entry["layers"]).values()) < 10
    keys = spark.createDataFrame([(5,), (None,), (10**9,)], "k long")
    assert _rows(state.lookup(keys)) == [r for r in _rows(state.read()) if r[0] in (5, None)]


def test_changes_since_a_version(spark, scratch):
    state = _state(spark, scratch("feed"))
    assert state.changes(-1) is None and state.content_version() == -1
    state.merge(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA))
    assert state.changes(-1) is None          # the state began after that
    mark = state.content_version()
    assert state.changes(mark).count() == 0
    state.merge(spark.createDataFrame([(1, 2, "a2"), (3, 1, "c"), (2, 0, "older")], SCHEMA))
    state.merge(spark.createDataFrame([(1, 3, "a3"), (None, 1, "n")], SCHEMA))
    got = {r.k: (r.old and tuple(r.old), tuple(r.new)) for r in state.changes(mark).collect()}
    assert got == {1: ((1, 1, "a"), (1, 3, "a3")), 3: (None, (3, 1, "c")), None: (None, (None, 1, "n"))}
    # the same batch again changes nothing
    before = state.log.newest()
    assert state.merge(spark.createDataFrame([(1, 3, "a3"), (3, 1, "c")], SCHEMA)).version is None
    assert state.log.newest() == before
    # commits that are not kept any more
    short = _state(spark, state.root, keep=2)
    for i in range(4, 8):
        short.merge(spark.createDataFrame([(1, i, "x")], SCHEMA))
    assert short.changes(mark) is None and [r.ts for r in short.read().where("k = 1").collect()] == [7]


def test_a_second_upsert_on_the_same_root_keeps_all(spark, scratch):
    root = scratch("again")
    first = spark.createDataFrame([(i, 1, "a") for i in range(60)], SCHEMA)
    second = spark.createDataFrame([(i, 2, "b") for i in range(50, 110)], SCHEMA)
    incremental_upsert([first.where("k < 20"), first.where("k between 20 and 39"), first.where("k > 39")], root, ["k"], ["ts"], ["v"])
    got = incremental_upsert([second], root, ["k"], ["ts"], ["v"])
    assert _rows(got) == _rows(latest_version(first.unionByName(second), ["k"], ["ts"], ["v"]))


def test_a_lost_checkpoint_loses_no_row(spark, scratch):
    root = scratch("checkpoint")
    log = spark.createDataFrame([(i % 40, i, f"v{i}") for i in range(120)], SCHEMA)
    for low, checkpoint in ((0, "a"), (40, "a"), (80, "b")):   # the third run finds no checkpoint: batches from 0 again
        log.where((F.col("ts") >= low) & (F.col("ts") < low + 40)).write.mode("append").parquet(f"{root}/bronze")
        _, merged, got = stream_latest(spark, f"{root}/bronze", log.schema, f"{root}/state", f"{root}/{checkpoint}", ["k"], ["ts"], ["v"])
    assert merged == [0] and _rows(got) == _rows(latest_version(log, ["k"], ["ts"], ["v"]))


def test_two_writers_at_once_keep_all(spark, scratch, monkeypatch):
    root = scratch("writers")
    _state(spark, root).merge(spark.createDataFrame([(0, 0, "z")], SCHEMA))
    meet, put = threading.Barrier(2), CommitLog.put
    waited = threading.local()

    def together(self, number, entry):
        if not getattr(waited, "done", False):  # both have looked at the same version before either commits
            waited.done = True
            meet.wait(60)
        put(self, number, entry)
    monkeypatch.setattr(CommitLog, "put", together)
    rows = {i: [(k, i, f"w{i}") for k in range(i * 10, i * 10 + 30)] for i in (1, 2)}
    threads = [threading.Thread(target=lambda i=i: _state(spark, root).merge(spark.createDataFrame(rows[i], SCHEMA))) for i in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    log = spark.createDataFrame([(0, 0, "z"), *rows[1], *rows[2]], SCHEMA)
    assert _rows(_state(spark, root).read()) == _rows(latest_version(log, ["k"], ["ts"], ["v"]))


def test_a_new_column_reaches_the_state(spark, scratch):
    state = _state(spark, scratch("column"))
    state.merge(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA))
    state.merge(spark.createDataFrame([(2, 2, "c", 7)], SCHEMA + ", extra int"))
    assert _rows(_state(spark, state.root).read()) == _rows(spark.createDataFrame(
        [(1, 1, "a", None), (2, 2, "c", 7)], SCHEMA + ", extra int"))


SALE = st.tuples(st.integers(0, 12), st.sampled_from([None, 1, 2]), st.sampled_from([None, 1, 7]),
                 st.sampled_from([None, "0.10", "-5.55", "9999999.99", "0.00"]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(SALE, max_size=8), min_size=2, max_size=4))
def test_maintained_sums_equal_the_aggregate(spark, scratch, rounds):
    """Sales come, change month, store or amount and are cancelled (left out of a round): subtract old, add new."""
    schema = "venda_id long, mes long, loja_id long, total decimal(10,2)"

    def frame(sales):
        return spark.createDataFrame([(i, m, s, None if t is None else Decimal(t)) for i, m, s, t in sales], schema)
    states = [{s[0]: s for s in one} for one in rounds]
    sums = MaintainedSums(spark, scratch("sums"), ["mes", "loja_id"], "total")
    sums.rebuild(frame(states[0].values()), 0)
    for i, (old, new) in enumerate(zip(states, states[1:])):
        changed = [k for k in {*old, *new} if old.get(k) != new.get(k)]
        sums.apply(frame([old[k] for k in changed if k in old]), frame([new[k] for k in changed if k in new]), i, i + 1)
    assert _rows(sums.read()) == _rows(group_sums(frame(states[-1].values()), ["mes", "loja_id"], "total"))


def test_sums_refuse_a_gap(spark, scratch):
    import pytest
    rows = spark.createDataFrame([(1, 1, 2.0)], "mes long, loja_id long, total double")
    sums = MaintainedSums(spark, scratch("gap"), ["mes", "loja_id"], "total")
    sums.rebuild(rows, 3)
    with pytest.raises(ValueError):
        sums.apply(rows, rows, 4, 5)


def test_a_large_load_is_dealt_out_once(spark, scratch):
    """Rows find their bucket without a shuffle, large loads alike in size are not merged at once, hot keys are reduced first."""
    import contextlib
    import io
    state = _state(spark, scratch("large"))
    rows = spark.range(60_000).select(F.when(F.col("id") % 20 == 0, None).otherwise(F.col("id") % 50_000).alias("k"), F.col("id").alias("ts"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("v"))
    loads = [rows.where("ts < 30000"), rows.where("ts between 30000 and 49999"), rows.where("ts >= 50000 or ts < 100")]
    for load in loads:
        state.merge(load)
    entry = state.head()[1]
    assert max(len(g) for g in U._by_bucket(entry["layers"]).values()) == 3
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        state._with_bucket(rows, ["0", "10", "11"]).explain()
    assert "Exchange hashpartitioning" not in plan.getvalue()
    assert _rows(state.read()) == _rows(latest_version(rows, ["k"], ["ts"], ["v"]))
    got = {r.k: (r.old and r.old.ts, r.new.ts) for r in state.changes(0).collect()}
    assert got[None] == (29_980, 59_980) and got[1] == (1, 50_001) and got[49_999] == (None, 49_999)
