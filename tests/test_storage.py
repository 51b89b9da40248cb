"""Commit log, published tables, append logs: a lost or second writer never costs rows."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from tributary.sources.bronze import write_append, write_truncate
from tributary.sources.relational import TableSpec, ingest_incremental
from tributary.storage import tables as T
from tributary.storage.commits import CommitConflict, CommitLog
from tributary.storage.tables import SchemaConflict, Table, merge_schema, read_table, was_loaded


class Lost(BaseException):
    """The driver is gone."""


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _local(path):
    return path.removeprefix("file:")


def test_a_number_is_given_once(spark, scratch):
    root = scratch("log")
    first, second = CommitLog(spark, root), CommitLog(spark, root)
    assert first.newest() == -1
    first.put(0, {"by": 1})
    with pytest.raises(CommitConflict):
        second.put(0, {"by": 2})
    assert second.entry(0) == {"by": 1}
    # of many writers that want the same number, one gets it
    got = []

    def write(i):
        try:
            CommitLog(spark, root).put(1, {"by": i})
            got.append(i)
        except CommitConflict:
            pass
    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(got) == 1 and CommitLog(spark, root).entry(1) == {"by": got[0]}
    assert sorted(n for n in os.listdir(f"{_local(root)}/_log")) == ["000000000000.json", "000000000001.json"]


@pytest.mark.parametrize("partition_by", [(), ("m",)])
def test_a_writer_lost_at_any_step_leaves_the_old_or_the_new_table(spark, scratch, monkeypatch, partition_by):
    old = spark.createDataFrame([(1, 1), (2, 2)], "v long, m long")
    new = spark.createDataFrame([(3, 1), (4, 3)], "v long, m long")

    def lost_before(monkey, what, name):
        def stop(*a, **k):
            raise Lost
        monkey.setattr(what, name, stop)

    steps = [(Table, "_write", old), (CommitLog, "put", old), (Table, "_clean", new)]
    for what, name, expected in steps:
        path = scratch("lost") + "/t"
        assert not was_loaded(spark, path)
        Table(spark, path).replace(old, partition_by)
        with monkeypatch.context() as m:
            lost_before(m, what, name)
            with pytest.raises(Lost):
                Table(spark, path).replace(new, partition_by)
        assert _rows(read_table(spark, path)) == _rows(expected), name
        # the next load goes on from there
        Table(spark, path).replace(new, partition_by)
        assert _rows(read_table(spark, path)) == _rows(new)
    # a first load that is lost was never a load
    path = scratch("lost") + "/first"
    with monkeypatch.context() as m:
        lost_before(m, CommitLog, "put")
        with pytest.raises(Lost):
            Table(spark, path).replace(old, partition_by)
    assert not Table(spark, path).exists()


def test_a_published_table_that_is_gone_fails(spark, scratch):
    import shutil
    path = scratch("gone") + "/t"
    Table(spark, path).replace(spark.createDataFrame([(1,)], "v long"))
    shutil.rmtree(f"{_local(path)}/{Table(spark, path).head()[1]['parts'][0]['path']}")
    assert was_loaded(spark, path)
    with pytest.raises(Exception):
        read_table(spark, path).collect()


def test_empty_loads_read_the_source_once(spark, scratch):
    path = scratch("empty") + "/t"
    rows = spark.createDataFrame([(1, "a")], "v long, s string")
    write_truncate(rows, path)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        read.add(1)
        yield from batches
    source = rows.where("v > 5").coalesce(1).mapInArrow(counted, rows.schema)
    assert not write_truncate(source, path, skip_empty=True).written and read.value == 1
    assert read_table(spark, path).count() == 1
    assert write_truncate(source, path).written and read_table(spark, path).count() == 0
    assert not write_append(rows.where("v > 5"), path).written


def test_schema_grows_by_name_and_refuses_what_does_not_fit(spark, scratch):
    path = scratch("schema") + "/t"
    write_append(spark.createDataFrame([(1, 1, "a")], "id int, n int, s string"), path)
    write_append(spark.createDataFrame([("b", 2, 2**40, 0.5)], "s string, id int, n long, extra double"), path)
    write_append(spark.createDataFrame([(3,)], "id int"), path)
    assert _rows(read_table(spark, path)) == _rows(spark.createDataFrame(
        [(1, 1, "a", None), (2, 2**40, "b", 0.5), (3, None, None, None)], "id int, n long, s string, extra double"))
    history = Table(spark, path, keep=9).schema_history()
    assert history[-1][1].simpleString() == "struct<id:int,n:bigint,s:string,extra:double>"
    before = Table(spark, path).log.newest()
    with pytest.raises(SchemaConflict):
        write_append(spark.createDataFrame([("x",)], "n string"), path)
    assert Table(spark, path).log.newest() == before
    from pyspark.sql.types import StructType
    ddl = StructType.fromDDL
    assert merge_schema(ddl("a decimal(10,2), d date"), ddl("a decimal(8,4), d timestamp_ntz")).simpleString() == (
        "struct<a:decimal(12,4),d:timestamp_ntz>")
    for table, load in (("a long", "a double"), ("a string", "a int"), ("a boolean", "a int")):
        with pytest.raises(SchemaConflict):
            merge_schema(ddl(table), ddl(load))


def test_two_appends_at_once_keep_both(spark, scratch, monkeypatch):
    path = scratch("two") + "/t"
    write_append(spark.createDataFrame([(0,)], "v long"), path)
    put, second = CommitLog.put, []

    def late_put(self, number, entry):
        if not second:  # between the first writer's look at the log and its commit
            second.append(1)
            Table(spark, path).append(spark.createDataFrame([(2, "x")], "v long, s string"))
        put(self, number, entry)
    monkeypatch.setattr(CommitLog, "put", late_put)
    Table(spark, path).append(spark.createDataFrame([(1,)], "v long"))
    assert _rows(read_table(spark, path)) == _rows(spark.createDataFrame([(0, None), (1, None), (2, "x")], "v long, s string"))
    # a refresh made from an older commit is refused instead of undoing the other
    by = scratch("two") + "/by"
    table = Table(spark, by)
    rows = spark.createDataFrame([(1, 1), (2, 2)], "v long, m long")
    table.replace(rows, ("m",))
    table.replace_partitions(rows.where("m = 1").withColumn("v", F.lit(9).cast("long")), [(1,)], 0)
    with pytest.raises(CommitConflict):
        table.replace_partitions(rows.where("m = 2"), [(2,)], 0)
    assert _rows(table.read()) == [(2, 2), (9, 1)]


def test_cursor_reads_open_few_folders_however_many_loads(spark, scratch):
    path = scratch("compact") + "/t"
    opened = []
    for day in range(24):
        stamp = dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
        rows = spark.range(day * 10, day * 10 + 10).select(
            "id", F.lit(stamp.isoformat()).alias("updated_at"), F.lit(f"run{day:02d}").alias("_loaded_at"))
        write_append(rows, path, cluster_by=["updated_at"])
        table = Table(spark, path)
        assert table.largest("updated_at") == stamp.isoformat()
        if day >= 5:
            found = table.read_above("updated_at", (stamp - dt.timedelta(days=1)).isoformat())
            assert found.count() == 10
            opened.append(len(found.inputFiles()))
    assert max(opened[10:]) <= max(opened[:10])
    assert len(Table(spark, path).head()[1]["parts"]) <= 17
    assert read_table(spark, path).count() == 240 and read_table(spark, path).select("id").distinct().count() == 240
    # rows appended since a commit are all there after compaction
    mark = Table(spark, path).log.newest()
    write_append(spark.createDataFrame([(1000, "2025-01-01T00:00:00", "z")], "id long, updated_at string, _loaded_at string"),
                 path, cluster_by=["updated_at"])
    assert [r.id for r in Table(spark, path).appended_since(mark).collect()] == [1000]


def test_compaction_by_ranges(spark, scratch):
    path = scratch("ranges") + "/t"
    for i in range(8):
        Table(spark, path).append(spark.range(2000).select(
            F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10**6)).alias("c"), F.lit("x" * 50).alias("s")), stats=["c"])
    size = sum(p["bytes"] for p in Table(spark, path).head()[1]["parts"])
    before = _rows(read_table(spark, path))
    assert Table(spark, path).compact("c", target_bytes=size // 3) is not None
    parts = sorted((p["stats"]["c"] for p in Table(spark, path).head()[1]["parts"]))
    assert len(parts) >= 3 and all(a[1] <= b[0] for a, b in zip(parts, parts[1:]))
    assert _rows(read_table(spark, path)) == before
    high = Table(spark, path).read_above("c", parts[-1][0])
    assert {os.path.dirname(f).rsplit("/", 1)[-1] for f in high.inputFiles()} < {
        p["path"].rsplit("/", 1)[-1] for p in Table(spark, path).head()[1]["parts"]}
    assert Table(spark, path).compact("c", target_bytes=size // 3, least=99) is None


def test_late_rows_arrive_once(spark, scratch):
    spec = TableSpec("vendas", "updated_at")
    seen = [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 5))]
    root = scratch("late")

    def load(rows, stamp, late):
        source = spark.createDataFrame(rows, "id long, updated_at timestamp")
        return ingest_incremental(spark, lambda s: source, root, stamp, (spec,), watermark_on_cursor=True, late=late)["vendas"].rows

    assert load(seen, "2024-01-05T07:00:00", dt.timedelta(days=3)) == 2
    # committed late: behind the watermark, within the overlap; row 4 is beyond it, row 2 has a new version
    seen += [(3, dt.datetime(2024, 1, 4)), (4, dt.datetime(2023, 12, 1)), (2, dt.datetime(2024, 1, 5, 1)), (5, dt.datetime(2024, 1, 5))]
    assert load(seen, "2024-01-06T07:00:00", None) == 1     # without an overlap only what is beyond the watermark
    assert load(seen, "2024-01-07T07:00:00", dt.timedelta(days=3)) == 2
    assert load(seen, "2024-01-08T07:00:00", dt.timedelta(days=3)) == 0
    assert _rows(read_table(spark, f"{root}/erp_vendas").select("id", "updated_at")) == sorted([
        (1, "2024-01-01T00:00:00"), (2, "2024-01-05T00:00:00"), (2, "2024-01-05T01:00:00"), (3, "2024-01-04T00:00:00"),
        (5, "2024-01-05T00:00:00")], key=str)


def test_vacuum_takes_only_what_no_commit_names(spark, scratch):
    path = scratch("vacuum") + "/t"
    table = Table(spark, path)
    table.append(spark.range(3))
    spark.range(5).write.parquet(f"{path}/data-left")
    assert table.vacuum() == [] and table.vacuum(older_than=-1) == ["data-left"]
    assert table.read().count() == 3


def test_plain_folders_still_read(spark, scratch):
    path = scratch("plain") + "/t"
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    spark.range(4).write.parquet(path)
    assert read_table(spark, path).count() == 4 and was_loaded(spark, path) and T.Table(spark, path).log.newest() == -1
