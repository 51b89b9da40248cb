"""Physical plan properties of the registered queries."""

import pytest

import __spark_entry__ as entry
from tributary.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
# Queries that write intermediate tables when called; their plans are
# checked through the operators they use.
WRITES = {"csv_roundtrip", "rest_series_source", "bronze_append", "layered_build",
          "incremental_upsert", "stream_upsert", "partition_refresh", "daily_run", "csv_rejects", "daily_indicators"}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cartesian_no_python_udf(spark, name):
    text = plan_text(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython"):
        assert bad not in text, f"{name}: {bad}"


def test_cursor_filter_reaches_scan(spark):
    df = entry.queries()["incremental_extract"](spark, SF)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan_text(df)


def test_dedup_limits_before_shuffle(spark):
    text = plan_text(entry.queries()["latest_version"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scan_reads_only_needed_columns(spark):
    text = plan_text(entry.queries()["sales_vs_target_monthly"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double," \
           "l_shipdate:" in text
    assert "l_comment" not in text and "l_discount" not in text


def _shuffle_records(df):
    """Run ``df``'s own plan and return the records written by its exchanges."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()

    def walk(node, acc):
        if "Exchange" in node.nodeName() and "Broadcast" not in node.nodeName():
            acc.append(node.metrics().apply("shuffleRecordsWritten").value())
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next(), acc)
        return acc
    return walk(qe.executedPlan(), [])


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _hot_log(spark):
    from pyspark.sql import functions as F
    # a third of 90,000 rows share key 0; 6 map tasks
    return spark.range(0, 90000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"))


def test_hot_key_dedup_shuffles_one_row_per_map_task(spark, no_aqe):
    from tributary.operators import latest_version
    out = latest_version(_hot_log(spark), ["k"], ["ts"])
    assert _shuffle_records(out) == [60000 + 6]


def test_hot_group_is_pre_aggregated(spark, no_aqe):
    from tributary.operators import unique_violations
    out = unique_violations(_hot_log(spark), ["k"])
    assert _shuffle_records(out) == [60000 + 6]
    assert [tuple(r) for r in out.collect()] == [(0, 30000)]


def test_size_shuffle_partitions(spark):
    from tributary.session import size_shuffle_partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = size_shuffle_partitions(spark, [f"{SF}/lineitem.parquet"], target_bytes=1 << 10)
        assert n > spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
