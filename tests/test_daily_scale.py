"""The daily run does its work on large logs once: no copy of a log, no second ranking, sums in whole cents."""

import pytest
from pyspark.sql import functions as F

from tributary.functions.numeric import money, money_of, money_sum
from tributary.plans.erp import ErpBinding, log_state, merge_logs
from tributary.sources.bronze import write_append
from tributary.streaming import upsert as U

ITEM = "id long, venda_id long, produto_id long, quantidade int, preco_unit double, subtotal double, created_at string, _loaded_at string, _source string"


def _item(key, subtotal, stamp):
    return (key, key // 2, 1, 1, subtotal, subtotal, "2024-01-01T00:00:00", stamp, "erp.itens_venda")


@pytest.fixture
def bronze(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for stamp, keys in (("2024-02-01T06:00:00", range(40)), ("2024-02-02T06:00:00", range(30, 50))):
        rows = [_item(k, k + 0.25, stamp) for k in keys] + [_item(7, 99.5, stamp)]
        write_append(spark.createDataFrame(rows, ITEM), f"{root}/erp_itens_venda", cluster_by=["created_at"])
        merge_logs(spark, root)
    return root


def test_stored_rows_are_not_ranked_again(spark, bronze):
    # One bucket layer after another: what the state's own reading has to rank is stored as one layer first.
    state = log_state(spark, bronze, "erp_itens_venda")
    one = U.KeyedState(spark, f"{bronze}/other", state.schema, ["id"], ["_loaded_at"])
    one.merge(state.read())
    binding = ErpBinding(spark, bronze, stored_state=True)
    binding.table = lambda name: (one.read() if name == "erp_itens_venda" else ErpBinding.table(binding, name))
    stored = binding.silver()["stg_erp_itens_venda"]
    assert "Window" not in stored._jdf.queryExecution().optimizedPlan().toString()
    whole = ErpBinding(spark, bronze).silver()["stg_erp_itens_venda"]
    assert "Window" in whole._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, whole.collect()))
    assert stored.count() == 50


def test_a_log_is_merged_without_a_copy(spark, tmp_path, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(U, "scratch_path", lambda spark, *parts: str(scratch))
    root = str(tmp_path / "bronze")
    write_append(spark.createDataFrame([_item(k, 1.0, "2024-02-01T06:00:00") for k in range(9)], ITEM), f"{root}/erp_itens_venda")
    seen = []
    monkeypatch.setattr(U, "input_bytes", lambda spark, paths, f=U.input_bytes: seen.extend(paths) or f(spark, paths))
    merge_logs(spark, root)
    assert log_state(spark, root, "erp_itens_venda").read().count() == 9
    assert seen and not [p for p in seen if p.startswith(str(scratch))]


def test_a_key_with_many_rows_is_reduced_first(spark, tmp_path):
    state = U.KeyedState(spark, str(tmp_path / "state"), spark.createDataFrame([], "k long, v long").schema, ["k"], ["v"])
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    assert state._few_a_key(rows, 5000).count() == 2001
    few = rows.where("v >= 2999")
    assert state._few_a_key(few, 2001).count() == 2001
    state.merge(rows)
    assert state.read().where("k = 1").first()["v"] == 2999


AMOUNTS = [1.005, 0.1 + 0.2, -0.0, -1.25, 2.675, 123456.78, 999999.99, 1e6, 1234567890123.45, 0.005, -0.005, 1e-9, 90071.99]


def test_cents_are_those_of_the_decimal_type(spark):
    df = spark.createDataFrame([(i % 3, x) for i, x in enumerate(AMOUNTS + [i * 0.01 for i in range(3000)])] + [(3, None)], "g int, x double")
    for r in df.groupBy("g").agg(money_sum("x").alias("a"), F.sum(money("x")).cast("double").alias("b")).collect():
        assert r["a"] == r["b"] and (r["a"] is None) == (r["g"] == 3)
    cell = df.select(money_of("x", 18).alias("a"), money("x").alias("b"))
    assert cell.schema["a"].dataType == cell.schema["b"].dataType
    assert cell.where("not (a <=> b)").count() == 0


def test_times_are_written_without_a_pattern_search(spark):
    from tributary.functions.dates import iso_text
    df = spark.sql("select explode(array(timestamp'1969-12-31 23:59:59.5', timestamp'1998-10-03 00:00:00', timestamp'2024-01-01 00:00:07.179575')) t")
    text = df.select(iso_text("t").alias("t"))
    assert "regexp" not in text._jdf.queryExecution().optimizedPlan().toString()
    assert [r["t"] for r in text.collect()] == ["1969-12-31T23:59:59.500000", "1998-10-03T00:00:00", "2024-01-01T00:00:07.179575"]
