"""Operator semantics on handwritten rows (one test per behaviour)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.functions import (coerce_kind, comma_decimal, iso_text, parse_series_date,
                                 safe_ratio_pct)
from tributary.operators import (align_series, attainment, calendar, conform_dimension,
                                 latest_version, orphan_rows, sales_fact, stage_sales,
                                 stage_targets, target_plan, unique_violations)
from tributary.plans.layers import layer_table

D = dt.date
TS = dt.datetime


def rows(df, order=None):
    df = df.orderBy(*order) if order else df
    return [tuple(r) for r in df.collect()]


def test_dedup_before_status_filter(spark):
    # Sale 1: completed first, cancelled later -> disappears.  Sale 2: the
    # other way round -> kept.
    log = spark.createDataFrame([
        (1, 10, TS(2024, 1, 1), "concluida", 5.0, TS(2024, 1, 1), "2024-01-01T07:00:00"),
        (1, 10, TS(2024, 1, 1), "cancelada", 5.0, TS(2024, 1, 2), "2024-01-02T07:00:00"),
        (2, 11, TS(2024, 1, 3), "cancelada", 7.0, TS(2024, 1, 3), "2024-01-03T07:00:00"),
        (2, 11, TS(2024, 1, 3), "concluida", 7.0, TS(2024, 1, 4), "2024-01-04T07:00:00"),
    ], "id long, cliente_id long, data_venda timestamp, status string, total double, "
       "updated_at timestamp, _loaded_at string")
    out = stage_sales(log)
    assert [r.venda_id for r in out.collect()] == [2]
    assert out.columns == ["venda_id", "cliente_id", "data_venda", "data_venda_date",
                           "status", "total", "updated_at"]


def test_latest_version_tie_is_deterministic(spark):
    log = spark.createDataFrame([(1, "t", "b"), (1, "t", "a"), (2, "t", "z")],
                                "id long, _loaded_at string, v string")
    assert rows(latest_version(log, ["id"]), ["id"]) == [(1, "t", "a"), (2, "t", "z")]


def test_conform_dimension_one_row_per_key(spark):
    stores = spark.createDataFrame([(1, "B"), (1, "A"), (2, None), (2, "C")],
                                   "loja_id long, loja_nome string")
    assert rows(conform_dimension(stores, "loja_id"), ["loja_id"]) == [(1, "A"), (2, None)]


def test_align_series_key_modes(spark):
    d = spark.createDataFrame([(D(2024, 1, 2), 5.0)], "data date, dolar double")
    s = spark.createDataFrame([(D(2024, 1, 2), 0.1), (D(2024, 1, 3), 0.2)],
                              "data date, selic double")
    i = spark.createDataFrame([(D(2023, 12, 1), 0.5)], "data date, ipca double")
    faithful = rows(align_series([(d, "dolar"), (s, "selic"), (i, "ipca")]),
                    [F.col("data").asc_nulls_first()])
    assert faithful == [(None, None, None, 0.5), (D(2024, 1, 2), 5.0, 0.1, None),
                        (D(2024, 1, 3), None, 0.2, None)]
    all_keys = rows(align_series([(d, "dolar"), (s, "selic"), (i, "ipca")], "all"), ["data"])
    assert all_keys[0] == (D(2023, 12, 1), None, None, 0.5)


def test_attainment_null_keys_zero_and_missing_targets(spark):
    sales = spark.createDataFrame([(2024, 1, 1, 100.0), (2024, 1, None, 50.0),
                                   (2024, 2, 1, 30.0)],
                                  "ano long, mes long, loja_id long, total double")
    targets = spark.createDataFrame([(2024, 1, 1, 200.0), (2024, 1, None, 10.0),
                                     (2024, 2, 1, 0.0), (2024, 3, 1, 5.0)],
                                    "ano long, mes long, loja_id long, meta_valor double")
    out = rows(attainment(sales, targets),
               [F.col("mes"), F.col("loja_id").asc_nulls_first(),
                F.col("total_vendas").asc_nulls_first()])
    assert out == [
        (2024, 1, None, None, 10.0, None),   # NULL keys never match
        (2024, 1, None, 50.0, None, None),
        (2024, 1, 1, 100.0, 200.0, 50.0),
        (2024, 2, 1, 30.0, 0.0, None),       # zero target -> NULL, no error
        (2024, 3, 1, None, 5.0, None),       # target without sales
    ]


def test_sale_without_items_keeps_null_measures(spark):
    sales = spark.createDataFrame([(1, 7, 3, D(2024, 5, 2), "F", 9.5),
                                   (2, 7, 3, D(2024, 5, 3), "F", 1.0)],
                                  "venda_id long, cliente_id long, loja_id long, "
                                  "data_venda_date date, status string, total double")
    items = spark.createDataFrame([(1, 2, 4.25), (1, 1, 5.25)],
                                  "venda_id long, quantidade long, subtotal double")
    out = rows(sales_fact(sales, items), ["venda_id"])
    assert out[0][-3:] == (9.5, 3, 2)
    assert out[1][-3:] == (None, None, None)
    assert out[0][4:6] == (2024, 5)


def test_sunday_week_matches_strftime_over_three_years(spark):
    cal = calendar(spark)
    got = {r.data: (r.semana, r.mes_nome, r.dia_semana, r.fim_de_semana)
           for r in cal.collect()}
    assert len(got) == 1096
    for d, (week, mname, dname, weekend) in got.items():
        assert week == int(d.strftime("%U"))
        assert mname == d.strftime("%B") and dname == d.strftime("%A")
        assert weekend == (d.weekday() >= 5)


def test_series_date_and_decimal_comma(spark):
    df = spark.createDataFrame([("1/2/2023", "5,25"), ("01/02/2023", "4.5")], "d string, v string")
    out = df.select(parse_series_date("d").alias("d"), comma_decimal("v").alias("v")).collect()
    assert [tuple(r) for r in out] == [(D(2023, 2, 1), 5.25), (D(2023, 2, 1), 4.5)]
    bad = spark.createDataFrame([("31/02/2023", "x")], "d string, v string")
    assert bad.select(parse_series_date("d", permissive=True)).first()[0] is None
    assert bad.select(comma_decimal("v", permissive=True)).first()[0] is None
    with pytest.raises(Exception):
        bad.select(parse_series_date("d")).collect()
    with pytest.raises(Exception):
        bad.select(comma_decimal("v")).collect()


def test_iso_text_omits_zero_fraction(spark):
    df = spark.createDataFrame([(TS(1998, 10, 3),), (TS(2024, 1, 1, 0, 0, 7, 179575),)],
                               "ts timestamp")
    assert [r[0] for r in df.select(iso_text("ts")).collect()] == [
        "1998-10-03T00:00:00", "2024-01-01T00:00:07.179575"]


def test_coerce_kind(spark):
    df = spark.createDataFrame([(" 12 ",), ("1.5",), ("1e3",), ("abc",), (None,), ("-4",), ("5D",),
                                ("12f",), (".5",), ("1.",), ("inf",)], "v string")
    assert [r[0] for r in df.select(coerce_kind("v")).collect()] == [
        "int", "float", "float", "string", None, "int", "string", "string", "float", "float", "float"]


def test_safe_ratio_pct(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (None, 2.0), (2.0, None)],
                               "a double, b double")
    assert [r[0] for r in df.select(safe_ratio_pct("a", "b")).collect()] == [
        33.33, None, None, None]


def test_stage_targets_month_start(spark):
    df = spark.createDataFrame([(2024, 2, 3, "Moveis", 10)],
                               "ano int, mes int, loja_id int, categoria string, meta_valor int")
    r = stage_targets(df).first()
    assert r.data_mes == D(2024, 2, 1) and r.meta_valor == 10.0


def test_target_plan_rule(spark):
    keys = (spark.range(1)
            .select(F.explode(F.sequence(F.lit(2023), F.lit(2025))).alias("ano"))
            .select("ano", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes"))
            .select("ano", "mes", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("loja_id"))
            .select("ano", "mes", "loja_id",
                    F.explode(F.array(*[F.lit(c) for c in "ABCDE"])).alias("categoria")))
    plan = target_plan(keys, 2023)
    assert plan.count() == 1800
    got = {(r.ano, r.mes): r.meta_valor for r in plan.collect()}
    for (ano, mes), v in got.items():
        f = 1.4 if mes in (11, 12) else (0.85 if mes in (1, 2) else 1.0)
        assert v == pytest.approx(round(15000 * 1.05 ** (ano - 2023) * f, 2), abs=1e-9)


def test_quality_checks(spark):
    items = spark.createDataFrame([(1, 10), (1, 10), (2, 99), (3, None)],
                                  "id long, venda_id long")
    sales = spark.createDataFrame([(10,)], "venda_id long")
    assert rows(unique_violations(items, ["id", "venda_id"])) == [(1, 10, 2)]
    assert rows(orphan_rows(items, sales, "venda_id")) == [(2, 99)]


def test_layer_table_name():
    assert layer_table(" gold ", "fct_vendas") == "gold.fct_vendas"
    assert layer_table(None, "x") == "gold.x"


def test_align_series_long_equals_join_chain(spark):
    from tributary.operators import align_series_long
    rows = [("dolar", D(2024, 1, 2), 5.0), ("selic", D(2024, 1, 2), 0.1),
            ("selic", D(2024, 1, 3), 0.2), ("ipca", D(2023, 12, 1), 0.5),
            ("ipca", D(2024, 1, 3), 0.7), ("dolar", None, 9.0), ("ipca", None, 8.0),
            ("other", D(2024, 1, 2), 1.0)]
    long = spark.createDataFrame(rows, "serie string, data date, valor double")
    names = ["dolar", "selic", "ipca"]
    parts = [(long.where(F.col("serie") == n).select("data", F.col("valor").alias(n)), n)
             for n in names]
    key = lambda r: tuple((v is None, v) for v in r)
    for mode in ("first_two", "all"):
        want = sorted(map(tuple, align_series(parts, mode).collect()), key=key)
        got = sorted(map(tuple, align_series_long(long, names, mode).collect()), key=key)
        assert got == want, mode
