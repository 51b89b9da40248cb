"""Two daily runs of the whole pipeline on handwritten sources.

Edge rows (FIXTURES.md): a completed sale cancelled the next day (B1), a
sale without items (B8), a zero target and a target month without sales
(B7), a monthly series date without daily rows (B4), decimal commas (B15),
a missing landing file (B17), incremental appends and empty extractions.
"""

import datetime as dt
import json
from decimal import Decimal as Dec

from pyspark.sql import functions as F

from tributary.plans.daily import DailyRun, run_daily
from tributary.sources.files import write_csv
from tributary.sources.schemas import ERP_SOURCE
from tributary.storage.tables import read_table

T = dt.datetime


def _sources(spark, day2: bool):
    t0 = T(2024, 1, 1, 9)
    vendas = [(1, 1, 1, T(2024, 1, 10, 10), "concluida", Dec("60.00"), t0, T(2024, 1, 10, 10)),
              (2, 2, 2, T(2024, 1, 11, 11), "concluida", Dec("30.00"), t0, T(2024, 1, 11, 11)),
              (3, 1, 1, T(2024, 1, 12, 12), "cancelada", Dec("30.00"), t0, T(2024, 1, 12, 12))]
    itens = [(1, 1, 1, 2, Dec("30.00"), Dec("60.00"), t0),
             (2, 3, 2, 1, Dec("30.00"), Dec("30.00"), t0),
             (9, 99, 1, 1, Dec("30.00"), Dec("30.00"), t0)]      # unknown sale
    if day2:
        vendas[0] = vendas[0][:4] + ("cancelada",) + vendas[0][5:7] + (T(2024, 1, 31, 12),)
        vendas.append((4, 2, 2, T(2024, 1, 31, 15), "concluida", Dec("10.00"),
                       T(2024, 1, 31, 15), T(2024, 1, 31, 15)))
        itens.append((3, 4, 2, 1, Dec("10.00"), Dec("10.00"), T(2024, 1, 31, 15)))
    rows = {
        "lojas": [(1, "Loja Centro", "São Paulo", "SP", "Sudeste", t0),
                  (2, "Loja Sul", "Curitiba", "PR", "Sul", t0)],
        "produtos": [(1, "SKU0001", "Produto 1", "Móveis", Dec("20.00"), Dec("30.00"), t0),
                     (2, "SKU0002", "Produto 2", "Esportes", Dec("9.00"), Dec("10.00"), t0),
                     (3, "SKU0001", "Produto 3", "Móveis", Dec("5.00"), Dec("8.00"), t0)],
        "clientes": [(1, "Ana", "ana@example.com", "Recife", "PE", t0, t0),
                     (2, "Bruno", "bruno@example.com", "Manaus", "AM", t0, t0)],
        "vendas": vendas,
        "itens_venda": itens,
    }
    frames = {k: spark.createDataFrame(v, ERP_SOURCE[k]) for k, v in rows.items()}
    return lambda spec: frames[spec.name]


def _series_api(tmp_path):
    api = tmp_path / "api"
    api.mkdir()
    payloads = {1: [{"data": "10/01/2024", "valor": "4,90"}, {"data": "11/01/2024", "valor": "4,95"}],
                11: [{"data": "10/01/2024", "valor": "0,04"}, {"data": "12/01/2024", "valor": "0,05"}],
                433: [{"data": "01/12/2023", "valor": "0,56"}]}
    for code, rows in payloads.items():
        (api / f"s{code}.json").write_text(json.dumps(rows))
    return f"file://{api}/s{{code}}.json"


def _rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_two_daily_runs(spark, scratch, tmp_path):
    root = scratch("pipeline")
    landing = f"{root}/landing"
    targets = spark.createDataFrame(
        [(2024, 1, 1, "Móveis", 100.0), (2024, 1, 1, "Esportes", 20.0),
         (2024, 1, 2, "Móveis", 0.0), (2024, 2, 1, "Móveis", 50.0)],
        "ano long, mes long, loja_id long, categoria string, meta_valor double")
    write_csv(targets, f"{landing}/metas_vendas.csv")   # lojas.csv never lands
    url = _series_api(tmp_path)

    def run(day, stamp, day2):
        return run_daily(spark, DailyRun(
            run_date=day, bronze_root=f"{root}/bronze", warehouse_root=f"{root}/gold_{day2}",
            loaded_at=stamp, erp_source=_sources(spark, day2), landing_dir=landing,
            series_url=url))

    first = run(dt.date(2024, 1, 31), "2024-01-31T07:00:00", False).gold
    fact = first["fct_vendas"]
    assert _rows(fact.select("venda_id", "loja_id", "ano", "mes", "total", "total_itens",
                             "total_quantidade", "qtd_itens"), "venda_id") == [
        (1, 1, 2024, 1, 60.0, 60.0, 2, 1),
        (2, 2, 2024, 1, 30.0, None, None, None)]          # B8: no items -> NULLs
    assert _rows(first["vendas_vs_meta_mensal"], "ano", "mes", "loja_id") == [
        (2024, 1, 1, 60.0, 120.0, 50.0),
        (2024, 1, 2, 30.0, 0.0, None),                   # B7: zero target
        (2024, 2, 1, None, 50.0, None)]                  # target without sales
    ind = _rows(first["fct_indicadores_economicos"], F.col("data").asc_nulls_first())
    assert ind == [(None, None, None, 0.56),             # B4: monthly-only date
                   (dt.date(2024, 1, 10), 4.9, 0.04, None),
                   (dt.date(2024, 1, 11), 4.95, None, None),
                   (dt.date(2024, 1, 12), None, 0.05, None)]
    assert first["dim_calendario"].count() == 1096
    # data-quality tables: duplicate SKU, item of an unknown sale
    assert _rows(first["dq_sku_duplicado"]) == [("SKU0001", 2)]
    assert [r.item_id for r in first["dq_itens_sem_venda"].collect()] == [9]
    assert first["dq_venda_duplicada"].count() == 0
    assert first["dq_vendas_sem_cliente"].count() == 0
    # gold tables are in the catalog (partitioned fact included)
    assert spark.sql("select count(*) from gold.fct_vendas where mes = 1").first()[0] == 2
    # dashboard marts
    assert _rows(first["kpi_visao_geral"]) == [(90.0, 2, 45.0, 170.0, 52.94)]
    assert _rows(first["vendas_vs_dolar_mensal"]) == [(2024, 1, 90.0, 2, 4.925)]
    assert _rows(first["ranking_lojas"].select("ano", "mes", "loja_id", "posicao"),
                 "ano", "mes", "posicao", "loja_id") == [
        (2024, 1, 1, 1), (2024, 1, 2, 2), (2024, 2, 1, 1)]
    assert first["dim_loja"].count() == 2 and first["dim_cliente"].count() == 2

    second = run(dt.date(2024, 2, 1), "2024-02-01T07:00:00", True).gold
    # B1: sale 1's newest version is cancelled -> gone; sale 4 arrived
    assert _rows(second["fct_vendas"].select("venda_id", "total_itens"), "venda_id") == [
        (2, None), (4, 10.0)]
    # the stored state holds the newest version per sale; a full pass over the log agrees
    from tributary.plans.erp import ErpBinding, log_state
    state = log_state(spark, f"{root}/bronze", "erp_vendas")
    assert state.content_version() == 1 and state.read().count() == 4
    for name in ("stg_erp_vendas", "stg_erp_itens_venda", "stg_erp_clientes"):
        whole, stored = (ErpBinding(spark, f"{root}/bronze", stored_state=s).silver()[name] for s in (False, True))
        assert sorted(map(str, whole.collect())) == sorted(map(str, stored.collect()))
    bronze = read_table(spark, f"{root}/bronze/erp_vendas")
    assert bronze.count() == 5                            # 3 + 2 appended versions
    assert read_table(spark, f"{root}/bronze/erp_clientes").count() == 2  # nothing new
    assert sorted(r[0] for r in bronze.select("_loaded_at").distinct().collect()) == [
        "2024-01-31T07:00:00", "2024-02-01T07:00:00"]
    # the command line rebuilds silver and gold from the bronze tables present
    from tributary.__main__ import main
    assert main(["--bronze", f"{root}/bronze", "--warehouse", f"{root}/gold_cli"]) == 0
    cli_fact = read_table(spark, f"{root}/gold_cli/gold/fct_vendas")
    assert sorted(r.venda_id for r in cli_fact.collect()) == [2, 4]
    # the corrected key mode keeps the monthly-only date
    from tributary.plans.erp import ErpBinding
    aligned = ErpBinding(spark, f"{root}/bronze", key_mode="all").indicators()
    assert _rows(aligned.where(F.col("ipca").isNotNull()).select("data", "ipca")) == [
        (dt.date(2023, 12, 1), 0.56)]


def test_first_run_with_sources_missing(spark, scratch):
    from tributary.plans.erp import ErpBinding
    from tributary.plans.layers import build_gold
    root = scratch("empty")
    gold = build_gold(ErpBinding(spark, f"{root}/bronze"), f"{root}/gold", marts=True).gold
    assert gold["fct_vendas"].count() == 0 and gold["vendas_vs_meta_mensal"].count() == 0
    assert gold["dim_calendario"].count() == 1096
    assert [tuple(r) for r in gold["kpi_visao_geral"].collect()] == [(None, 0, None, None, None)]


def test_daily_run_with_default_settings_and_no_source(spark, scratch):
    root = scratch("nothing")
    gold = run_daily(spark, DailyRun(run_date=dt.date(2024, 1, 31), bronze_root=f"{root}/bronze",
                                     warehouse_root=f"{root}/gold")).gold
    assert gold["fct_vendas"].count() == 0
    assert spark.sql("select count(*) from gold.fct_vendas").first()[0] == 0


def test_calendar_covers_later_sales(spark, scratch):
    from tributary.plans.erp import ErpBinding
    from tributary.sources.schemas import BRONZE
    root = scratch("late")
    empty = spark.createDataFrame([], BRONZE["erp_vendas"])
    row = empty.unionByName(spark.createDataFrame([("2027-03-04T10:00:00",)], "data_venda string"),
                            allowMissingColumns=True)
    row.write.parquet(f"{root}/bronze/erp_vendas")
    days = ErpBinding(spark, f"{root}/bronze").calendar()
    assert [str(x) for x in days.selectExpr("min(data)", "max(data)").first()] == ["2023-01-01", "2027-03-04"]
    assert ErpBinding(spark, f"{root}/bronze", calendar_covers_sales=False).calendar().count() == 1096
