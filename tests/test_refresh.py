"""Gold follows what changed: later daily runs equal a full build and leave untouched months alone."""

import datetime as dt
import glob
import os
import random

from pyspark.sql import functions as F

from tributary.plans.daily import DailyRun, run_daily
from tributary.plans.erp import ErpBinding
from tributary.plans.layers import build_gold
from tributary.sources.files import write_csv
from tributary.sources.schemas import ERP_SOURCE
from tributary.storage.tables import Table, read_table

T = dt.datetime


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


class Shop:
    """A small ERP whose sales are cancelled, moved, changed and added from day to day."""

    def __init__(self, spark):
        self.spark, self.rnd, self.extra = spark, random.Random(4), False
        self.sales, self.items, self.products, self.customers = {}, {}, [], []
        for i in range(1, 61):
            self.put(i, T(2024, 1, 1), month=1 + i % 6)

    def put(self, i, now, month=None, status="concluida"):
        rnd = self.rnd
        self.sales[i] = (i, rnd.choice([1, 2, 99]), rnd.choice([1, 2]), T(2023, month or rnd.randrange(1, 7), 1 + i % 28), status,
                         rnd.choice([None, 10, 20, 33]), now, now)
        for j in range(rnd.randrange(3)):
            key = i * 10 + j
            self.items[key] = (key, i, 1, rnd.randrange(1, 4), 5, rnd.choice([5, 10, 15]), now)

    def source(self):
        from decimal import Decimal

        def money(rows, at):
            return [tuple(Decimal(v) if k in at and v is not None else v for k, v in enumerate(r)) for r in rows]
        now = T(2024, 1, 1)
        frames = {
            "lojas": ([(1, "A", "X", "SP", "S", now), (2, "B", "Y", "PR", "S", now)], ()),
            "produtos": ([(1, "S1", "P", "Móveis", 1, 2, now), *self.products], (4, 5)),
            "clientes": ([(1, "Ana", "a@x", "R", "PE", now, now), (2, "Bia", "b@x", "M", "AM", now, now), *self.customers], ()),
            "vendas": (list(self.sales.values()), (5,)), "itens_venda": (list(self.items.values()), (4, 5))}
        out = {k: self.spark.createDataFrame(money(rows, at), ERP_SOURCE[k]) for k, (rows, at) in frames.items()}
        if self.extra:
            out["vendas"] = out["vendas"].withColumn("canal", F.when(F.col("id") > 60, "web"))
        return lambda spec: out[spec.name]


def _files(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root.removeprefix('file:')}/gold/fct_vendas/*/*/*/part-*")}


def _month(path):
    return tuple(x for x in path.split("/") if x.startswith(("ano=", "mes=")))


def test_later_runs_equal_a_full_build(spark, scratch):
    root, shop = scratch("refresh"), Shop(spark)
    write_csv(spark.createDataFrame([(2023, m, s, "Móveis", 50.0) for m in range(1, 8) for s in (1, 2)],
                                    "ano long, mes long, loja_id long, categoria string, meta_valor double"),
              f"{root}/landing/metas_vendas.csv")

    def run(day):
        return run_daily(spark, DailyRun(
            run_date=dt.date(2024, 1, day), bronze_root=f"{root}/bronze", warehouse_root=f"{root}/lake",
            loaded_at=f"2024-01-{day:02d}T07:00:00", erp_source=shop.source(), landing_dir=f"{root}/landing",
            series_url=None, watermark_on_cursor=True))

    fact = Table(spark, f"{root}/lake/gold/fct_vendas")
    run(1)
    for day in (2, 3, 4):
        now = T(2024, 1, day)
        before = _files(f"{root}/lake")
        touched = {("ano=2023", "mes=2")}
        if day == 2:       # cancelled and changed in February; an item alone for a sale of February
            shop.put(1, now, month=2, status="cancelada")
            shop.put(7, now, month=2)
            shop.items[133] = (133, 13, 1, 9, 5, 45, now)
            shop.items[9990] = (9990, 61, 1, 1, 5, 5, now)            # an item before its sale
            shop.products += [(2, "S1", "Q", "Móveis", 1, 2, now)]    # a second product of that SKU
        elif day == 3:     # from March to February, the last sales of a month go, a new column
            shop.put(8, now, month=2)
            for i in [i for i, s in shop.sales.items() if s[3].month == 6]:
                shop.put(i, now, month=6, status="cancelada")
            shop.extra = True
            shop.put(61, now, month=2)
            shop.customers.append((99, "Caio", "c@x", "R", "PE", now, now))  # a customer after its sales
            shop.products += [(3, "S3", "R", "Móveis", 1, 2, now)]
            touched |= {("ano=2023", "mes=3"), ("ano=2023", "mes=6")}
        moved = {("ano=2023", f"mes={s[3].month}") for i, s in shop.sales.items() if i in (1, 7, 8, 13)}
        build = run(day)
        assert fact.head()[1]["op"] == "partitions"
        after = _files(f"{root}/lake")
        kept = {f: t for f, t in before.items() if _month(f) not in touched | moved}
        assert kept and kept.items() <= after.items()
        if day == 4:       # nothing changed: no file of the fact either
            assert after == before
        if day == 3:
            continue   # the fourth run's tables are the third's
        whole = build_gold(ErpBinding(spark, f"{root}/bronze"), f"{root}/whole{day}", marts=True, checks=True).gold
        assert set(build.gold) == set(whole)
        for name, df in whole.items():
            assert _sorted(build.gold[name]) == _sorted(df), (day, name)
    # the column that came on the third day is in bronze, state and silver
    assert {r.canal for r in read_table(spark, f"{root}/bronze/erp_vendas").select("canal").collect()} == {None, "web"}
    silver = ErpBinding(spark, f"{root}/bronze", stored_state=True).silver()["stg_erp_vendas"]
    assert {(r.venda_id, r.canal) for r in silver.where("canal is not null").collect()} == {(61, "web")}
    # the catalog follows the pointer
    assert spark.sql("select count(*) from gold.fct_vendas").first()[0] == build.gold["fct_vendas"].count()
    assert spark.sql("select count(*) from gold.fct_vendas where mes = 6").first()[0] == 0
    assert _sorted(spark.table("gold.vendas_vs_meta_mensal")) == _sorted(build.gold["vendas_vs_meta_mensal"])


def test_a_run_lost_between_fact_and_sums_is_made_good(spark, scratch, monkeypatch):
    import pytest
    from tributary.streaming.sums import MaintainedSums
    root, shop = scratch("lost"), Shop(spark)

    def run(day):
        return run_daily(spark, DailyRun(
            run_date=dt.date(2024, 1, day), bronze_root=f"{root}/bronze", warehouse_root=f"{root}/lake",
            loaded_at=f"2024-01-{day:02d}T07:00:00", erp_source=shop.source(), watermark_on_cursor=True, register=False, checks=False))
    run(1)
    shop.put(3, T(2024, 1, 2), month=4)
    shop.put(99, T(2024, 1, 2), month=4)

    class Lost(BaseException):
        pass

    def stop(*a, **k):
        raise Lost
    with monkeypatch.context() as m:
        m.setattr(MaintainedSums, "apply", stop)
        with pytest.raises(Lost):
            run(2)
    build = run(3)
    whole = build_gold(ErpBinding(spark, f"{root}/bronze"), f"{root}/whole", marts=True).gold
    for name, df in whole.items():
        assert _sorted(build.gold[name]) == _sorted(df), name
