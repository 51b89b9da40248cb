"""Data-quality tables for the silver layer.

The source database declared primary keys, a unique SKU and foreign keys;
the lake keeps every row and reports violations instead of rejecting them.
Each check is a grouped count or an anti join, so it scales like the data; with
stored states later runs look only at the keys that changed (``streaming.checks``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.checks import orphan_rows, unique_violations
from tributary.operators.staging import ITEMS_SPEC, SALES_SPEC, project
from tributary.storage.tables import Table
from tributary.streaming.checks import OrphanCheck, UniqueCheck
from tributary.streaming.upsert import within

# Table -> the sources whose versions it is made from.
CHECKS = {
    "dq_sku_duplicado": ["erp_produtos"],
    "dq_venda_duplicada": ["erp_vendas"],
    "dq_itens_sem_venda": ["erp_itens_venda", "erp_vendas"],
    "dq_vendas_sem_cliente": ["erp_vendas", "erp_clientes"],
    "dq_vendas_sem_loja": ["erp_vendas", "erp_lojas"],
}
# Check of rows that name no parent -> (key of the row, its foreign key).
ORPHANS = {"dq_itens_sem_venda": ("item_id", "venda_id"), "dq_vendas_sem_cliente": ("venda_id", "cliente_id"),
           "dq_vendas_sem_loja": ("venda_id", "loja_id")}
# Check of keys that occur twice -> the key.
DUPLICATES = {"dq_sku_duplicado": ["sku"], "dq_venda_duplicada": ["venda_id"]}


def quality_checks(silver: dict[str, DataFrame], sale_ids: DataFrame) -> dict[str, DataFrame]:
    """Violation tables; ``sale_ids`` holds every sale id of the log (``venda_id``),
    cancelled ones included, since silver keeps completed sales only."""
    sales, items = silver["stg_erp_vendas"], silver["stg_erp_itens_venda"]
    return {
        # UNIQUE (sku)
        "dq_sku_duplicado": unique_violations(silver["stg_erp_produtos"], ["sku"]),
        # PRIMARY KEY: silver keeps one row per key; a second one is a bug upstream
        "dq_venda_duplicada": unique_violations(sales, ["venda_id"]),
        # FOREIGN KEYs
        "dq_itens_sem_venda": orphan_rows(items, sale_ids, "venda_id"),
        "dq_vendas_sem_cliente": orphan_rows(sales, silver["stg_erp_clientes"], "cliente_id"),
        "dq_vendas_sem_loja": orphan_rows(sales, silver["stg_erp_lojas"], "loja_id"),
    }


def _unique(binding, path, name: str) -> UniqueCheck:
    return UniqueCheck(binding.spark, path(name), path(f"_contagens_{name}"), DUPLICATES[name])


def _orphans(binding, path, name: str) -> OrphanCheck:
    return OrphanCheck(binding.spark, path(name), *ORPHANS[name])


def refresh_checks(binding, silver: dict[str, DataFrame], path, threads: int = 4) -> None:
    """Bring the stored checks up to date; ``path(name)`` is where each lies.

    Checks that were never stored, or whose changes are not known any more, are
    made whole; those whose sources are unchanged are left as they are.
    """
    sources = binding.sources()

    def one(name: str) -> None:
        needs = CHECKS[name]
        meta = {s: sources[s] for s in needs if s in sources}
        entry = Table(binding.spark, path(name)).head()[1]
        if entry is not None and entry["meta"] == meta:
            return
        feeds = None
        if entry is not None and set(entry["meta"]) == set(meta) == set(needs):
            feeds = {s: binding.changes_of(s, entry["meta"][s]) for s in needs}
        if feeds is None or any(f is None for f in feeds.values()):
            _whole(binding, silver, path, name, meta)
        else:
            _changed(binding, path, name, feeds, meta)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        list(pool.map(one, CHECKS))


def _whole(binding, silver: dict[str, DataFrame], path, name: str, meta: dict) -> None:
    tables = {"dq_sku_duplicado": "stg_erp_produtos", "dq_venda_duplicada": "stg_erp_vendas",
              "dq_itens_sem_venda": "stg_erp_itens_venda"}
    rows = silver[tables.get(name, "stg_erp_vendas")]
    if name == "dq_venda_duplicada":
        Table(binding.spark, path(name)).replace(unique_violations(rows, DUPLICATES[name]), meta=meta)
        return
    if name in DUPLICATES:
        _unique(binding, path, name).rebuild(rows, meta)
        return
    parents = {"dq_itens_sem_venda": binding.sale_ids(), "dq_vendas_sem_cliente": silver["stg_erp_clientes"],
               "dq_vendas_sem_loja": silver["stg_erp_lojas"]}[name]
    _orphans(binding, path, name).rebuild(rows, parents, meta)


def _changed(binding, path, name: str, feeds: dict[str, DataFrame], meta: dict) -> None:
    """``feeds``: per source the changed rows, columns ``old`` and ``new``."""
    def side(source: str, which: str) -> DataFrame:
        return feeds[source].where(F.col(which).isNotNull()).select(f"{which}.*")

    def completed(rows: DataFrame) -> DataFrame:
        return project(rows.where(F.col("status") == F.lit(binding.completed)), binding.spec_of("erp_vendas", SALES_SPEC))

    if name == "dq_sku_duplicado":
        _unique(binding, path, name).apply(side("erp_produtos", "old"), side("erp_produtos", "new"), meta)
        return
    if name == "dq_venda_duplicada":
        # All rows of a changed key are looked up, so no counts are kept.
        changed = feeds["erp_vendas"].select(F.col("id").alias("venda_id"))
        now = completed(binding.rows_now("erp_vendas", feeds["erp_vendas"].select("id")))
        table = Table(binding.spark, path(name))
        found = unique_violations(now, DUPLICATES[name])
        table.replace(within(table.read(), changed, DUPLICATES[name], "left_anti").unionByName(found), meta=meta)
        return
    check = _orphans(binding, path, name)
    if name == "dq_itens_sem_venda":
        changed = feeds["erp_itens_venda"].select(F.col("id").alias("item_id"))
        came = project(side("erp_itens_venda", "new"), binding.spec_of("erp_itens_venda", ITEMS_SPEC))
        parent, fk = "erp_vendas", "venda_id"
    else:
        changed = feeds["erp_vendas"].select(F.col("id").alias("venda_id"))
        came = completed(side("erp_vendas", "new"))
        parent, fk = ("erp_clientes", "cliente_id") if name == "dq_vendas_sem_cliente" else ("erp_lojas", "loja_id")
    arrived = feeds[parent].where(F.col("old").isNull()).select(F.col("id").alias(fk))

    def parents_of(keys: DataFrame) -> DataFrame:
        return binding.known_ids(parent, keys.select(F.col(fk).alias("id"))).select(F.col("id").alias(fk))
    check.apply(changed, came, parents_of, arrived, meta)
