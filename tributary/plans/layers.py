"""Layered build: silver as lazy views, gold as materialized Parquet tables.

Silver models stay lazy (``createOrReplaceTempView``), so gold queries are
optimized end to end through them.  Gold models are rebuilt in dependency
order and written under ``<root>/<layer>/<model>``; later gold models read
the *stored* upstream tables, which also cuts the lineage between stages
(a lost executor recomputes from the last written table, not from bronze).
Facts are partitioned by year and month, so readers prune partitions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tributary.operators.facts import (ATTAINMENT_KEYS, FACT_COLUMNS, attainment_of_sums, sums_as_sales)
from tributary.operators.marts import kpi_of_detail, months_of_sums, months_vs_indicator, store_ranking
from tributary.plans.quality import CHECKS, quality_checks, refresh_checks
from tributary.storage.tables import NULL_PARTITION, Table, partition_values
from tributary.streaming.sums import MaintainedSums
from tributary.streaming.upsert import refresh_partitions

SILVER, GOLD, QUALITY = "silver", "gold", "quality"
FACT_PARTITIONS = ("ano", "mes")


def layer_table(layer: str | None, name: str, default: str = GOLD) -> str:
    """Qualified ``<layer>.<name>``: a configured layer name is used verbatim
    after trimming; without one the default layer applies."""
    schema = default if layer is None else layer.strip()
    return f"{schema}.{name}"


def layer_path(root: str, layer: str, name: str) -> str:
    return "/".join([root.rstrip("/"), *layer_table(layer, name).split(".")])


def view_name(layer: str, name: str) -> str:
    """Temp views cannot be database-qualified; the layer becomes a prefix."""
    return layer_table(layer, name).replace(".", "__")


def publish_view(df: DataFrame, layer: str, name: str) -> DataFrame:
    """Register ``df`` as the (lazy) view of a model."""
    df.createOrReplaceTempView(view_name(layer, name))
    return df


def _fields(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_table(spark, layer: str, name: str, path: str, schema: StructType,
                   partition_by: tuple[str, ...] = ()) -> str:
    """Point the external table ``<layer>.<name>`` at the folders of the newest commit.

    The catalog holds places only (dropping the table never deletes data).  A
    known table gets its new place in one statement, a partitioned one the
    places of the partitions that changed; only a new schema makes it anew.
    """
    qualified = layer_table(layer, name)
    schema_name = qualified.split(".")[0]
    # The database's own folder is the layer folder: nothing is written to
    # the session's default warehouse directory.
    layer_root = path.rsplit("/", 1)[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema_name}` LOCATION '{layer_root}'")
    quoted = f"`{schema_name}`.`{name}`"
    parts = Table(spark, path).head()[1]["parts"]
    # A table without rows has no folder; the log's is none that a scan reads from.
    place = f"{path}/{parts[0]['path']}" if parts and not partition_by else f"{path}/_log/none"
    known = spark.catalog.tableExists(qualified) and [
        (f.name, f.dataType) for f in spark.table(qualified).schema.fields] == [
        (f.name, f.dataType) for f in schema.fields if f.name not in partition_by] + [
        (f.name, f.dataType) for f in schema.fields if f.name in partition_by]
    if known and not partition_by:
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{place}'")
        spark.catalog.refreshTable(qualified)
        return qualified
    if not known:
        spark.sql(f"DROP TABLE IF EXISTS {quoted}")
        by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {quoted} ({_fields(schema)}) USING parquet{by} LOCATION '{place}'")
    if partition_by:
        _register_partitions(spark, quoted, path, parts, partition_by)
    spark.catalog.refreshTable(qualified)
    return qualified


def _register_partitions(spark, quoted: str, path: str, parts: list[dict], by: tuple[str, ...]) -> None:
    def clause(values: tuple[str, ...]) -> str:
        return "PARTITION (" + ", ".join(
            f"`{c}`=NULL" if v == NULL_PARTITION else f"`{c}`='{v}'" for c, v in zip(by, values)) + ")"

    now: dict[tuple[str, ...], str] = {partition_values(p["path"]): p["path"] for p in parts}
    had = {tuple(x.split("=", 1)[1] for x in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {quoted}").collect()}
    if gone := had - set(now):
        spark.sql(f"ALTER TABLE {quoted} DROP IF EXISTS " + ", ".join(clause(v) for v in sorted(gone)))
    for values in sorted(set(now) & had):
        spark.sql(f"ALTER TABLE {quoted} {clause(values)} SET LOCATION '{path}/{now[values]}'")
    if fresh := sorted(set(now) - had):
        spark.sql(f"ALTER TABLE {quoted} ADD " + " ".join(f"{clause(v)} LOCATION '{path}/{now[v]}'" for v in fresh))


def stored_model(spark, root: str, layer: str, name: str, register: bool = False) -> DataFrame:
    """The newest commit of a model, published as its view (and in the catalog)."""
    table = Table(spark, layer_path(root, layer, name))
    df = publish_view(table.read(), layer, name)
    if register:
        register_table(spark, layer, name, table.root, df.schema, tuple(table.head()[1]["partition_by"]))
    return df


def materialize(df: DataFrame, root: str, layer: str, name: str,
                partition_by: tuple[str, ...] = (), register: bool = False, meta: dict | None = None) -> DataFrame:
    """Full rebuild of a model as Parquet; returns the stored table.

    The new content is published by one commit (``storage.tables``): a
    rebuild that fails or is lost at any step leaves the model as it was.
    ``register`` also exposes it as the catalog table ``<layer>.<name>``;
    ``meta`` says what it was made from.
    """
    # Rebalance on the partition columns: each task writes few partitions
    # (no task x partition explosion of small files), and AQE splits a
    # month that holds much more data than the others.
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    Table(df.sparkSession, layer_path(root, layer, name)).replace(rows, partition_by, meta=meta)
    return stored_model(df.sparkSession, root, layer, name, register)


@dataclass
class Build:
    silver: dict[str, DataFrame]
    gold: dict[str, DataFrame]


def build_silver(binding) -> dict[str, DataFrame]:
    """Publish every silver model of ``binding`` as a lazy view."""
    return {name: publish_view(df, SILVER, name) for name, df in binding.silver().items()}


def build_gold(binding, root: str, silver: dict[str, DataFrame] | None = None,
               threads: int = 4, marts: bool = False, register: bool = False,
               checks: bool = False) -> Build:
    """Rebuild every gold model of ``binding`` under ``root`` in dependency order.

    ``binding`` supplies the silver models, the sales fact, the dimensions
    and the calendar (``plans.erp.ErpBinding`` over ingested bronze tables,
    or ``plans.domain.BenchmarkBinding`` over the benchmark tables).
    Models that do not depend on each other are submitted as concurrent
    Spark jobs from ``threads`` driver threads (the scheduler interleaves
    their tasks, so small jobs do not leave executors idle); the mart starts
    once the stored fact exists and reads it back from storage.  With
    ``marts`` the dashboard marts (KPIs, monthly sales vs the dollar, store
    ranking) are materialized from the stored gold tables as a third wave;
    with ``register`` every gold model becomes the catalog table
    ``gold.<model>``; with ``checks`` the data-quality tables
    (``plans.quality``) are written to the ``quality`` layer.
    """
    silver = build_silver(binding) if silver is None else silver
    sources = binding.sources()
    spark = binding.spark

    def made_from(name: str) -> dict:
        return {s: sources[s] for s in MADE_FROM[name] if s in sources}

    wave = {name: (df, (), made_from(name)) for name, df in binding.dimensions(silver).items()}
    wave["dim_calendario"] = (binding.calendar(), (), made_from("dim_calendario"))
    wave["fct_indicadores_economicos"] = (silver["stg_indicadores"], (), made_from("fct_indicadores_economicos"))
    wave["fct_vendas"] = (binding.sales_fact(silver).select(*FACT_COLUMNS), FACT_PARTITIONS, made_from("fct_vendas"))
    gold = _materialize_all(wave, root, threads, register)
    commit = Table(spark, layer_path(root, GOLD, "fct_vendas")).log.newest()
    sums = month_sums(spark, root).rebuild(gold["fct_vendas"], commit)
    gold.update(_marts(sums, gold, silver, root, threads, marts, register))
    if checks:
        gold.update(_checks(binding, silver, root, threads, register))
    return Build(silver, gold)


#: The sources whose versions decide whether a model is still what a rebuild would give.
MADE_FROM = {"dim_cliente": ["erp_clientes"], "dim_loja": ["erp_lojas"], "dim_produto": ["erp_produtos"],
             "dim_calendario": ["erp_vendas"], "fct_indicadores_economicos": ["series"],
             "fct_vendas": ["erp_vendas", "erp_itens_venda"]}


def month_sums(spark, root: str) -> MaintainedSums:
    """Sales per month and store, kept beside the fact."""
    return MaintainedSums(spark, layer_path(root, GOLD, "_somas_vendas_mensais"), ATTAINMENT_KEYS, "total")


def _marts(sums: DataFrame, gold: dict[str, DataFrame], silver: dict[str, DataFrame], root: str, threads: int,
           marts: bool, register: bool) -> dict[str, DataFrame]:
    """The marts, all from the sums per month and store: none of them reads the fact."""
    detail = attainment_of_sums(sums_as_sales(sums), silver["stg_metas"], with_count=True)
    out = {"vendas_vs_meta_mensal": materialize(detail.drop("n_vendas"), root, GOLD, "vendas_vs_meta_mensal", register=register)}
    if marts:
        out.update(_materialize_all({
            "kpi_visao_geral": (kpi_of_detail(detail), (), {}),
            "vendas_vs_dolar_mensal": (
                months_vs_indicator(months_of_sums(sums), gold["fct_indicadores_economicos"]), (), {}),
            "ranking_lojas": (store_ranking(out["vendas_vs_meta_mensal"]), (), {})}, root, threads, register))
    return out


def _checks(binding, silver: dict[str, DataFrame], root: str, threads: int, register: bool) -> dict[str, DataFrame]:
    if getattr(binding, "stored_state", False):
        refresh_checks(binding, silver, lambda name: layer_path(root, QUALITY, name))
        return {name: stored_model(binding.spark, root, QUALITY, name, register) for name in CHECKS}
    found = quality_checks(silver, binding.sale_ids())
    return _materialize_all({n: (df, (), {}) for n, df in found.items()}, root, threads, register, QUALITY)


def refresh_gold(binding, root: str, threads: int = 4, marts: bool = False, register: bool = False,
                 checks: bool = False) -> Build:
    """Bring the gold models under ``root`` up to date with what changed in their sources.

    The result equals ``build_gold``.  The changed rows of sales and items
    (``binding.changed_sales``) say which sales and months of the fact to make
    anew; the sums per month and store follow the fact by subtracting the old
    rows of these sales and adding the new ones, and the marts are made from
    the sums.  A dimension is rebuilt if its source has a new version, the
    calendar if sales lie outside of it.  Models that were never built, or
    changes that are not kept any more, mean a full build.
    """
    spark = binding.spark
    sources = binding.sources()
    known = {name: Table(spark, layer_path(root, GOLD, name)).head()[1] for name in MADE_FROM}
    if any(entry is None for entry in known.values()):
        return build_gold(binding, root, threads=threads, marts=marts, register=register, checks=checks)
    fact_path = layer_path(root, GOLD, "fct_vendas")
    base = Table(spark, fact_path).log.newest()
    changed = binding.changed_sales(known["fct_vendas"]["meta"])
    sums = month_sums(spark, root)
    if changed is None or sums.source() != base:
        return build_gold(binding, root, threads=threads, marts=marts, register=register, checks=checks)

    silver = build_silver(binding)
    keys, months = changed
    meta = {s: sources[s] for s in MADE_FROM["fct_vendas"] if s in sources}
    if meta == known["fct_vendas"]["meta"]:
        now = sums.read()
    else:
        done = refresh_partitions(binding.fact_of, fact_path, keys, had=months, meta=meta)
        now = sums.apply(done.old, done.new, base, done.written.number)
    gold = {"fct_vendas": stored_model(spark, root, GOLD, "fct_vendas", register)}
    wave = {}
    candidates = {**binding.dimensions(silver), "fct_indicadores_economicos": silver["stg_indicadores"]}
    for name, df in candidates.items():
        made_from = {s: sources[s] for s in MADE_FROM[name] if s in sources}
        if made_from != known[name]["meta"]:
            wave[name] = (df, (), made_from)
        else:
            gold[name] = stored_model(spark, root, GOLD, name, register)
    calendar = Table(spark, layer_path(root, GOLD, "dim_calendario")).read()
    if binding.calendar_lacks(calendar):
        wave["dim_calendario"] = (binding.calendar(), (), {})
    else:
        gold["dim_calendario"] = stored_model(spark, root, GOLD, "dim_calendario", register)
    gold.update(_materialize_all(wave, root, threads, register))
    gold.update(_marts(now, gold, silver, root, threads, marts, register))
    if checks:
        gold.update(_checks(binding, silver, root, threads, register))
    return Build(silver, gold)


def _materialize_all(models: dict[str, tuple[DataFrame, tuple[str, ...], dict]], root: str,
                     threads: int, register: bool = False, layer: str = GOLD) -> dict[str, DataFrame]:
    if threads <= 1:
        return {n: materialize(df, root, layer, n, parts, register, meta)
                for n, (df, parts, meta) in models.items()}
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = {n: pool.submit(materialize, df, root, layer, n, parts, register, meta)
                   for n, (df, parts, meta) in models.items()}
        return {n: f.result() for n, f in futures.items()}
