"""Registered queries: one callable per operator group, plus its SQL oracle.

Every query reads whole benchmark tables (see ``tributary.plans.domain``)
and returns a lazy ``DataFrame``.  ``ORACLE_SQL`` holds, for each query that
SQL can express, an independent ANSI/DuckDB statement over the same tables;
column names match the DataFrame's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.dates import series_date_text, window_start
from tributary.functions.numeric import money_sum
from tributary.operators import (attainment, calendar_covering, kpi_overview,
                                 latest_version, monthly_vs_indicator, orphan_rows,
                                 parse_series, stage_sales, stage_targets, store_ranking,
                                 target_plan, unique_violations)
from tributary.plans import domain as D
from tributary.plans.daily import DailyRun, run_daily
from tributary.plans.erp import ErpBinding
from tributary.plans.layers import build_gold
from tributary.session import configure, scratch_path
from tributary.sources.bronze import coerce_cells, normalise_types, with_audit, write_append
from tributary.sources.files import ingest_files, write_csv
from tributary.sources.relational import (high_water_mark, incremental_extract,
                                          watermark_or_epoch)
from tributary.sources.rest_series import extraction_window, ingest_series
from tributary.storage.tables import Table, read_table
from tributary.streaming.upsert import incremental_upsert, refresh_partitions, stream_latest

Query = Callable[[SparkSession, str], DataFrame]

# The line-item log as a change log: key, newest first by ship date, ties
# broken by part, supplier and price (unique together with the key).
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate"]
LINE_TIEBREAK = ["l_partkey", "l_suppkey", "l_extendedprice"]


def _tables(spark: SparkSession, sf_dir: str) -> D.Tables:
    configure(spark)
    return D.Tables(spark, sf_dir)


# ---------------------------------------------------------------- gold

def q_sales_fact(spark, sf_dir):
    return D.gold_sales_fact(_tables(spark, sf_dir))


def q_sales_vs_target_monthly(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return attainment(D.gold_sales_fact(t), D.silver_targets(t))


def q_latest_version(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return latest_version(t.lineitem, LINE_KEYS, LINE_ORDER, tiebreak=LINE_TIEBREAK)


def q_latest_completed(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return stage_sales(D.events_log(t), completed=D.COMPLETED_EVENT, tiebreak=["event_id"])


def q_stage_items(spark, sf_dir):
    return D.silver_items(_tables(spark, sf_dir))


def q_conform_dimension(spark, sf_dir):
    return D.gold_dimensions(_tables(spark, sf_dir))["dim_loja"]


def q_dim_customer(spark, sf_dir):
    return D.gold_dimensions(_tables(spark, sf_dir))["dim_cliente"]


def q_dim_product(spark, sf_dir):
    return D.gold_dimensions(_tables(spark, sf_dir))["dim_produto"]


def q_indicator_align(spark, sf_dir):
    return D.silver_indicators(_tables(spark, sf_dir), "first_two")


def q_indicator_align_all_keys(spark, sf_dir):
    return D.silver_indicators(_tables(spark, sf_dir), "all")


def q_series_parse(spark, sf_dir):
    return D.silver_parsed_series(_tables(spark, sf_dir))


def q_calendar(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return calendar_covering(t.orders, "o_orderdate")


def q_stage_targets(spark, sf_dir):
    return D.silver_targets(_tables(spark, sf_dir))


def q_kpi_overview(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return kpi_overview(D.gold_sales_fact(t), D.silver_targets(t))


def q_monthly_vs_indicator(spark, sf_dir):
    t = _tables(spark, sf_dir)
    purchases = t.events.where(F.col("event_type") == "purchase").select(
        F.to_date("ts").alias("data"), F.col("value").alias("total"))
    return monthly_vs_indicator(purchases, D.silver_indicators(t), indicator="dolar")


def q_store_ranking(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return store_ranking(attainment(D.gold_sales_fact(t), D.silver_targets(t)))


def q_target_plan(spark, sf_dir):
    t = _tables(spark, sf_dir)
    keys = D.sales_lines(t).select("ano", "mes", "loja_id", "categoria")
    # Every line yields a key (left joins), so the first year is a one-column
    # scalar subquery over the lines, without repeating the joins.
    base_year = t.lineitem.select(F.min(F.year("l_shipdate"))).scalar()
    return target_plan(keys, base_year)


def q_unique_violations(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return unique_violations(t.lineitem, LINE_KEYS)


def q_orphan_rows(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return orphan_rows(D.silver_items(t), D.silver_sales(t), "venda_id")


# ---------------------------------------------------------------- ingestion helpers

def q_high_water_mark(spark, sf_dir):
    t = _tables(spark, sf_dir)
    logs = {"erp_vendas": D.orders_log(t), "erp_itens_venda": D.items_log(t),
            "events": D.events_log(t)}
    out = None
    for name, log in logs.items():
        one = high_water_mark(log, "_loaded_at").select(F.lit(name).alias("tabela"), "watermark")
        out = one if out is None else out.unionByName(one)
    return out


def q_incremental_extract(spark, sf_dir):
    """New orders since the watermark a previous run stored (fixed here)."""
    t = _tables(spark, sf_dir)
    return incremental_extract(t.orders, "o_orderdate", "2000-01-01T00:00:00",
                               loaded_at=D.RUN_TS, source_tag="erp.orders")


def q_series_window(spark, sf_dir):
    """Daily order totals inside the 3x365-day window ending at the run date
    (the newest order date), with the window bounds as the API expects them."""
    t = _tables(spark, sf_dir)
    day = F.to_date("o_orderdate")
    newest = t.orders.select(F.max(day)).first()[0]
    # Bounds on the raw timestamp, as literals: they reach the Parquet scan.
    run_date = F.lit(newest).cast("date")
    start = window_start(run_date)
    low, high = extraction_window(newest) if newest else (None, None)
    rows = t.orders.where((F.col("o_orderdate") >= F.lit(low).cast("timestamp"))
                          & (F.col("o_orderdate") < F.lit(high and high + dt.timedelta(days=1)).cast("timestamp")))
    daily = (rows.groupBy(day.alias("d")).agg(money_sum("o_totalprice").alias("valor")))
    return daily.select(series_date_text("d").alias("data"), "valor",
                        series_date_text(start).alias("data_inicio"),
                        series_date_text(run_date).alias("data_fim"))


def q_numeric_coercion(spark, sf_dir):
    t = _tables(spark, sf_dir)
    cells = t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("value_text"),
        F.col("event_type").alias("type_text"),
        F.concat(F.col("user_id").cast("string"), F.lit("D")).alias("suffix_text"))
    return coerce_cells(cells, ["k_text", "value_text", "type_text", "suffix_text"])


def q_normalise_types(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return with_audit(normalise_types(t.events), D.RUN_TS, "events")


# ---------------------------------------------------------------- written tables

def q_csv_roundtrip(spark, sf_dir):
    """Targets land as a CSV file, are truncate-loaded to bronze and staged.

    The file has its columns in another order than the table and text with
    quotes and commas around each category, which staging takes off.
    Only ``metas_vendas.csv`` is landed; the missing ``lojas.csv`` is skipped.
    """
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "csv_roundtrip")
    quoted = D.targets_log(t).select(
        F.concat(F.lit('a "b", '), "categoria").alias("categoria"), "meta_valor", "loja_id", "mes", "ano")
    write_csv(quoted, f"{root}/landing/metas_vendas.csv")
    ingest_files(spark, f"{root}/landing", f"{root}/bronze", D.RUN_TS)
    bronze = read_table(spark, f"{root}/bronze/files_metas_vendas")
    return stage_targets(bronze.withColumn("categoria", F.regexp_replace("categoria", '^a "b", ', "")))


def q_csv_rejects(spark, sf_dir):
    """Targets land with line breaks inside cells and, for store 3, no number: per store rows loaded and rejected."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "csv_rejects")
    landed = D.targets_log(t).select(
        "ano", "mes", "loja_id", F.concat("categoria", F.lit('\nsegunda "linha"')).alias("categoria"),
        F.when(F.col("loja_id") == 3, F.lit("n/d")).otherwise(F.col("meta_valor").cast("string")).alias("meta_valor"))
    write_csv(landed, f"{root}/landing/metas_vendas.csv")
    ingest_files(spark, f"{root}/landing", f"{root}/bronze", D.RUN_TS, most_rejected=0.5)
    whole = F.col("categoria").endswith('\nsegunda "linha"').cast("long")
    good = read_table(spark, f"{root}/bronze/files_metas_vendas").select(
        "loja_id", F.lit(1).alias("loaded"), whole.alias("whole"), F.lit(0).alias("rejected"), F.lit(None).cast("string").alias("reason"))
    bad = read_table(spark, f"{root}/bronze/_rejects/files_metas_vendas").select(
        F.lit(3).cast("long").alias("loja_id"), F.lit(0).alias("loaded"), F.lit(0).cast("long").alias("whole"),
        F.lit(1).alias("rejected"), "reason")
    return good.unionByName(bad).groupBy("loja_id", "reason").agg(
        F.sum("loaded").alias("n_loaded"), F.sum("whole").alias("n_whole"), F.sum("rejected").alias("n_rejected"))


def q_rest_series_source(spark, sf_dir):
    """Series API replayed from recorded responses through the data source.

    The recorded responses are derived from ``events`` (one folder per series
    code); ingestion reads them with one partition per (series, year slice),
    truncate-loads bronze and the silver parser types them.
    """
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "rest_series")
    D.series_api_long(t).select("codigo", "data", "valor").write.partitionBy(
        "codigo").json(f"{root}/api")
    run_date = t.events.agg(F.max(F.to_date("ts"))).first()[0]
    url = f"{root}/api/codigo={{code}}"
    ingest_series(spark, D.SERIES, run_date, url, f"{root}/bronze/series", D.RUN_TS)
    bronze = read_table(spark, f"{root}/bronze/series")
    codes = F.create_map(*[F.lit(x) for kv in D.SERIES.items() for x in kv])
    return parse_series(bronze, "valor", keep=["serie"]).select(
        "serie", codes[F.col("serie")].cast("bigint").alias("codigo"), "data", "valor")


def q_daily_indicators(spark, sf_dir):
    """The indicators as the daily run builds them: series ingested, parsed one by one, joined in a chain."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "daily_indicators")
    D.series_api_long(t).select("codigo", "data", "valor").write.partitionBy("codigo").json(f"{root}/api")
    run_date = t.events.agg(F.max(F.to_date("ts"))).first()[0]
    ingest_series(spark, D.SERIES, run_date, f"{root}/api/codigo={{code}}", f"{root}/bronze/series", D.RUN_TS)
    return ErpBinding(spark, f"{root}/bronze", series=D.SERIES).indicators()


# The source table as seen by four daily runs (orders placed
# before each date) and each run's stamp; the fourth run finds nothing new.
APPEND_RUNS = (("1997-01-01", "2024-02-01T06:00:00"), ("1999-01-01", "2024-02-02T06:00:00"),
               (None, "2024-02-03T06:00:00"), (None, "2024-02-04T06:00:00"))


def q_bronze_append(spark, sf_dir):
    """Incremental append runs into a bronze log, cursor = the source column."""
    t = _tables(spark, sf_dir)
    path = scratch_path(spark, "bronze_append") + "/erp_orders"
    for seen_before, stamp in APPEND_RUNS:
        source = t.orders
        if seen_before is not None:
            source = source.where(F.col("o_orderdate") < F.lit(seen_before).cast("timestamp"))
        since = watermark_or_epoch(spark, path, column="o_orderdate")
        write_append(incremental_extract(source, "o_orderdate", since, stamp, "erp.orders"),
                     path, cluster_by=["o_orderdate"])
    return read_table(spark, path)


def q_layered_build(spark, sf_dir):
    """Silver views + gold tables rebuilt in order; returns the stored mart."""
    binding = D.BenchmarkBinding(_tables(spark, sf_dir))
    return build_gold(binding, scratch_path(spark, "warehouse")).gold["vendas_vs_meta_mensal"]


def q_incremental_upsert(spark, sf_dir):
    """Three large loads and a daily one (a thousandth of the orders) merged into the stored state."""
    t = _tables(spark, sf_dir)
    daily = F.pmod(F.xxhash64("l_orderkey"), F.lit(1000)) == 0
    loads = [*D.load_batches(t.lineitem.where(~daily), "l_shipdate"), t.lineitem.where(daily)]
    return incremental_upsert(loads, scratch_path(spark, "upsert"), LINE_KEYS, LINE_ORDER, LINE_TIEBREAK)


def q_stream_upsert(spark, sf_dir):
    """Each load lands in bronze, then one availableNow streaming pass merges it."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "stream_upsert")
    schema = t.lineitem.schema
    state = None
    for batch in D.load_batches(t.lineitem, "l_shipdate"):
        batch.write.mode("append").parquet(f"{root}/bronze")
        _, _, state = stream_latest(spark, f"{root}/bronze", schema, f"{root}/state",
                                    f"{root}/_checkpoint", LINE_KEYS, LINE_ORDER, LINE_TIEBREAK)
    return state


def q_partition_refresh(spark, sf_dir):
    """A stored fact is brought up to date after the last month of orders changed.

    As stored, these orders were all completed (some are cancelled now), dated
    forty days earlier (they move to another month) and had their first line
    only (the others are new).  Only the months they had or have are rewritten.
    """
    t = _tables(spark, sf_dir)
    path = scratch_path(spark, "partition_refresh") + "/fct_vendas"
    orders, items = D.orders_log(t), D.items_log(t)
    newest = orders.select(F.max("data_venda")).first()[0]
    late = (F.col("data_venda") >= F.lit(newest) - F.expr("interval 30 days")
            if newest is not None else F.lit(False))
    changed = orders.where(late).select(F.col("id").alias("venda_id"))
    orders_then = orders.withColumns({
        "status": F.when(late, F.lit(D.COMPLETED_ORDER)).otherwise(F.col("status")),
        "data_venda": F.when(late, F.col("data_venda") - F.expr("interval 40 days"))
        .otherwise(F.col("data_venda"))})
    later_lines = items.where(F.col("id") > 1).join(changed, "venda_id", "left_semi")
    items_then = items.join(later_lines.select("venda_id", "id").distinct(), ["venda_id", "id"],
                            "left_anti")
    then = D.gold_sales_fact(t, items_then.select(*items.columns), orders_then)
    Table(spark, path).replace(then.hint("rebalance", "ano", "mes"), ("ano", "mes"))

    def rebuild(keys):
        return D.gold_sales_fact(
            t, items.join(keys, "venda_id", "left_semi"),
            orders.join(keys, orders.id == keys.venda_id, "left_semi"))

    return refresh_partitions(rebuild, path, changed).rows


def q_daily_run(spark, sf_dir):
    """Two whole daily runs: sources to bronze text, silver, gold; returns the stored mart.

    The first run sees the orders placed before 1999; the second finds the rest
    by the newest loaded cursor.  Silver reads ISO text, the indicators run as
    the chain of full outer joins, gold tables are in the catalog.
    """
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "daily_run")
    write_csv(D.targets_log(t), f"{root}/landing/metas_vendas.csv")
    D.series_api_long(t).select("codigo", "data", "valor").write.partitionBy("codigo").json(f"{root}/api")
    newest = t.events.agg(F.max(F.to_date("ts"))).first()[0]
    build = None
    for placed_before, stamp in (("1999-01-01", "2024-02-01T06:00:00"), (None, "2024-02-02T06:00:00")):
        build = run_daily(spark, DailyRun(
            run_date=newest, bronze_root=f"{root}/bronze", warehouse_root=f"{root}/warehouse", loaded_at=stamp,
            erp_source=D.erp_source(t, placed_before), landing_dir=f"{root}/landing",
            series_url=f"{root}/api/codigo={{code}}", series=D.SERIES, watermark_on_cursor=True))
    return build.gold["vendas_vs_meta_mensal"]


QUERIES: dict[str, Query] = {
    "sales_fact": q_sales_fact,
    "sales_vs_target_monthly": q_sales_vs_target_monthly,
    "latest_version": q_latest_version,
    "latest_completed": q_latest_completed,
    "stage_items": q_stage_items,
    "conform_dimension": q_conform_dimension,
    "dim_customer": q_dim_customer,
    "dim_product": q_dim_product,
    "indicator_align": q_indicator_align,
    "indicator_align_all_keys": q_indicator_align_all_keys,
    "series_parse": q_series_parse,
    "calendar": q_calendar,
    "stage_targets": q_stage_targets,
    "kpi_overview": q_kpi_overview,
    "monthly_vs_indicator": q_monthly_vs_indicator,
    "store_ranking": q_store_ranking,
    "target_plan": q_target_plan,
    "unique_violations": q_unique_violations,
    "orphan_rows": q_orphan_rows,
    "high_water_mark": q_high_water_mark,
    "incremental_extract": q_incremental_extract,
    "series_window": q_series_window,
    "numeric_coercion": q_numeric_coercion,
    "normalise_types": q_normalise_types,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_rejects": q_csv_rejects,
    "daily_indicators": q_daily_indicators,
    "rest_series_source": q_rest_series_source,
    "bronze_append": q_bronze_append,
    "layered_build": q_layered_build,
    "daily_run": q_daily_run,
    "incremental_upsert": q_incremental_upsert,
    "stream_upsert": q_stream_upsert,
    "partition_refresh": q_partition_refresh,
}
