"""The retail model over the bronze tables written by the ingestion jobs.

Bronze layout under one root (what ``plans.daily.run_daily`` writes):
``erp_<table>`` append logs (ISO text timestamps, ``_loaded_at``),
``files_metas_vendas`` / ``files_lojas`` from the landing files, and
``series`` (partitioned by ``serie``) from the series API.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.calendar import DEFAULT_DAYS, DEFAULT_START, calendar
from tributary.operators.dedup import conform_dimension
from tributary.operators.facts import FACT_COLUMNS, sales_fact
from tributary.operators.series import align_series
from tributary.operators.staging import (CUSTOMERS_SPEC, ITEMS_SPEC, PRODUCTS_SPEC, SALES_SPEC, STORES_SPEC,
                                         parse_series, stage_customers, stage_items, stage_products,
                                         stage_sales, stage_stores, stage_targets)
from tributary.sources.rest_series import SERIES
from tributary.sources.schemas import BRONZE
from tributary.storage.tables import Table, read_table, was_loaded
from tributary.streaming.upsert import KeyedState, within

# Fixed value: the status of a completed sale.
COMPLETED = "concluida"
# Append logs of which silver keeps the newest version per id.
STATE_TABLES = ("erp_clientes", "erp_vendas", "erp_itens_venda")


def log_state(spark: SparkSession, bronze_root: str, name: str) -> KeyedState:
    """The stored newest version per id of a bronze log, with the log's columns."""
    root = bronze_root.rstrip("/")
    return KeyedState(spark, f"{root}/_state/{name}", Table(spark, f"{root}/{name}").schema(), ["id"], ["_loaded_at"])


def merge_logs(spark: SparkSession, bronze_root: str) -> None:
    """Merge what was appended to the logs since the last run into their stored states.

    The commit of a state says up to which commit of the log it goes, so
    nothing else has to be kept, and a state that is lost is made anew.
    """
    root = bronze_root.rstrip("/")

    def one(name: str) -> None:
        log = Table(spark, f"{root}/{name}")
        if not log.exists():
            return
        state = log_state(spark, root, name)
        entry = state.head()[1]
        done, now = entry["meta"].get("log", -1) if entry else -1, log.log.newest()
        if now > done:
            state.merge(log.appended_since(done), {"log": now}, stored=log.size_since(done))

    with ThreadPoolExecutor(max_workers=len(STATE_TABLES)) as pool:
        list(pool.map(one, STATE_TABLES))


def _with_extras(spec, bronze: DataFrame, declared) -> tuple:
    """The spec and, under their own names, the columns that the source has gained since it was declared."""
    taken = {out for out, _, _ in spec} | set(declared.names)
    return (*spec, *((c, c, None) for c in bronze.columns if c not in taken))


class ErpBinding:
    def __init__(self, spark: SparkSession, bronze_root: str, completed: str = COMPLETED,
                 series: dict[str, int] | None = None, key_mode: str = "first_two",
                 calendar_start: str | dt.date = DEFAULT_START,
                 calendar_days: int = DEFAULT_DAYS, calendar_covers_sales: bool = True,
                 stored_state: bool = False):
        self.spark = spark
        self.root = bronze_root.rstrip("/")
        self.completed = completed
        self.series = SERIES if series is None else series
        self.key_mode = key_mode
        self.calendar_start, self.calendar_days = calendar_start, calendar_days
        self.calendar_covers_sales = calendar_covers_sales
        # Read the append logs as their stored newest versions (``merge_logs``) instead of whole.
        self.stored_state = stored_state

    def table(self, name: str) -> DataFrame:
        """A bronze table; one that was never loaded reads as empty (with its
        declared schema), so a first run with a source missing still builds
        every model.  A table that was loaded and is gone fails."""
        path = f"{self.root}/{name}"
        if name in BRONZE and not was_loaded(self.spark, path):
            return self.spark.createDataFrame([], BRONZE[name])
        if self._stored(name):
            return log_state(self.spark, self.root, name).read()
        return read_table(self.spark, path)

    def _stored(self, name: str) -> bool:
        return (self.stored_state and name in STATE_TABLES and Table(self.spark, f"{self.root}/{name}").exists()
                and bool(log_state(self.spark, self.root, name).versions()))

    def sources(self) -> dict[str, int]:
        """The version of every source that models are made from."""
        out = {}
        for name in BRONZE:
            number = (log_state(self.spark, self.root, name).content_version() if self._stored(name)
                      else Table(self.spark, f"{self.root}/{name}").log.newest())
            if number >= 0:
                out[name] = number
        return out

    def spec_of(self, name: str, spec) -> tuple:
        """The staging spec of a table with the columns its source has gained."""
        return _with_extras(spec, self.table(name), BRONZE[name])

    def changes_of(self, name: str, version: int) -> DataFrame | None:
        """Old and new rows (``id``, ``old``, ``new``) of a table since one of its versions; None if not known.

        A stored log has a feed of them.  The other logs keep every row, so
        their changes are the rows appended since; rows that compaction moved
        are told by the stamp of their load.
        """
        if self._stored(name):
            return log_state(self.spark, self.root, name).changes(version)
        log = Table(self.spark, f"{self.root}/{name}")
        if version not in log.log.numbers():
            return None
        seen = [p["stats"].get("_loaded_at") for p in log.log.entry(version)["parts"]]
        if None in seen:
            return None
        rows = log.appended_since(version).where(F.col("_loaded_at") > F.lit(max((x[1] for x in seen), default="")))
        row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        return rows.select("id", F.when(F.lit(False), row).alias("old"), row.alias("new"))

    def rows_now(self, name: str, ids: DataFrame) -> DataFrame:
        """The present rows of some ids of a stored log."""
        return log_state(self.spark, self.root, name).lookup(ids)

    def known_ids(self, name: str, ids: DataFrame) -> DataFrame:
        """Which of some ids a table has."""
        if self._stored(name):
            return log_state(self.spark, self.root, name).lookup(ids).select("id")
        return within(self.table(name).select("id"), ids, ["id"]).distinct()

    def changed_sales(self, made_from: dict[str, int]) -> tuple[DataFrame, DataFrame] | None:
        """(sale ids, months) of the fact rows that may differ since the given versions of sales and items.

        The months are those of the old and the present rows of these sales.
        None if the changes are not known.
        """
        feeds = {}
        for name in ("erp_vendas", "erp_itens_venda"):
            if not self._stored(name) or name not in made_from:
                return None
            feeds[name] = log_state(self.spark, self.root, name).changes(made_from[name])
            if feeds[name] is None:
                return None
        sales, items = feeds["erp_vendas"], feeds["erp_itens_venda"]
        ids = (sales.select(F.col("id").alias("venda_id"))
               .unionByName(items.select(F.col("new.venda_id").alias("venda_id")))
               .unionByName(items.select(F.col("old.venda_id").alias("venda_id")))
               .where(F.col("venda_id").isNotNull()).distinct())
        now = log_state(self.spark, self.root, "erp_vendas").lookup(ids.withColumnRenamed("venda_id", "id"))
        moments = now.select("data_venda").unionByName(sales.select(F.col("old.data_venda").alias("data_venda")))
        day = F.to_date(F.col("data_venda").cast("timestamp"))
        months = moments.select(F.year(day).cast("bigint").alias("ano"), F.month(day).cast("bigint").alias("mes")).distinct()
        return ids, months

    def fact_of(self, ids: DataFrame) -> DataFrame:
        """The fact rows of some sales: their stored rows are looked up, only their items are joined."""
        sales = log_state(self.spark, self.root, "erp_vendas").lookup(ids.select(F.col("venda_id").alias("id")))
        items = self.table("erp_itens_venda").join(ids, "venda_id", "left_semi")
        return sales_fact(stage_sales(sales, completed=self.completed, keys=()),
                          stage_items(items, keys=()) if self._stored("erp_itens_venda") else stage_items(items)
                          ).select(*FACT_COLUMNS)

    def indicators(self) -> DataFrame:
        bronze = self.table("series")
        parsed = [(parse_series(bronze.where(F.col("serie") == name), name), name)
                  for name in self.series]
        return align_series(parsed, key_mode=self.key_mode)

    def silver(self) -> dict[str, DataFrame]:
        """Every silver model as a lazy chain ``bronze.transform(stager)``.

        A stored log was ranked when its loads were merged and is not ranked again.
        """
        def staged(name: str, stager, spec, **options) -> DataFrame:
            bronze = self.table(name)
            if self._stored(name):
                options["keys"] = ()
            return bronze.transform(stager, spec=_with_extras(spec, bronze, BRONZE[name]), **options)

        return {
            "stg_erp_vendas": staged("erp_vendas", stage_sales, SALES_SPEC, completed=self.completed),
            "stg_erp_itens_venda": staged("erp_itens_venda", stage_items, ITEMS_SPEC),
            "stg_erp_clientes": staged("erp_clientes", stage_customers, CUSTOMERS_SPEC),
            "stg_erp_lojas": staged("erp_lojas", stage_stores, STORES_SPEC),
            "stg_erp_produtos": staged("erp_produtos", stage_products, PRODUCTS_SPEC),
            "stg_metas": self.table("files_metas_vendas").transform(stage_targets),
            "stg_indicadores": self.indicators(),
        }

    def sales_fact(self, silver: dict[str, DataFrame]) -> DataFrame:
        return sales_fact(silver["stg_erp_vendas"], silver["stg_erp_itens_venda"])

    def dimensions(self, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {
            "dim_cliente": conform_dimension(silver["stg_erp_clientes"], "cliente_id"),
            "dim_loja": conform_dimension(silver["stg_erp_lojas"], "loja_id"),
            "dim_produto": conform_dimension(silver["stg_erp_produtos"], "produto_id"),
        }

    def sale_ids(self) -> DataFrame:
        """Every sale id ever loaded (all versions, any status)."""
        return self.table("erp_vendas").select(F.col("id").alias("venda_id"))

    def calendar_range(self) -> tuple[dt.date, dt.date]:
        """The configured days, and those up to the first and last sale beyond them.

        The log's commit knows its first and last day of sale; only a log
        without these statistics is read.
        """
        start = dt.date.fromisoformat(str(self.calendar_start))
        end = start + dt.timedelta(days=self.calendar_days - 1)
        if self.calendar_covers_sales:
            found = Table(self.spark, f"{self.root}/erp_vendas").extremes("data_venda")
            if found:
                low, high = (dt.date.fromisoformat(str(x)[:10]) for x in found)
            else:
                day = F.to_date(F.substring(F.col("data_venda").cast("string"), 1, 10))
                low, high = self.table("erp_vendas").select(F.min(day), F.max(day)).first()
            start, end = min(start, low or start), max(end, high or end)
        return start, end

    def calendar(self) -> DataFrame:
        start, end = self.calendar_range()
        return calendar(self.spark, start, (end - start).days + 1)

    def calendar_lacks(self, stored: DataFrame) -> bool:
        """Whether the stored calendar is another one than ``calendar`` gives."""
        return tuple(stored.select(F.min("data"), F.max("data")).first()) != self.calendar_range()
