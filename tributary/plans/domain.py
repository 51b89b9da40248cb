"""Bind the retail model to the benchmark tables.

The operators are written against the retail schema (sales, line items,
customers, stores, products, monthly targets, economic series).  This
module maps the benchmark tables onto that schema with plain projections,
so every gold query reads whole benchmark tables and its work grows with
them:

============================  ==============================================
retail entity                 benchmark source
============================  ==============================================
sales log (one version each)  ``orders``; completed = status ``F``
line-item change log          ``lineitem``; key (order, line number), newest
                              ``l_shipdate`` wins, ties by part, supplier,
                              price
customers / store of a sale   ``customer``; store = ``c_nationkey``
stores                        ``nation`` with its ``region`` name
products                      ``part`` (category = ``p_type``)
monthly targets               ``lineitem`` revenue per ship month, supplier
                              nation and part type
user event log (B1 case)      ``events`` per ``user_id``; newest ``ts`` wins;
                              completed = ``purchase``
economic series               ``events``: daily click sum (dolar), daily
                              error sum (selic), monthly purchase sum dated
                              one month back (ipca)
============================  ==============================================
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.dates import series_date_text
from tributary.functions.numeric import decimal_comma_text, money_of, money_sum
from tributary.operators.calendar import calendar_covering
from tributary.operators.dedup import conform_dimension
from tributary.operators.facts import FACT_COLUMNS, sales_fact
from tributary.operators.series import align_series_long
from tributary.operators.staging import (parse_series, stage_customers, stage_items,
                                         stage_products, stage_sales, stage_stores,
                                         stage_targets)
from tributary.sources.bronze import normalise_series_rows
from tributary.sources.rest_series import SERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events")

COMPLETED_ORDER = "F"
COMPLETED_EVENT = "purchase"
ITEM_KEYS = ("venda_id", "id")
ITEM_TIEBREAK = ("produto_id", "fornecedor_id", "subtotal")

# The event type each economic series is derived from in this binding.
SERIES_EVENT = {"dolar": "click", "selic": "error", "ipca": "purchase"}
MONTHLY_SERIES = ("ipca",)

# Fixed run stamp for the ingestion queries, so reruns are comparable.
RUN_TS = "2024-02-01T06:00:00"


@dataclass
class Tables:
    """Lazy readers for the benchmark tables of one scale factor."""

    spark: SparkSession
    root: str
    _cache: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "root"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")
        return self._cache[name]


# ---------------------------------------------------------------- bronze logs

def orders_log(t: Tables) -> DataFrame:
    """``orders`` in the shape of the ERP sales log."""
    o = t.orders
    return o.select(
        o.o_orderkey.alias("id"), o.o_custkey.alias("cliente_id"),
        o.o_orderdate.alias("data_venda"), o.o_orderstatus.alias("status"),
        o.o_totalprice.alias("total"), o.o_orderdate.alias("updated_at"),
        o.o_orderdate.alias("_loaded_at"))


def items_log(t: Tables) -> DataFrame:
    """``lineitem`` in the shape of the ERP line-item log (several versions per key)."""
    li = t.lineitem
    return li.select(
        li.l_linenumber.alias("id"), li.l_orderkey.alias("venda_id"),
        li.l_partkey.alias("produto_id"), li.l_suppkey.alias("fornecedor_id"),
        li.l_quantity.alias("quantidade"),
        F.try_divide(li.l_extendedprice, li.l_quantity).alias("preco_unit"),
        li.l_extendedprice.alias("subtotal"), li.l_shipdate.alias("_loaded_at"))


def events_log(t: Tables) -> DataFrame:
    """``events`` as a status log per user: newest event decides."""
    e = t.events
    return e.select(
        e.user_id.alias("id"), e.ts.alias("data_venda"), e.event_type.alias("status"),
        e.value.alias("total"), e.ts.alias("updated_at"), e.ts.alias("_loaded_at"),
        e.event_id)


def customers_log(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(c.c_custkey.alias("id"), c.c_name.alias("nome"))


def stores_log(t: Tables) -> DataFrame:
    n, r = t.nation, t.region
    joined = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return joined.select(n.n_nationkey.cast("bigint").alias("id"), n.n_name.alias("nome"),
                         r.r_name.alias("regiao"))


def products_log(t: Tables) -> DataFrame:
    p = t.part
    return p.select(p.p_partkey.alias("id"), p.p_name.alias("nome"),
                    p.p_type.alias("categoria"), p.p_retailprice.alias("preco"))


def customer_store(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(c.c_custkey.alias("cliente_id"), c.c_nationkey.cast("bigint").alias("loja_id"))


def sales_lines(t: Tables) -> DataFrame:
    """Line revenue with the supplier's nation (store) and the part type (category)."""
    li = t.lineitem.select("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    p = t.part.select("p_partkey", "p_type")
    # Left joins: a line whose supplier or part is unknown keeps its revenue
    # under a NULL store / category instead of disappearing.
    return (li.join(s, li.l_suppkey == s.s_suppkey, "left")
            .join(p, li.l_partkey == p.p_partkey, "left")
            .select(F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes"),
                    F.col("s_nationkey").alias("loja_id"), F.col("p_type").alias("categoria"),
                    "l_extendedprice"))


def targets_log(t: Tables) -> DataFrame:
    """Monthly targets file content: (ano, mes, loja_id, categoria, meta_valor)."""
    return (sales_lines(t).groupBy("ano", "mes", "loja_id", "categoria")
            .agg(money_sum("l_extendedprice").alias("meta_valor")))


def series_api_long(t: Tables) -> DataFrame:
    """All three series as the API would return them, in one long frame:
    ``(serie, codigo, data dd/MM/yyyy, valor with a decimal comma)``.

    One filtered scan of ``events`` and one aggregate on (series, day); the
    monthly series is dated on the first day of the previous month.
    """
    by_event = list(SERIES_EVENT.items())
    serie = F.when(F.col("event_type") == by_event[0][1], F.lit(by_event[0][0]))
    for name, event in by_event[1:]:
        serie = serie.when(F.col("event_type") == event, F.lit(name))
    code = F.when(F.col("serie") == by_event[0][0], F.lit(SERIES[by_event[0][0]]))
    for name, _ in by_event[1:]:
        code = code.when(F.col("serie") == name, F.lit(SERIES[name]))
    monthly = serie.isin(list(MONTHLY_SERIES))
    day = F.when(monthly, F.add_months(F.trunc(F.col("ts"), "month"), -1)) \
        .otherwise(F.to_date("ts"))
    events = t.events.where(F.col("event_type").isin([e for _, e in by_event]))
    daily = events.groupBy(serie.alias("serie"), day.alias("d")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("v"))
    return daily.select("serie", code.cast("bigint").alias("codigo"),
                        series_date_text("d").alias("data"),
                        decimal_comma_text("v").alias("valor"))


def series_bronze_long(t: Tables, loaded_at: str = RUN_TS) -> DataFrame:
    """Bronze series table (all series): normalised value plus audit columns."""
    rows = normalise_series_rows(series_api_long(t))
    return rows.withColumns({
        "_loaded_at": F.lit(loaded_at),
        "_source": F.concat(F.lit("series_"), F.col("codigo").cast("string"))})


# Ship-date boundaries that split the line-item log into the
# three loads the incremental queries replay (NULL dates go to the first).
LOAD_BOUNDS = ("1997-01-01", "1999-06-01")


def load_batches(df: DataFrame, date_col: str) -> list[DataFrame]:
    """Split a log into consecutive loads by ``date_col``; together they hold
    every row exactly once."""
    d = F.col(date_col)
    lo, hi = (F.lit(b).cast("timestamp") for b in LOAD_BOUNDS)
    return [df.where(d.isNull() | (d < lo)), df.where((d >= lo) & (d < hi)),
            df.where(d >= hi)]


def erp_source(t: Tables, placed_before: str | None = None):
    """The benchmark tables as the relational source of a daily run: ``spec -> DataFrame``.

    ``placed_before`` leaves out later orders, as an earlier run saw them.
    """
    orders, lines = t.orders, t.lineitem
    if placed_before is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(placed_before).cast("timestamp"))
    sold = orders.join(t.customer, orders.o_custkey == t.customer.c_custkey, "left")
    money = "decimal(10,2)"
    first_day = F.lit("1990-01-01").cast("timestamp")
    frames = {
        "vendas": sold.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cliente_id"),
            F.col("c_nationkey").alias("loja_id"), F.col("o_orderdate").alias("data_venda"),
            F.when(F.col("o_orderstatus") == COMPLETED_ORDER, F.lit("concluida"))
            .otherwise(F.lit("cancelada")).alias("status"),
            money_of("o_totalprice", 10).alias("total"), F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at")),
        "itens_venda": lines.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("venda_id"), F.col("l_partkey").alias("produto_id"),
            F.col("l_quantity").cast("int").alias("quantidade"),
            money_of(F.try_divide("l_extendedprice", "l_quantity"), 10).alias("preco_unit"),
            money_of("l_extendedprice", 10).alias("subtotal"), F.col("l_shipdate").alias("created_at")),
        "clientes": t.customer.select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"), F.lit(None).cast("string").alias("email"),
            F.lit(None).cast("string").alias("cidade"), F.lit(None).cast("string").alias("uf"),
            first_day.alias("created_at"), first_day.alias("updated_at")),
        "lojas": t.nation.select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("nome"), F.lit(None).cast("string").alias("cidade"),
            F.lit(None).cast("string").alias("uf"), F.lit(None).cast("string").alias("regiao"),
            first_day.alias("created_at")),
        "produtos": t.part.select(
            F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("sku"),
            F.col("p_name").alias("nome"), F.col("p_type").alias("categoria"),
            F.lit(None).cast(money).alias("custo"), F.col("p_retailprice").cast(money).alias("preco"),
            first_day.alias("created_at")),
    }
    return lambda spec: frames[spec.name]


# ---------------------------------------------------------------- silver

def silver_sales(t: Tables, log: DataFrame | None = None) -> DataFrame:
    return stage_sales(orders_log(t) if log is None else log, completed=COMPLETED_ORDER)


def silver_items(t: Tables, log: DataFrame | None = None) -> DataFrame:
    """Latest version per line item of ``log`` (default: the whole items log)."""
    log = items_log(t) if log is None else log
    return stage_items(log, keys=ITEM_KEYS, tiebreak=ITEM_TIEBREAK)


def silver_customers(t: Tables) -> DataFrame:
    return stage_customers(customers_log(t))


def silver_stores(t: Tables) -> DataFrame:
    return stage_stores(stores_log(t))


def silver_products(t: Tables) -> DataFrame:
    return stage_products(products_log(t))


def silver_targets(t: Tables) -> DataFrame:
    return stage_targets(targets_log(t))


def silver_parsed_series(t: Tables) -> DataFrame:
    """``(serie, codigo, data date, valor double)`` for all series."""
    return parse_series(series_bronze_long(t), "valor", keep=["serie", "codigo"])


def silver_indicators(t: Tables, key_mode: str = "first_two") -> DataFrame:
    """Aligned series.  The series here come from one aggregate (unique per
    series and date), so the single-aggregate form of the alignment applies;
    the SQL oracle states it as the chained full outer joins."""
    return align_series_long(silver_parsed_series(t), list(SERIES), key_mode=key_mode)


# ---------------------------------------------------------------- gold

def gold_sales_fact(t: Tables, items: DataFrame | None = None,
                    orders: DataFrame | None = None) -> DataFrame:
    """Sales fact with the store of each sale (the customer's nation).

    The store lookup joins after the item join: sales and item totals are
    both partitioned by sale id, and only the finished fact moves (or the
    lookup is broadcast when its estimate is small).
    """
    fact = sales_fact(silver_sales(t, orders), silver_items(t, items))
    return fact.join(customer_store(t), "cliente_id", "left").select(*FACT_COLUMNS)


def gold_dimensions(t: Tables) -> dict[str, DataFrame]:
    return {
        "dim_cliente": conform_dimension(silver_customers(t), "cliente_id"),
        "dim_loja": conform_dimension(silver_stores(t), "loja_id"),
        "dim_produto": conform_dimension(silver_products(t), "produto_id"),
    }


class BenchmarkBinding:
    """The benchmark tables seen through the retail model, for the layered
    build (``tributary.plans.layers``)."""

    def __init__(self, t: Tables):
        self.t = t
        self.spark = t.spark

    def silver(self) -> dict[str, DataFrame]:
        t = self.t
        return {
            "stg_erp_vendas": silver_sales(t),
            "stg_erp_itens_venda": silver_items(t),
            "stg_erp_clientes": silver_customers(t),
            "stg_erp_lojas": silver_stores(t),
            "stg_erp_produtos": silver_products(t),
            "stg_metas": silver_targets(t),
            "stg_indicadores": silver_indicators(t),
        }

    def sources(self) -> dict[str, int]:
        """The benchmark tables have no versions: every build is a full one."""
        return {}

    def sales_fact(self, silver: dict[str, DataFrame]) -> DataFrame:
        return gold_sales_fact(self.t)

    def dimensions(self, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return gold_dimensions(self.t)

    def sale_ids(self) -> DataFrame:
        return orders_log(self.t).select(F.col("id").alias("venda_id"))

    def calendar(self) -> DataFrame:
        return calendar_covering(self.t.orders, "o_orderdate")
