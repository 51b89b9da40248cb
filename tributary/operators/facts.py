"""Gold facts: the sales fact and monthly attainment against targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.numeric import money_sum, safe_ratio_pct

FACT_COLUMNS = ("venda_id", "cliente_id", "loja_id", "data", "ano", "mes", "status",
                "total", "total_itens", "total_quantidade", "qtd_itens")
ATTAINMENT_KEYS = ("ano", "mes", "loja_id")


def item_totals(items: DataFrame, key: str = "venda_id") -> DataFrame:
    """Per-sale item sums and line count.

    Aggregating *before* the join keeps the join one-to-one (no fan-out);
    Spark runs it as partial aggregation before the shuffle.
    """
    return items.groupBy(key).agg(
        money_sum("subtotal").alias("total_itens"),
        F.sum(F.col("quantidade").cast("bigint")).alias("total_quantidade"),
        F.count(F.lit(1)).alias("qtd_itens"),
    )


def sales_fact(sales: DataFrame, items: DataFrame) -> DataFrame:
    """One row per completed sale with its item totals.

    A sale without items is kept with NULL item measures (not zero).  Both
    inputs are partitioned on ``venda_id`` (the sales by their key window,
    the items by their aggregate), so the left join adds no shuffle of its
    own.
    """
    fact = sales.join(item_totals(items), "venda_id", "left")
    day = F.col("data_venda_date")
    cols = {
        "venda_id": F.col("venda_id"),
        "cliente_id": F.col("cliente_id"),
        "loja_id": F.col("loja_id"),
        "data": day,
        "ano": F.year(day).cast("bigint"),
        "mes": F.month(day).cast("bigint"),
        "status": F.col("status"),
        "total": F.col("total"),
        "total_itens": F.col("total_itens"),
        "total_quantidade": F.col("total_quantidade"),
        "qtd_itens": F.col("qtd_itens"),
    }
    present = set(fact.columns) | {"data", "ano", "mes"}
    return fact.select(*[c.alias(n) for n, c in cols.items() if n in present])


def attainment(actual: DataFrame, targets: DataFrame,
               keys: Sequence[str] = ATTAINMENT_KEYS, actual_col: str = "total",
               target_col: str = "meta_valor", with_count: bool = False) -> DataFrame:
    """Actual vs target per key; every key of either side appears once.

    Both sides are aggregated to the key grain first, so the full outer join
    sees at most one row per key on each side.  NULL keys never match (plain
    equality), and ``pct_meta`` is NULL when the target is zero or missing.
    Both aggregates are hash-partitioned on the join keys, so the join itself
    does not shuffle again.  ``with_count`` adds ``n_vendas``, the number of
    actual rows per key.
    """
    v = actual.groupBy(*keys).agg(money_sum(actual_col).alias("total_vendas"), F.count(F.lit(1)).alias("n_vendas"))
    return attainment_of_sums(v, targets, keys, target_col, with_count)


def sums_as_sales(sums: DataFrame, keys: Sequence[str] = ATTAINMENT_KEYS) -> DataFrame:
    """Maintained sums (``streaming.sums``) as sales totals: (keys, total_vendas, n_vendas)."""
    return sums.select(*keys, F.when(F.col("n_valued") > 0, F.col("total")).cast("double").alias("total_vendas"),
                       F.col("n_rows").alias("n_vendas"))


def attainment_of_sums(sales: DataFrame, targets: DataFrame, keys: Sequence[str] = ATTAINMENT_KEYS,
                       target_col: str = "meta_valor", with_count: bool = False) -> DataFrame:
    """``attainment`` from sales that are summed per key already (``total_vendas``, ``n_vendas``)."""
    v = sales.alias("v")
    m = targets.groupBy(*keys).agg(money_sum(target_col).alias("meta_total")).alias("m")
    cond = [F.col(f"v.{k}") == F.col(f"m.{k}") for k in keys]
    joined = v.join(m, cond, "full_outer")
    return joined.select(
        *[F.coalesce(F.col(f"v.{k}"), F.col(f"m.{k}")).alias(k) for k in keys],
        F.col("v.total_vendas").alias("total_vendas"),
        F.col("m.meta_total").alias("meta_total"),
        safe_ratio_pct(F.col("v.total_vendas"), F.col("m.meta_total")).alias("pct_meta"),
        *([F.col("v.n_vendas").alias("n_vendas")] if with_count else []),
    )
