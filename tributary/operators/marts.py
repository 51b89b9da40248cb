"""Reporting marts on top of the gold layer, and the target plan rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.numeric import (growth_factor, money_sum, safe_ratio_pct,
                                         seasonal_factor)
from tributary.operators.facts import ATTAINMENT_KEYS, attainment

# Fixed values of the target rule: a base of 15,000 per store, month and
# category, 5 % growth per year, November and December x1.4, January and
# February x0.85, other months x1.0, rounded to cents.
TARGET_BASE = 15000.0
TARGET_GROWTH = 0.05
TARGET_SEASONALITY = {11: 1.4, 12: 1.4, 1: 0.85, 2: 0.85}


# Rates have four decimals; eight keep them whole, and decimal sums do not
# depend on the order of partitions.
RATE_TYPE = "decimal(28,8)"


def kpi_overview(actual: DataFrame, targets: DataFrame,
                 keys: Sequence[str] = ATTAINMENT_KEYS) -> DataFrame:
    """One row: total sales, number of sales, average ticket, target, % of target.

    Computed from the attainment detail (already aggregated to month x
    store, with a sales count), so it is a single global aggregate over a
    small frame: the fact is read once and no join of one-row frames is
    needed.  Every sale is in exactly one detail row (keys of either side
    are kept by the full outer join), so the totals equal the fact's.
    """
    return kpi_of_detail(attainment(actual, targets, keys, with_count=True))


def kpi_of_detail(detail: DataFrame) -> DataFrame:
    """``kpi_overview`` from the attainment detail with its sales counts."""
    total = money_sum("total_vendas")
    target = money_sum("meta_total")
    count = F.coalesce(F.sum("n_vendas"), F.lit(0)).cast("bigint")
    return detail.agg(
        total.alias("total_vendas"), count.alias("n_vendas"),
        F.try_divide(total, count).alias("ticket_medio"),
        target.alias("meta_total"),
        safe_ratio_pct(total, target).alias("pct_meta"))


def monthly_vs_indicator(sales: DataFrame, indicators: DataFrame,
                         sales_date: str = "data", amount: str = "total",
                         indicator: str = "dolar", indicator_date: str = "data") -> DataFrame:
    """Monthly sales next to the month's average indicator value.

    Sales months are the spine (left join); the average is sum / count of
    the exact decimal values.
    """
    s = sales.groupBy(F.year(sales_date).cast("bigint").alias("ano"),
                      F.month(sales_date).cast("bigint").alias("mes")).agg(
        money_sum(amount).alias("total_vendas"),
        F.count(F.lit(1)).alias("n_vendas"))
    return months_vs_indicator(s, indicators, indicator, indicator_date)


def months_of_sums(sums: DataFrame) -> DataFrame:
    """Maintained sums per month and store (``streaming.sums``) as sales per month."""
    return sums.groupBy("ano", "mes").agg(
        F.when(F.sum("n_valued") > 0, F.sum("total")).cast("double").alias("total_vendas"),
        F.sum("n_rows").alias("n_vendas"))


def months_vs_indicator(s: DataFrame, indicators: DataFrame, indicator: str = "dolar",
                        indicator_date: str = "data") -> DataFrame:
    """``monthly_vs_indicator`` from sales that are summed per month already."""
    ind = indicators.where(F.col(indicator_date).isNotNull() & F.col(indicator).isNotNull())
    i = ind.groupBy(F.year(indicator_date).cast("bigint").alias("ano"),
                    F.month(indicator_date).cast("bigint").alias("mes")).agg(
        (F.sum(F.col(indicator).cast(RATE_TYPE)).cast("double") / F.count(F.lit(1)))
        .alias(f"{indicator}_medio"))
    return s.join(i, ["ano", "mes"], "left")


def store_ranking(attainment: DataFrame, partition: Sequence[str] = ("ano", "mes"),
                  metric: str = "pct_meta", rank_col: str = "posicao") -> DataFrame:
    """Rank stores within each month by attainment (best first, NULLs last).

    The mart is already aggregated to month x store, so the window's
    partitions are small.
    """
    w = Window.partitionBy(*partition).orderBy(F.col(metric).desc_nulls_last())
    return attainment.withColumn(rank_col, F.rank().over(w).cast("bigint"))


def target_plan(keys: DataFrame, base_year: int | Column, base: float = TARGET_BASE,
                growth: float = TARGET_GROWTH,
                seasonality: dict[int, float] | None = None) -> DataFrame:
    """Targets per ``(ano, mes, loja_id, categoria)`` key from the growth rule.

    ``meta_valor = round(base * (1 + growth) ** (ano - base_year) * season(mes), 2)``.
    ``keys`` is any frame with those four columns (duplicates are dropped
    with a partial aggregate), e.g. the combinations observed in the data.
    """
    season = seasonal_factor("mes", TARGET_SEASONALITY if seasonality is None else seasonality)
    distinct = keys.select("ano", "mes", "loja_id", "categoria").dropDuplicates()
    value = F.round(F.lit(base) * growth_factor("ano", base_year, growth) * season, 2)
    return distinct.select(F.col("ano").cast("bigint").alias("ano"),
                           F.col("mes").cast("bigint").alias("mes"),
                           F.col("loja_id").cast("bigint").alias("loja_id"),
                           "categoria", value.alias("meta_valor"))

