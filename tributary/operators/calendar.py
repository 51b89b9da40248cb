"""Calendar dimension: one row per day with its date parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.dates import day_name, is_weekend, month_name, sunday_week

# The original calendar starts on 2023-01-01 and has 1,096 days.
DEFAULT_START = "2023-01-01"
DEFAULT_DAYS = 1096


def calendar_from_dates(dates: DataFrame, date_col: str = "data") -> DataFrame:
    """Add the calendar attributes to a frame of dates."""
    d = F.col(date_col)
    return dates.select(
        d.alias("data"),
        F.year(d).cast("bigint").alias("ano"),
        F.month(d).cast("bigint").alias("mes"),
        F.dayofmonth(d).cast("bigint").alias("dia"),
        sunday_week(d).alias("semana"),
        F.quarter(d).cast("bigint").alias("trimestre"),
        month_name(d).alias("mes_nome"),
        day_name(d).alias("dia_semana"),
        is_weekend(d).alias("fim_de_semana"),
    )


def calendar(spark: SparkSession, start: str | dt.date = DEFAULT_START,
             n_days: int = DEFAULT_DAYS, num_partitions: int | None = None) -> DataFrame:
    """``n_days`` consecutive days from ``start`` (inclusive).

    Days are generated by ``spark.range`` across ``num_partitions`` tasks,
    so even a very long calendar is not built in a single task.
    """
    start_lit = F.lit(str(start)).cast("date")
    days = spark.range(0, n_days, 1, num_partitions).select(
        F.date_add(start_lit, F.col("id").cast("int")).alias("data"))
    return calendar_from_dates(days)


def calendar_covering(df: DataFrame, col: str) -> DataFrame:
    """Calendar spanning the first to the last date of ``df[col]``.

    Only the two bounds reach the driver (one partial/final aggregate).
    """
    spark = df.sparkSession
    bounds = df.agg(F.min(F.to_date(F.col(col))).alias("lo"),
                    F.max(F.to_date(F.col(col))).alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return calendar(spark, DEFAULT_START, 0)
    n_days = (bounds["hi"] - bounds["lo"]).days + 1
    return calendar(spark, bounds["lo"], n_days)
