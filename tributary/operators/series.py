"""Align several dated series into one row per date (chained full outer joins).

The series are aggregates (one row per date), so these joins are small; the
expensive part is the per-series aggregation upstream, which Spark runs with
partial (map-side) aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_MODES = ("first_two", "all")


def align_series(series: Sequence[tuple[DataFrame, str]], key_mode: str = "first_two",
                 date_col: str = "data") -> DataFrame:
    """Full-outer-join ``[(df, value_col), ...]`` on their date column.

    Each ``df`` has ``date_col`` and ``value_col``.  The second series joins
    on the first one's date; every later series joins on the coalesced date
    of the previous ones.

    ``key_mode="first_two"`` (faithful to the original model) reports the
    date as ``coalesce(first.date, second.date)``: a row present only in a
    later series comes out with a NULL date.  ``key_mode="all"`` coalesces
    over every series, so such a row keeps its own date.
    """
    if key_mode not in KEY_MODES:
        raise ValueError(f"key_mode must be one of {KEY_MODES}")
    if len(series) < 2:
        raise ValueError("need at least two series")
    parts = []
    for i, (df, value_col) in enumerate(series):
        parts.append(df.select(F.col(date_col).alias(f"__k{i}"), F.col(value_col)))
    acc = parts[0]
    key = F.col("__k0")
    for i, part in enumerate(parts[1:], start=1):
        acc = acc.join(part, key == F.col(f"__k{i}"), "full_outer")
        if i == 1 or key_mode == "all":
            acc = acc.withColumn("__key", F.coalesce(*[F.col(f"__k{j}") for j in range(i + 1)]))
            key = F.col("__key")
    values = [value_col for _, value_col in series]
    return acc.select(F.col("__key").alias(date_col), *values)


def align_series_long(df: DataFrame, names: Sequence[str], key_mode: str = "first_two",
                      series_col: str = "serie", date_col: str = "data",
                      value_col: str = "valor") -> DataFrame:
    """``align_series`` for series stored as one long table
    ``(series_col, date_col, value_col)`` with at most one row per series and
    date, NULL dates included (e.g. one aggregate, or one API response per
    series).

    Same result as the chained full outer joins, but one grouped aggregate:
    one shuffle and one scan of the source instead of one per series plus a
    shuffle per join.  A NULL date never matches in a join, so a NULL-date
    row is grouped with its series name and stays a row of its own.
    """
    if key_mode not in KEY_MODES:
        raise ValueError(f"key_mode must be one of {KEY_MODES}")
    if len(names) < 2:
        raise ValueError("need at least two series")
    s, d = F.col(series_col), F.col(date_col)
    rows = df.where(s.isin(list(names)))
    values = [F.max(F.when(s == n, F.col(value_col))).alias(n) for n in names]
    in_first_two = F.max(s.isin(list(names[:2])).cast("int")) == 1
    grouped = rows.groupBy(d.alias("__d"), F.when(d.isNull(), s).alias("__nd")).agg(
        *values, in_first_two.alias("__lead"))
    key = F.col("__d") if key_mode == "all" else F.when(F.col("__lead"), F.col("__d"))
    return grouped.select(key.cast(df.schema[date_col].dataType).alias(date_col), *names)
