"""Sums and counts per group that follow a changing table by subtracting old rows and adding new ones.

Money is summed as exact decimals, so that what is subtracted is what was
added; a group whose rows are all gone is dropped, and a sum over rows without
a value is NULL again.  The result equals the aggregate over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.numeric import money
from tributary.storage.tables import Table

SUM_TYPE = "decimal(38,2)"


def group_sums(rows: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Per group: exact sum of ``measure``, number of rows that have it, number of rows."""
    return rows.groupBy(*keys).agg(F.coalesce(F.sum(money(measure)), F.lit(0)).cast(SUM_TYPE).alias("total"),
                                   F.count(measure).alias("n_valued"), F.count(F.lit(1)).alias("n_rows"))


def added(sums: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """``sums`` without the sums ``old`` and with the sums ``new``; groups without rows are dropped."""
    keys = [c for c in sums.columns if c not in ("total", "n_valued", "n_rows")]
    less = old.select(*keys, *[(-F.col(c)).cast(sums.schema[c].dataType).alias(c) for c in ("total", "n_valued", "n_rows")])
    union = sums.unionByName(less).unionByName(new)
    return (union.groupBy(*keys).agg(F.sum("total").cast(SUM_TYPE).alias("total"), F.sum("n_valued").alias("n_valued"),
                                     F.sum("n_rows").alias("n_rows")).where(F.col("n_rows") > 0))


class MaintainedSums:
    """``group_sums`` of a table, stored at ``root`` with the commit of the table that they are of."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], measure: str):
        self.table, self.keys, self.measure = Table(spark, root), list(keys), measure

    def source(self) -> int | None:
        """The commit of the source that the stored sums are of."""
        entry = self.table.head()[1]
        return entry["meta"].get("source") if entry else None

    def read(self) -> DataFrame:
        return self.table.read()

    def rebuild(self, rows: DataFrame, source: int) -> DataFrame:
        self.table.replace(group_sums(rows, self.keys, self.measure), meta={"source": source})
        return self.read()

    def apply(self, old: DataFrame, new: DataFrame, base: int, source: int) -> DataFrame:
        """Follow the source from commit ``base`` to ``source``: rows ``old`` went and rows ``new`` came.

        Refused unless the stored sums are of ``base``, so that no change
        counts twice or is missed.
        """
        if self.source() != base:
            raise ValueError(f"sums are of commit {self.source()}, not {base}")
        if base != source:
            self.table.replace(added(self.read(), group_sums(old, self.keys, self.measure),
                                     group_sums(new, self.keys, self.measure)), meta={"source": source})
        return self.read()
