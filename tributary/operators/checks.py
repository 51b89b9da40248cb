"""Data-quality checks standing in for the source database's constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (PRIMARY KEY / UNIQUE).

    A grouped count with map-side partial aggregation: a hot key is
    pre-counted in every map task before the shuffle.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str | Sequence[str],
                parent_key: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows whose key has no parent row (FOREIGN KEY), as a left anti join.

    Rows with a NULL key are not orphans (a NULL foreign key is allowed).
    """
    ck = [child_key] if isinstance(child_key, str) else list(child_key)
    pk = ck if parent_key is None else (
        [parent_key] if isinstance(parent_key, str) else list(parent_key))
    p = parent.select(*[F.col(a).alias(f"__p{i}") for i, a in enumerate(pk)]).dropDuplicates()
    cond = [F.col(c) == F.col(f"__p{i}") for i, c in enumerate(ck)]
    not_null = F.lit(True)
    for c in ck:
        not_null = not_null & F.col(c).isNotNull()
    return child.where(not_null).join(p, cond, "left_anti")
