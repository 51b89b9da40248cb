"""One row per key: newest version of a change log, or a conformed dimension.

Both are ``row_number() = 1`` over a key window.  Spark plans this as a
``WindowGroupLimit`` on *both* sides of the shuffle, so every map task
forwards at most one row per key: a key holding a third of all rows costs
one row of shuffle per map task, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _asc(c: Column | str) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def _desc(c: Column | str) -> Column:
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


def _simple_type(df: DataFrame, name: str) -> bool:
    kind = df.schema[name].dataType.typeName()
    return kind not in ("map", "array", "struct", "variant", "binary")


def _remaining(df: DataFrame, used: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in used and _simple_type(df, c)]


def top_one_per_key(df: DataFrame, keys: Sequence[str],
                    ordering: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key group under ``ordering``."""
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def version_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = ("_loaded_at",),
                  tiebreak: Sequence[Column | str] | None = None) -> list[Column]:
    """Newest first: ``order_by`` descending (NULLs last), then ``tiebreak`` (default: all other columns) ascending."""
    order = [_desc(c) for c in order_by]
    if tiebreak is None:
        used = list(keys) + [c for c in order_by if isinstance(c, str)]
        tiebreak = _remaining(df, used)
    return order + [_asc(c) for c in tiebreak]


def latest_version(df: DataFrame, keys: Sequence[str],
                   order_by: Sequence[Column | str] = ("_loaded_at",),
                   tiebreak: Sequence[Column | str] | None = None) -> DataFrame:
    """Newest version per key of an append-only log.

    ``order_by`` names are sorted newest first (descending, NULLs last).
    Rows that tie on ``order_by`` are resolved by ``tiebreak`` (ascending by
    default over every other column), so the surviving row is deterministic
    instead of arbitrary.
    """
    return top_one_per_key(df, keys, version_order(df, keys, order_by, tiebreak))


def conform_dimension(df: DataFrame, key: str | Sequence[str],
                      order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Exactly one row per dimension key.

    The kept row is the first under ``order_by`` (ascending); by default all
    non-key columns, so the result does not depend on input order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if order_by is None:
        order_by = _remaining(df, keys)
    return top_one_per_key(df, keys, [_asc(c) for c in order_by])
