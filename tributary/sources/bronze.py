"""Bronze layer: audit columns, type normalisation and table writes.

Rows never pass through the driver: normalisation is a ``select`` of
built-in expressions, writes are distributed, and the loaded row count is
collected by an ``Observation`` on the same pass as the write.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.dates import iso_date_text, iso_text
from tributary.functions.numeric import (coerce_double, coerce_kind, coerce_long,
                                         comma_decimal)
from tributary.storage.tables import Table, Written

AUDIT_COLUMNS = ("_loaded_at", "_source")

#: Small loads of an append log that are put together.
COMPACT_LOADS = 16

log = logging.getLogger(__name__)


def with_audit(df: DataFrame, loaded_at: str, source: str) -> DataFrame:
    """Add ``_loaded_at`` (one ISO stamp per run) and ``_source`` columns."""
    return df.withColumns({"_loaded_at": F.lit(loaded_at), "_source": F.lit(source)})


def normalise_types(df: DataFrame) -> DataFrame:
    """Make every column JSON-friendly the way the loader did.

    Timestamps become ISO-8601 text (``isoformat``), dates ``yyyy-MM-dd``,
    decimals become double; everything else is kept.  Driven by the schema,
    so it is one projection.
    """
    cols: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = iso_text(c)
        elif isinstance(f.dataType, T.DateType):
            c = iso_date_text(c)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def coerce_cells(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per-cell numeric coercion of text columns: int, else float, else text.

    A column cannot hold mixed types, so each cell becomes three typed
    columns plus its kind: ``<c>_kind`` (``int``/``float``/``string``),
    ``<c>_long``, ``<c>_double`` and the untouched ``<c>`` text.
    """
    names = columns or [f.name for f in df.schema.fields
                        if isinstance(f.dataType, T.StringType)]
    extra = {}
    for n in names:
        extra[f"{n}_kind"] = coerce_kind(n)
        extra[f"{n}_long"] = coerce_long(n)
        extra[f"{n}_double"] = coerce_double(n)
    return df.withColumns(extra)


def normalise_series_rows(rows: DataFrame, permissive: bool = False) -> DataFrame:
    """API rows ``(data text, valor text, ...)`` → ``valor`` as double.

    A decimal comma becomes a point; a malformed number fails the load
    unless ``permissive`` (then NULL).  Other columns pass through.
    """
    return rows.withColumns({"data": F.col("data").cast("string"),
                             "valor": comma_decimal("valor", permissive)})


@dataclass
class LoadResult:
    path: str
    rows: int
    written: bool


def _result(path: str, written: Written, mode: str) -> LoadResult:
    log.info("%s: %d rows loaded (%s)", path, written.rows, mode) if written.number is not None else log.info(
        "%s: nothing to load", path)
    return LoadResult(path, written.rows, written.number is not None)


def _clustered(df: DataFrame, cluster_by: list[str] | None) -> DataFrame:
    # Rows sorted by the cursor inside each file: Parquet min/max
    # statistics then let later cursor filters skip whole row groups.
    return df.sortWithinPartitions(*cluster_by) if cluster_by else df


def write_truncate(df: DataFrame, path: str, partition_by: list[str] | None = None, skip_empty: bool = False,
                   cluster_by: list[str] | None = None) -> LoadResult:
    """Replace the table published at ``path`` (truncate-load) and report the row count.

    The source is read once: rows are counted as they are written, and a load
    without rows is dropped afterwards with ``skip_empty``.  A load that fails
    or is lost leaves the table as it was (``storage.tables``).
    """
    table = Table(df.sparkSession, path)
    return _result(path, table.replace(_clustered(df, cluster_by), partition_by or (), skip_empty=skip_empty), "truncate")


def write_append(df: DataFrame, path: str, cluster_by: list[str] | None = None,
                 stats: list[str] | None = None, compact: bool = True, in_order: bool = False) -> LoadResult:
    """Append a batch to the log published at ``path``; an empty batch writes nothing.

    ``cluster_by`` sorts rows within each written file (the extraction's
    ``ORDER BY cursor`` becomes file clustering; a table keeps no order), unless
    the batch comes ``in_order`` of it; its
    first column, the load stamp and ``stats`` are kept as smallest and largest
    value per load, so that reads above a cursor skip whole loads.  Small loads
    are put together once there are some.  A column that is new in the batch
    becomes a column of the log; one of a type that does not fit is refused.
    """
    table = Table(df.sparkSession, path)
    columns = [c for c in dict.fromkeys([*(cluster_by or [])[:1], AUDIT_COLUMNS[0], *(stats or [])]) if c in df.columns]
    done = table.append(df if in_order else _clustered(df, cluster_by), stats=columns)
    if compact and cluster_by and done.number is not None:
        table.compact(cluster_by[0], least=COMPACT_LOADS)
    return _result(path, done, "append")
