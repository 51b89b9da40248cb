"""Incremental extraction from a relational source into the bronze log.

The source is read with Spark's JDBC reader, split into parallel range
partitions on the primary key, and the cursor predicate is pushed into the
SQL sent to the database (``PushedFilters``).  The watermark is one scalar
aggregate over the bronze table.  Extraction order is not kept: a table has
no order, so the source's ``ORDER BY`` is dropped.
"""

from __future__ import annotations

import datetime as dt
import inspect
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.dates import EPOCH_TEXT, iso_text
from tributary.sources.bronze import LoadResult, normalise_types, with_audit, write_append
from tributary.storage.tables import Table, read_table, was_loaded


@dataclass(frozen=True)
class TableSpec:
    """One source table: its cursor column and primary key."""

    name: str
    cursor: str
    key: str = "id"
    # Columns besides the cursor whose smallest and largest value each load keeps.
    stats: tuple[str, ...] = ()


# The five ERP tables, their cursor column and key, in load order.
ERP_TABLES = (
    TableSpec("clientes", "updated_at"),
    TableSpec("lojas", "created_at"),
    TableSpec("produtos", "created_at"),
    TableSpec("vendas", "updated_at", stats=("data_venda",)),
    TableSpec("itens_venda", "created_at"),
)


def high_water_mark(bronze: DataFrame | None, column: str = "_loaded_at") -> DataFrame:
    """One row, column ``watermark``: the largest ``column`` value as ISO text,
    or the epoch when the table is empty.

    A global ``max`` is a partial aggregate per task and a one-row final
    aggregate, whatever the table size.
    """
    if bronze is None:
        raise ValueError("bronze table is required; use watermark_or_epoch for a missing one")
    dtype = bronze.schema[column].dataType
    top = F.max(F.col(column))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        top = iso_text(top)
    else:
        top = top.cast("string")
    return bronze.agg(F.coalesce(top, F.lit(EPOCH_TEXT)).alias("watermark"))


def watermark_or_epoch(spark: SparkSession, bronze_path: str,
                       column: str = "_loaded_at") -> str:
    """The watermark of the bronze table at ``bronze_path`` as a Python string.

    Only a missing table falls back to the epoch (full load); any other
    error propagates instead of silently re-appending everything.
    """
    if not was_loaded(spark, bronze_path):
        return EPOCH_TEXT
    # A log's commit knows the largest value of each load; no file is opened.
    known = Table(spark, bronze_path).largest(column)
    return known if isinstance(known, str) else high_water_mark(read_table(spark, bronze_path), column).first()["watermark"]


def incremental_extract(source: DataFrame, cursor: str, since: str,
                        loaded_at: str, source_tag: str = "", in_order: bool = False) -> DataFrame:
    """Rows with ``cursor > since``, normalised and stamped for the bronze log.

    ``since`` is ISO text (the bronze watermark).  The comparison is on the
    source column's own type, so the predicate reaches the scan (Parquet
    row-group statistics, or the ``WHERE`` clause of a JDBC query).  ``in_order``
    sorts each partition by the cursor while it is a number or moment, whose
    order its text has too and which compares faster.
    """
    dtype = source.schema[cursor].dataType
    bound = F.lit(since)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        bound = bound.cast(dtype)
    elif isinstance(dtype, T.DateType):
        bound = F.to_date(bound)
    rows = source.where(F.col(cursor) > bound)
    if in_order:
        rows = rows.sortWithinPartitions(cursor)
    return with_audit(normalise_types(rows), loaded_at, source_tag)


def earlier(since: str, by: dt.timedelta) -> str:
    """ISO text of the moment ``by`` before ``since``; not before the epoch."""
    moment = dt.datetime.fromisoformat(since) - by
    return max(moment.isoformat(), EPOCH_TEXT)


def late_rows(source: DataFrame, spec: TableSpec, since: str, late: dt.timedelta, loaded_at: str,
              source_tag: str, log: Table) -> DataFrame:
    """Rows after ``since``, and those up to ``late`` before it that the log does not hold yet.

    A row that was committed late, or whose clock was behind, has a cursor
    below the watermark.  Rows of the overlap are compared with the (key,
    cursor) pairs the log has from there on, so each arrives once; loads that
    end before the overlap are not opened.  Both sides of the comparison are as
    long as the overlap, not as the table; rows beyond the watermark are not
    compared if the watermark is the log's largest cursor.
    """
    low = earlier(since, late)
    rows = incremental_extract(source, spec.cursor, low, loaded_at, source_tag)
    held = log.read_above(spec.cursor, low).select(
        F.col(spec.key).alias("__key"), F.col(spec.cursor).alias("__cursor")).distinct()
    return rows.join(held, F.col(spec.key).eqNullSafe(F.col("__key")) & (F.col(spec.cursor) == F.col("__cursor")),
                     "left_anti")


def read_jdbc_table(spark: SparkSession, url: str, table: str, key: str,
                    lower: int, upper: int, num_partitions: int,
                    properties: dict[str, str] | None = None) -> DataFrame:
    """A source table as ``num_partitions`` parallel range reads on ``key``.

    Without ``partitionColumn`` the JDBC reader uses a single task; the key
    range comes from the caller (e.g. ``min``/``max`` of the key).
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", key).option("lowerBound", str(lower))
              .option("upperBound", str(upper)).option("numPartitions", str(num_partitions))
              .option("fetchsize", "10000"))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


#: Keys that a range read covers at least, so that small batches open few connections.
KEYS_PER_READ = 50_000


def bounds_query(spec: TableSpec, since: str | None = None) -> str:
    """The key range of the rows to extract: new rows sit at the top of the key range."""
    new = f" WHERE {spec.cursor} > '{since}'" if since is not None else ""
    return f"(SELECT MIN({spec.key}) AS lo, MAX({spec.key}) AS hi FROM {spec.name}{new}) bounds"


def range_reads(low: int, high: int, most: int) -> int:
    """Number of range reads over a key range, ``most`` at most."""
    return max(1, min(most, (high - low) // KEYS_PER_READ + 1))


def jdbc_source(spark: SparkSession, url: str, properties: dict[str, str] | None = None,
                num_partitions: int = 16):
    """``read_source`` for ``ingest_incremental`` over a JDBC database.

    Each table is read as up to ``num_partitions`` parallel range scans on its
    key; the key range of the rows after ``since`` comes from one ``min``/``max``
    query pushed to the database, so the new rows are dealt evenly.  The cursor
    filter applied afterwards is pushed into every range query's ``WHERE`` clause.
    """
    def read(spec: TableSpec, since: str | None = None) -> DataFrame:
        reader = (spark.read.format("jdbc").option("url", url)
                  .option("dbtable", bounds_query(spec, since)))
        for k, v in (properties or {}).items():
            reader = reader.option(k, v)
        row = reader.load().first()
        lo, hi = (row["lo"], row["hi"]) if row is not None else (None, None)
        if lo is None:   # empty table: a single, trivially cheap read
            lo, hi, parts = 0, 0, 1
        else:
            parts = range_reads(int(lo), int(hi), num_partitions)
        return read_jdbc_table(spark, url, spec.name, spec.key, int(lo), int(hi), parts,
                               properties)
    return read


def ingest_incremental(spark: SparkSession, read_source, bronze_root: str,
                       loaded_at: str, tables=ERP_TABLES, source_prefix: str = "erp",
                       watermark_on_cursor: bool = False,
                       late: dt.timedelta | None = None, threads: int = 4) -> dict[str, LoadResult]:
    """Load every table's new rows into ``<bronze_root>/erp_<table>`` (append).

    ``read_source(spec) -> DataFrame`` returns the source table (JDBC, files,
    ...); one that takes a second argument gets the watermark.  ``loaded_at`` is fixed once per run.  Empty batches write nothing.

    The watermark is ``max(_loaded_at)`` of the bronze table (the extraction
    clock), compared with the source's cursor column, as in the original
    loader.  That misses rows whose cursor is older than the previous run's
    clock (late commits, clock skew); ``watermark_on_cursor=True`` uses the
    largest loaded *cursor* value instead.  With ``late``, rows whose cursor
    lies up to that far behind the watermark are looked at again, and those
    that are not in the log yet are loaded (``late_rows``).
    """
    def one(spec: TableSpec) -> LoadResult:
        path = f"{bronze_root.rstrip('/')}/erp_{spec.name}"
        since = watermark_or_epoch(spark, path,
                                   spec.cursor if watermark_on_cursor else "_loaded_at")
        takes_since = len(inspect.signature(read_source).parameters) > 1
        asked = since if late is None else earlier(since, late)
        source = read_source(spec, asked) if takes_since else read_source(spec)
        tag = f"{source_prefix}.{spec.name}"
        compared = late is not None and since != EPOCH_TEXT
        if compared:
            batch = late_rows(source, spec, since, late, loaded_at, tag, Table(spark, path))
        else:
            batch = incremental_extract(source, spec.cursor, since, loaded_at, tag, in_order=True)
        return write_append(batch, path, cluster_by=[spec.cursor], stats=list(spec.stats), in_order=not compared)

    # The tables do not depend on each other: their jobs are submitted side by side.
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return dict(zip([spec.name for spec in tables], pool.map(one, tables)))


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000,
               mode: str = "append", num_partitions: int | None = None,
               properties: dict[str, str] | None = None) -> None:
    """Insert ``df`` into a relational table in multi-row batches.

    Every task opens its own connection and sends ``batch_size`` rows per
    round trip; ``num_partitions`` caps the concurrent connections (the
    frame is coalesced, not shuffled, to that many tasks).
    """
    if num_partitions is not None:
        df = df.coalesce(num_partitions)
    writer = (df.write.mode(mode).format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", str(batch_size)))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
