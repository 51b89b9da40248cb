"""File landing zone: CSV targets and store lists dropped by the business.

A file is looked up by its exact name in the landing folder; a missing file
is reported and skipped, and the table it feeds keeps its previous content.
Columns are taken by the names in the header and cast to the declared schema
(no inference pass over the data).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import path_exists, scratch_path
from tributary.sources.bronze import LoadResult, coerce_cells, with_audit, write_append, write_truncate
from tributary.sources.csv_records import TooManyRejects, read_records, split_rejects, typed_records

log = logging.getLogger(__name__)

# Declared schemas of the two landing files.
TARGETS_CSV_SCHEMA = T.StructType([
    T.StructField("ano", T.LongType()),
    T.StructField("mes", T.LongType()),
    T.StructField("loja_id", T.LongType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("meta_valor", T.DoubleType()),
])
STORES_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("nome", T.StringType()),
    T.StructField("cidade", T.StringType()),
    T.StructField("uf", T.StringType()),
    T.StructField("regiao", T.StringType()),
])

# Landing file name -> bronze table it replaces.
LANDING_FILES = {
    "metas_vendas.csv": ("files_metas_vendas", TARGETS_CSV_SCHEMA),
    "lojas.csv": ("files_lojas", STORES_CSV_SCHEMA),
}
FILES_SOURCE_TAG = "landing_files"
# Folder of the tables of records that did not fit.
REJECTS = "_rejects"


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as UTF-8 CSV with a header row (one folder of part files)."""
    (df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8")
     .option("quoteAll", False).option("escape", '"').csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             permissive: bool = False, multi_line: bool = False) -> DataFrame:
    """Read a landed CSV file (or folder of part files) by the names in its header.

    With ``schema`` its columns are taken by name in whatever order the file
    has them and cast; a declared column that the file lacks is NULL, others
    are left out.  A malformed value fails the load unless ``permissive`` (then
    NULL).  Without ``schema`` all columns are kept and coerced cell by cell
    (``coerce_cells``).  Quotes inside quoted text are doubled.  Files are split
    among tasks unless cells hold line breaks (``multi_line``).
    """
    rows = (spark.read.option("header", True).option("encoding", "UTF-8").option("quote", '"')
            .option("escape", '"').option("multiLine", multi_line)
            .option("mode", "PERMISSIVE" if permissive else "FAILFAST").csv(path))
    if schema is None:
        return coerce_cells(rows)
    present = {c.strip().lower(): c for c in rows.columns}
    columns = []
    for f in schema.fields:
        if f.name.lower() not in present:
            log.warning("%s has no column %s", path, f.name)
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        cell = F.col(f"`{present[f.name.lower()]}`")
        columns.append((cell.try_cast(f.dataType) if permissive else cell.cast(f.dataType)).alias(f.name))
    return rows.select(*columns)


def find_files(spark: SparkSession, landing: str, names: list[str]) -> dict[str, str]:
    """``{name: path}`` for the names present in the landing folder."""
    found = {}
    for name in names:
        path = f"{landing.rstrip('/')}/{name}"
        if path_exists(spark, path):
            found[name] = path
    return found


def ingest_files(spark: SparkSession, landing: str, bronze_root: str, loaded_at: str,
                 files: dict[str, tuple[str, T.StructType | None]] | None = None,
                 most_rejected: float = 0.0) -> dict[str, LoadResult | None]:
    """Truncate-load every landed file into ``<bronze_root>/<table>``.

    Missing files are skipped (``None`` in the result, old table kept);
    empty files write nothing.  A file listed without a schema is undeclared:
    its cells are coerced one by one.  With ``most_rejected`` above 0 up to that
    share of a declared file's records may be wrong: they go to
    ``<bronze_root>/_rejects/<table>`` and the rest is loaded; cells may then
    hold line breaks, and the file is still split among tasks.
    """
    files = LANDING_FILES if files is None else files
    present = find_files(spark, landing, list(files))
    results: dict[str, LoadResult | None] = {}
    for name, (table, schema) in files.items():
        if name not in present:
            log.warning("%s not found in %s - skipped", name, landing)
            results[name] = None
            continue
        root = bronze_root.rstrip("/")
        if schema is not None and most_rejected > 0:
            rows = _accepted(spark, present[name], schema, loaded_at, f"{root}/{REJECTS}/{table}", most_rejected)
        else:
            rows = read_csv(spark, present[name], schema)
        results[name] = write_truncate(with_audit(rows, loaded_at, FILES_SOURCE_TAG), f"{root}/{table}",
                                       skip_empty=True)
    return results


def _accepted(spark: SparkSession, path: str, schema: T.StructType, loaded_at: str, rejects: str,
              most_rejected: float) -> DataFrame:
    """The records of a file that fit; the others are appended to the table ``rejects``.

    Raises ``TooManyRejects`` beyond the allowed share, before any table changes.
    """
    scratch = scratch_path(spark, "csv_records")
    typed = typed_records(read_records(spark, path, schema.names), schema)
    typed.write.parquet(scratch)
    good, bad = split_rejects(spark.read.schema(typed.schema).parquet(scratch), schema)
    n_good, n_bad = good.count(), bad.count()
    if n_bad > most_rejected * (n_good + n_bad):
        raise TooManyRejects(f"{path}: {n_bad} of {n_good + n_bad} records do not fit")
    write_append(with_audit(bad, loaded_at, FILES_SOURCE_TAG), rejects)
    return good
