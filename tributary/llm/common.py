"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_path

# A word is a maximal run of characters other than these six (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever they run.

    Functions are sent to workers by reference; the zipped package goes along
    once per application, so that no folder has to be shared for code.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tributary_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):
        handle, target = tempfile.mkstemp(prefix="tributary-", suffix=".zip")
        os.close(handle)
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        sc.addPyFile(target)
        atexit.register(lambda: os.path.exists(target) and os.remove(target))
    sc._tributary_shipped = True


def stored(df: DataFrame, what: str, **options: str) -> DataFrame:
    """``df`` written once to a new folder in shared storage and read back.

    Cuts the lineage at files that survive the loss of executors, and keeps
    an expensive result from being computed twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", what)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(batches, rows: int = 128):
    """The same rows in batches of at most ``rows``, so that what is made of a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with the first number behind it that no taken name has; case counts as Spark reads names, not at all."""
    used = {t.lower() for t in taken}
    names = [name, *(f"{name}_{i}" for i in range(1, len(used) + 2))]
    return next(n for n in names if n.lower() not in used)


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null and for texts of blanks only."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS + "+")).cast("long"), F.lit(0))
