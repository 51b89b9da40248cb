"""CSV files read record by record, by many tasks each, with what is wrong kept apart.

A cell in quotes may hold line breaks, so a task that begins in the middle of a
file does not know by itself whether a line break ends a record.  A first pass
over byte ranges counts quotes and line breaks; a running sum of the counts says
for each range whether it begins inside quotes and at which line.  The second
pass reads the records that begin in its range (the last one to its end, beyond
the range) and turns each into the cells of the declared columns, or a problem.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import _arrow_fs, _hadoop, qualified_path

#: Bytes of a range; a task reads one range at a time and the rest of its last record.
RANGE_BYTES = 32 << 20
_BOM = b"\xef\xbb\xbf"


class TooManyRejects(ValueError):
    """More records than allowed do not fit the declared columns."""


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(file, size) of a CSV file or a folder of part files."""
    fs, make = _hadoop(spark, path)
    status = fs.getFileStatus(make(path))
    found = [status] if status.isFile() else [x for x in fs.listStatus(make(path)) if x.isFile()]
    return [(qualified_path(spark, str(x.getPath().toString())), int(x.getLen())) for x in found
            if x.getPath().getName()[:1] not in "._"]


def _quoted_before(data: np.ndarray, inside: bool) -> np.ndarray:
    """For each byte whether it lies inside quotes, given that the first one does."""
    quotes = data == ord('"')
    return ((np.cumsum(quotes) - quotes + inside) & 1).astype(bool)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            filesystem, path = _arrow_fs(r["file"])
            with filesystem.open_input_file(path) as source:
                data = np.frombuffer(source.read_at(r["stop"] - r["start"], r["start"]), np.uint8)
            yield pa.RecordBatch.from_pylist([{**r, "quotes": int((data == ord('"')).sum()),
                                               "breaks": int((data == ord("\n")).sum())}])


def _records(data: bytes, start: int, inside: bool, source, size: int) -> Iterator[tuple[int, bytes]]:
    """(place in ``data``, bytes) of the records that begin in ``data``, which begins at ``start`` with one byte before it."""
    array = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((array == ord("\n")) & ~_quoted_before(array, inside))
    begins = np.append(ends + 1, 0 if start == 0 else []).astype(int)
    for at in sorted(int(b) for b in begins if b < len(data) and (b >= 1 or start == 0)):
        later = ends[np.searchsorted(ends, at):]
        if len(later):
            yield at, data[at:int(later[0])]
            continue
        rest, place, held = [data[at:]], start + len(data), bool(np.count_nonzero(array[at:] == ord('"')) & 1)
        while place < size:
            more = source.read_at(min(1 << 20, size - place), place)
            found = np.frombuffer(more, np.uint8)
            stops = np.flatnonzero((found == ord("\n")) & ~_quoted_before(found, held))
            rest.append(more[:int(stops[0])] if len(stops) else more)
            if len(stops):
                break
            held ^= bool(np.count_nonzero(found == ord('"')) & 1)
            place += len(more)
        yield at, b"".join(rest)


def _cells(record: bytes) -> tuple[list[str] | None, str | None]:
    try:
        text = record.removesuffix(b"\r").decode()
    except UnicodeDecodeError:
        return None, "not UTF-8"
    try:
        return next(csv.reader(io.StringIO(text, newline=""), strict=True), []), None
    except csv.Error as error:
        return None, f"quotes: {error}"


def _reader(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                filesystem, path = _arrow_fs(r["file"])
                with filesystem.open_input_file(path) as source:
                    size = source.size()
                    # The header tells where the declared columns are; every task of a file reads it.
                    first = next(_records(source.read_at(min(size, 1 << 16), 0), 0, False, source, size), (0, b""))[1]
                    header, problem = _cells(first.removeprefix(_BOM))
                    header = [h.strip().lower() for h in header or []]
                    places = [header.index(n.lower()) if n.lower() in header else None for n in names]
                    before = 0 if r["start"] == 0 else 1
                    data = source.read_at(r["stop"] - r["start"] + before, r["start"] - before)
                    # The byte before the range is a line break or part of a record that began earlier.
                    inside = bool((r["quotes_before"] - (data[:before] == b'"')) & 1)
                    out = []
                    for at, record in _records(data, r["start"] - before, inside, source, size):
                        if r["start"] - before + at == 0 or not record.strip():
                            continue  # the header; blank lines
                        line = r["breaks_before"] - data[:before].count(b"\n") + data.count(b"\n", 0, at) + 1
                        cells, problem = _cells(record)
                        if problem is None and len(cells) != len(header):
                            cells, problem = None, f"{len(cells)} cells instead of {len(header)}"
                        out.append({"file": r["file"], "line": line, "record": record.decode(errors="replace"),
                                    "cells": None if cells is None else [
                                        None if p is None or cells[p] == "" else cells[p] for p in places], "problem": problem})
                        if len(out) == 4096:
                            yield pa.RecordBatch.from_pylist(out, _SCHEMA)
                            out = []
                    if out:
                        yield pa.RecordBatch.from_pylist(out, _SCHEMA)
    return run


_SCHEMA = pa.schema([("file", pa.string()), ("line", pa.int64()), ("record", pa.string()),
                     ("cells", pa.list_(pa.string())), ("problem", pa.string())])
RECORDS = "file string, line long, record string, cells array<string>, problem string"


def read_records(spark: SparkSession, path: str, names: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record behind the header: (file, line, record, cells in the order of ``names``, problem).

    ``line`` is the line of the file on which the record begins, from 1.  A
    column that a file lacks is NULL, so is an empty cell.  ``problem`` is NULL
    for a record that can be cut into as many cells as the header has; else it
    says what is wrong and ``cells`` is NULL.  A quote is taken to open or close
    a quoted cell wherever it stands: one that is missing spoils the records up
    to the next one.
    """
    ranges = [(f, at, min(at + range_bytes, size)) for f, size in _files(spark, path) for at in range(0, size, range_bytes)]
    if not ranges:
        return spark.createDataFrame([], RECORDS)
    planned = spark.createDataFrame(ranges, "file string, start long, stop long").repartition(len(ranges))
    counted = planned.mapInArrow(_counts, "file string, start long, stop long, quotes long, breaks long")
    # One row per range.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = counted.select("file", "start", "stop", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
                                                      for c in ("quotes", "breaks")])
    return known.repartition(len(ranges), "file", "start").mapInArrow(_reader(names), RECORDS)


def typed_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records with their cells cast to ``schema`` and ``reason``: what does not fit, NULL if all does."""
    cells = [F.get("cells", F.lit(i)) for i in range(len(schema.fields))]
    typed = [c.try_cast(f.dataType) for c, f in zip(cells, schema.fields)]
    wrong = [F.when(c.isNotNull() & t.isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
             for c, t, f in zip(cells, typed, schema.fields)]
    reason = F.concat_ws("; ", "problem", *wrong)
    return records.select(*[t.alias(f.name) for t, f in zip(typed, schema.fields)], F.col("file").alias("__file"),
                          F.col("line").alias("__line"), F.col("record").alias("__record"),
                          F.when(reason != "", reason).alias("__reason"))


def split_rejects(typed: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, rejects as (file, line, record, reason)) of stored ``typed_records``."""
    good = typed.where(F.col("__reason").isNull()).select(*schema.names)
    bad = typed.where(F.col("__reason").isNotNull()).select(
        F.col("__file").alias("file"), F.col("__line").alias("line"), F.col("__record").alias("record"),
        F.col("__reason").alias("reason"))
    return good, bad
