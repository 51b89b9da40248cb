"""Tables under a commit log: published snapshots, append logs, replaced partitions.

Data lies in folders of its own beside the log (``data-<id>``, or
``<k>=<v>/.../__part=<id>`` of a partitioned table).  A commit names the folders
that make up the table, its schema, and per folder its size and the smallest
and largest value of chosen columns.  Writers write folders first and commit
then, so a writer that is lost at any step leaves the table before or the table
after; readers and the catalog follow the newest commit.

A commit is as long as the table has folders; ``compact`` keeps those of an
append log few and ordered by the cursor.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import time
import urllib.parse
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import _hadoop, delete_folder, input_bytes, list_folder, path_exists
from tributary.storage.commits import CommitConflict, CommitLog

PART = "__part"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Folders below half of this many bytes are put together by ``compact``.
TARGET_BYTES = 128 << 20


class SchemaConflict(ValueError):
    """A load whose column does not fit the table's and cannot be widened to."""


_WHOLE = ["tinyint", "smallint", "int", "bigint"]


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds the other's values, or None."""
    if a == b or b == T.NullType():
        return a
    if a == T.NullType():
        return b
    x, y = a.simpleString(), b.simpleString()
    if x in _WHOLE and y in _WHOLE:
        return a if _WHOLE.index(x) > _WHOLE.index(y) else b
    for one, other, kind in ((a, x, y), (b, y, x)):
        if other == "double" and kind in ("float", *_WHOLE[:3]) or other == "timestamp_ntz" and kind == "date":
            return one
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def merge_schema(table: T.StructType, load: T.StructType) -> T.StructType:
    """The table's schema with the load's new columns and wider types; columns are matched by name.

    Columns the load lacks stay (NULL in its rows).  Raises ``SchemaConflict``
    where neither type holds the other's values, for example text for a number.
    """
    given = {f.name: f.dataType for f in load.fields}
    fields = []
    for f in table.fields:
        wide = _wider(f.dataType, given.pop(f.name, f.dataType))
        if wide is None:
            raise SchemaConflict(f"column {f.name}: {load[f.name].dataType.simpleString()} does not fit "
                                 f"{f.dataType.simpleString()}")
        fields.append(T.StructField(f.name, wide))
    return T.StructType(fields + [T.StructField(n, t) for n, t in given.items()])


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: by name, cast, NULL where missing."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def _plain(value):
    """A statistic as JSON holds it; text, numbers and ISO times compare as they did."""
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return float(value) if isinstance(value, decimal.Decimal) else value


@dataclass
class Written:
    """What a write did: the commit (None if nothing was committed) and the number of rows."""

    number: int | None
    rows: int


class Table:
    """The table at ``root``.  ``keep``: newest commits whose folders stay for readers that are under way."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self.log = CommitLog(spark, self.root)

    # ------------------------------------------------------------------ reading

    def head(self) -> tuple[int, dict | None]:
        """Number and content of the newest commit; (-1, None) for a table never published."""
        number = self.log.newest()
        return number, self.log.entry(number) if number >= 0 else None

    def exists(self) -> bool:
        return self.log.newest() >= 0

    def schema(self, number: int | None = None) -> T.StructType:
        number = self.log.newest() if number is None else number
        return T.StructType.fromJson(json.loads(self.log.entry(number)["schema"]))

    def schema_history(self) -> list[tuple[int, T.StructType]]:
        """(commit, schema) wherever the schema changed, of the commits that are kept."""
        out: list[tuple[int, T.StructType]] = []
        for number in self.log.numbers():
            schema = self.schema(number)
            if not out or out[-1][1] != schema:
                out.append((number, schema))
        return out

    def read(self, number: int | None = None, parts: Sequence[dict] | None = None) -> DataFrame:
        """The table as of a commit (default: the newest), or only some of its folders."""
        number = self.log.newest() if number is None else number
        if number < 0:
            raise FileNotFoundError(f"{self.root} was never published")
        entry = self.log.entry(number)
        schema = self.schema(number)
        parts = entry["parts"] if parts is None else parts
        if not parts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if entry["partition_by"]:
            reader = reader.option("basePath", self.root)
        return reader.parquet(*[f"{self.root}/{p['path']}" for p in parts]).select(*[f"`{n}`" for n in schema.names])

    def read_above(self, column: str, value) -> DataFrame:
        """Rows with ``column`` > ``value``; folders whose largest value is not above are not opened."""
        _, entry = self.head()
        parts = [p for p in (entry["parts"] if entry else [])
                 if column not in p["stats"] or p["stats"][column][1] is not None and p["stats"][column][1] > value]
        return self.read(parts=parts).where(F.col(column) > F.lit(value))

    def appended_since(self, number: int) -> DataFrame:
        """Rows appended by the commits after ``number`` (compaction may add rows that came before)."""
        _, entry = self.head()
        return self.read(parts=[p for p in (entry["parts"] if entry else []) if p["since"] > number])

    def size_since(self, number: int) -> tuple[int, int]:
        """(bytes, rows) of the folders that ``appended_since`` reads."""
        _, entry = self.head()
        parts = [p for p in (entry["parts"] if entry else []) if p["since"] > number]
        return sum(p["bytes"] for p in parts), sum(p["rows"] for p in parts)

    def extremes(self, column: str) -> tuple | None:
        """(smallest, largest) value of a column from the statistics of the commit; None without rows or statistics."""
        _, entry = self.head()
        found = [p["stats"].get(column) for p in (entry["parts"] if entry else [])]
        if None in found:
            return None
        lows, highs = [x[0] for x in found if x[0] is not None], [x[1] for x in found if x[1] is not None]
        return (min(lows), max(highs)) if lows else None

    def largest(self, column: str):
        """The largest value of a column by the same statistics."""
        found = self.extremes(column)
        return found and found[1]

    # ------------------------------------------------------------------ writing

    def _write(self, df: DataFrame, partition_by: Sequence[str], stats: Sequence[str]) -> tuple[list[dict], int]:
        """Write a folder (one per partition value) that no commit names yet; its parts and row count."""
        name = uuid.uuid4().hex
        measures = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(stats):
            measures += [F.min(c).alias(f"low{i}"), F.max(c).alias(f"high{i}")]
        seen = Observation()
        observed = df.observe(seen, *measures)
        if partition_by:
            observed.withColumn(PART, F.lit(name)).write.mode("append").partitionBy(*partition_by, PART).parquet(self.root)
        else:
            observed.write.parquet(f"{self.root}/data-{name}")
        got = seen.get
        rows = int(got["rows"])
        if not partition_by:
            path = f"data-{name}"
            if not rows:
                delete_folder(self.spark, f"{self.root}/{path}")
                return [], 0
            found = {c: [_plain(got[f"low{i}"]), _plain(got[f"high{i}"])] for i, c in enumerate(stats)}
            size = input_bytes(self.spark, [f"{self.root}/{path}"])
            return [{"path": path, "bytes": size, "rows": rows, "stats": found}], rows
        fs, make = _hadoop(self.spark, self.root)
        pattern = "/".join([self.root, *[f"{c}=*" for c in partition_by], f"{PART}={name}"])
        found = fs.globStatus(make(pattern)) or []
        base = str(fs.makeQualified(make(self.root)).toUri().getPath()).rstrip("/") + "/"
        paths = sorted(str(x.getPath().toUri().getPath()).removeprefix(base) for x in found)
        return [{"path": p, "stats": {}} for p in paths], rows

    def _commit(self, build: Callable[[int, dict | None], dict | None], tries: int = 20) -> int | None:
        """Commit what ``build`` makes of the newest commit; anew if another writer was first."""
        for _ in range(tries):
            number, entry = self.head()
            made = build(number, entry)
            if made is None:
                return None
            made["at"] = dt.datetime.now(dt.timezone.utc).isoformat()
            try:
                self.log.put(number + 1, made)
            except CommitConflict:
                continue
            self._clean()
            return number + 1
        raise CommitConflict(f"{self.root}: other writers kept committing")

    def replace(self, df: DataFrame, partition_by: Sequence[str] = (), stats: Sequence[str] = (),
                skip_empty: bool = False, meta: dict | None = None) -> Written:
        """Publish ``df`` as the table's whole content; with ``skip_empty`` an empty load leaves the table."""
        partition_by = list(partition_by)
        parts, rows = self._write(df, partition_by, stats)
        if skip_empty and not rows:
            return Written(None, 0)
        number = self._commit(lambda n, _: {
            "op": "replace", "schema": df.schema.json(), "partition_by": partition_by, "meta": meta or {},
            "parts": [{**p, "since": n + 1} for p in parts]})
        return Written(number, rows)

    def append(self, df: DataFrame, stats: Sequence[str] = (), meta: dict | None = None) -> Written:
        """Add the rows of ``df``; an empty load commits nothing.

        Columns are matched by name: new ones and wider types change the
        table's schema, others are refused before anything is written.
        """
        _, entry = self.head()
        schema = df.schema if entry is None else merge_schema(self.schema(), df.schema)
        parts, rows = self._write(aligned(df, schema), (), [c for c in stats if c in df.columns])
        if not rows:
            return Written(None, 0)

        def build(n: int, entry: dict | None) -> dict:
            now = schema if entry is None else merge_schema(
                T.StructType.fromJson(json.loads(entry["schema"])), schema)
            return {"op": "append", "schema": now.json(), "partition_by": [], "meta": meta or {},
                    "parts": (entry["parts"] if entry else []) + [{**p, "since": n + 1} for p in parts]}
        return Written(self._commit(build), rows)

    def partitions_of(self, values: Sequence[tuple], number: int | None = None) -> list[dict]:
        """The folders of the given partition values."""
        number = self.log.newest() if number is None else number
        entry = self.log.entry(number)
        wanted = {tuple(NULL_PARTITION if v is None else str(v) for v in one) for one in values}
        return [p for p in entry["parts"] if partition_values(p["path"]) in wanted]

    def replace_partitions(self, df: DataFrame, values: Sequence[tuple], base: int, meta: dict | None = None) -> Written:
        """Publish ``df`` as the content of the given partitions; all others keep their folders.

        ``base`` is the commit that ``df`` was made from; raises
        ``CommitConflict`` if there is a newer one.
        """
        by = self.log.entry(base)["partition_by"]
        gone = {p["path"] for p in self.partitions_of(values, base)}
        parts, rows = self._write(df, by, ())

        def build(n: int, entry: dict) -> dict:
            if n != base:
                raise CommitConflict(f"{self.root}: commit {n} came after {base}")
            return {"op": "partitions", "schema": entry["schema"], "partition_by": by, "meta": meta or {},
                    "parts": [p for p in entry["parts"] if p["path"] not in gone]
                    + [{**p, "since": n + 1} for p in parts]}
        return Written(self._commit(build), rows)

    # ------------------------------------------------------------------ upkeep

    def compact(self, cursor: str, target_bytes: int = TARGET_BYTES, least: int = 4) -> int | None:
        """Put small folders of an append log together, as folders of ranges of ``cursor``.

        Rows are dealt by ranges of the cursor and every range is a folder with
        its smallest and largest value, so a read above a cursor value opens a
        few folders however many loads there were.  Nothing is done for fewer
        than ``least`` small folders.
        """
        number, entry = self.head()
        small = [p for p in (entry["parts"] if entry else []) if p["bytes"] < target_bytes / 2]
        if len(small) < least:
            return None
        size = sum(p["bytes"] for p in small)
        columns = sorted({c for p in small for c in p["stats"]} | {cursor})
        n = max(1, math.ceil(size / target_bytes))
        name = uuid.uuid4().hex
        rows = self.read(number, small)
        ranged = rows.repartitionByRange(n, cursor).sortWithinPartitions(cursor) if n > 1 else rows.coalesce(1).sortWithinPartitions(cursor)
        (ranged.withColumn(PART, F.concat(F.lit(f"{name}-"), F.spark_partition_id().cast("string")))
         .write.partitionBy(PART).parquet(f"{self.root}/data-{name}"))
        written = self.spark.read.schema(T.StructType(self.schema(number).fields + [T.StructField(PART, T.StringType())])).parquet(
            f"{self.root}/data-{name}")
        measures = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(columns):
            measures += [F.min(c).alias(f"low{i}"), F.max(c).alias(f"high{i}")]
        made = []
        for r in written.groupBy(PART).agg(*measures).collect():  # one row per folder of ``target_bytes``
            path = f"data-{name}/{PART}={r[PART]}"
            made.append({"path": path, "bytes": input_bytes(self.spark, [f"{self.root}/{path}"]), "rows": r["rows"],
                         "since": max(p["since"] for p in small),
                         "stats": {c: [_plain(r[f"low{i}"]), _plain(r[f"high{i}"])] for i, c in enumerate(columns)}})
        taken = {p["path"] for p in small}

        def build(n: int, entry: dict) -> dict | None:
            if not taken <= {p["path"] for p in entry["parts"]}:
                return None  # another writer replaced them
            return {**entry, "op": "compact", "parts": [p for p in entry["parts"] if p["path"] not in taken] + made}
        return self._commit(build)

    def _clean(self) -> None:
        """Forget all but the newest commits and delete the folders that only they named."""
        numbers = self.log.numbers()
        old, kept = numbers[:-self.keep], numbers[-self.keep:]
        if not old:
            return
        named = {p["path"] for n in kept for p in self.log.entry(n)["parts"]}
        gone = {p["path"] for n in old for p in self.log.entry(n)["parts"]} - named
        for path in sorted(gone):
            delete_folder(self.spark, f"{self.root}/{path}")
        self.log.drop(kept[0])

    def vacuum(self, older_than: float = 86_400) -> list[str]:
        """Delete data folders that no commit names, left by writers lost ``older_than`` seconds ago or more."""
        fs, make = _hadoop(self.spark, self.root)
        named = {p["path"] for n in self.log.numbers() for p in self.log.entry(n)["parts"]}
        roots = {p.split("/")[0] for p in named}
        out = []
        for name in list_folder(self.spark, self.root):
            status = fs.getFileStatus(make(f"{self.root}/{name}"))
            if name.startswith("data-") and name not in roots and time.time() - status.getModificationTime() / 1000 >= older_than:
                delete_folder(self.spark, f"{self.root}/{name}")
                out.append(name)
        return out


def partition_values(path: str) -> tuple[str, ...]:
    """Partition values of a folder, as text."""
    return tuple(urllib.parse.unquote(x.split("=", 1)[1]) for x in path.split("/")[:-1])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table published at ``path``, or the plain Parquet folder there."""
    table = Table(spark, path)
    if table.exists():
        return table.read()
    if not path_exists(spark, path) or not [n for n in list_folder(spark, path) if n[:1] not in "._" and not n.startswith("data-")]:
        raise FileNotFoundError(f"{path} was never published")
    return spark.read.parquet(path)


def was_loaded(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever published at ``path`` (a load lost before its first commit was not)."""
    return Table(spark, path).exists() or path_exists(spark, path) and bool(
        [n for n in list_folder(spark, path) if n[:1] not in "._" and not n.startswith("data-")])
