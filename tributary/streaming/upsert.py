"""Newest version per key of a change log, kept up to date by small writes.

``KeyedState`` stores the newest row of each key in buckets of the key's hash.
The directory of buckets is that of extendible hashing: a bucket is named by
the leading bits of the hash, and one whose files pass twice ``bucket_bytes``
is split by the next bit.  A batch is compared with the stored rows of its keys;
only rows that change are written, as one more layer of their bucket, and the
newest layer that has a key holds its row.  Layers are merged by size tiers,
within a budget per batch, so that a batch writes in proportion to itself
however large the state is.

Every change is a commit of an ordered log (``storage.commits``).  Versions are
numbers of that log: a caller's batch numbers play no part, and a writer that
finds another's commit under its number compares its batch anew with what is
stored now.  Merging a batch twice changes nothing the second time.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tributary.operators.dedup import latest_version, top_one_per_key, version_order
from tributary.session import delete_folder, input_bytes, list_folder, scratch_path
from tributary.storage.commits import CommitConflict, CommitLog
from tributary.storage.tables import Table, Written, aligned, merge_schema

#: The size of a bucket's files; in states of less than 128 such buckets, a 128th of the state's size.
BUCKET_BYTES = 64 << 20
LEAST_BUCKET_BYTES = 1 << 20
#: A layer is merged with those after it when it is at most so many times their size.
TIER_RATIO = 4
#: Layers that are merged at least, unless their bucket is split.
TIER_LAYERS = 4
#: A bucket is split when it is so many times its size, so that both halves have about that size.
SPLIT_AT = 2
#: A batch of less than this fraction of the bytes in its buckets is few beside them.
FEW = 4
#: Rows of one key in a batch are reduced to the newest before they are dealt out if they may be more than this
#: and twice the rows of one of so many slots of the keys' hash.
OFTEN = 1000
OFTEN_SLOTS = 1 << 16
#: Merging layers may write as many bytes as the batches did and, per batch, this share of the state's.
BUDGET = 0.01
#: Merging in a small state costs little; so many bytes may be written whatever the share.
LEAST_BUDGET = 2 << 20

BUCKET, VERSION, SLOT = "__bucket", "__version", "__slot"


@dataclass
class Merged:
    """What a batch did: its version (None if nothing changed), the rows that changed, the buckets they are in."""

    version: int | None
    rows: int
    buckets: list[str]


def bucket_number(name: str) -> int:
    """A bucket's name, leading bits of the hash, as a number: rows are dealt out and sorted faster by it than by text."""
    return int("1" + name, 2)


def bucket_name(number: int) -> str:
    return format(number, "b")[1:]


def same_keys(columns: Sequence[str], prefix: str = "__r_") -> Column:
    match = F.lit(True)
    for c in columns:
        match = match & F.col(c).eqNullSafe(F.col(prefix + c))
    return match


def within(df: DataFrame, other: DataFrame, columns: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` that agree (NULL-safely) with a row of ``other`` in ``columns``, or do not (left_anti)."""
    renamed = other.select(*[F.col(c).alias(f"__r_{c}") for c in columns])
    return df.join(renamed, same_keys(columns), how)


class KeyedState:
    """The newest version of each key under ``root``.

    Keys are compared NULL-safely (rows without a key share one).  A batch may
    have columns the state lacks or the other way round; ``schema`` and the
    stored one are merged by name (``storage.tables.merge_schema``).  Files and
    change feeds that only commits before the ``keep`` newest name are deleted.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str],
                 order_by: Sequence[Column | str], tiebreak: Sequence[Column | str] | None = None,
                 bucket_bytes: int = BUCKET_BYTES, keep: int = 8):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.order_by, self.tiebreak = list(keys), order_by, tiebreak
        self.bucket_bytes, self.keep = bucket_bytes, keep
        self.log = CommitLog(spark, self.root)
        head = self.head()[1]
        self.schema = schema if head is None else merge_schema(StructType.fromJson(json.loads(head["schema"])), schema)

    # ------------------------------------------------------------------ reading

    def head(self) -> tuple[int, dict | None]:
        number = self.log.newest()
        return number, self.log.entry(number) if number >= 0 else None

    def versions(self) -> list[int]:
        """Versions that can be read, ascending."""
        return self.log.numbers()[-self.keep:]

    def _stored(self) -> StructType:
        return StructType(self.schema.fields + [StructField(VERSION, LongType())])

    def _files(self, layers: Sequence[dict]) -> DataFrame:
        """The rows of some layers, with the version that wrote each."""
        if not layers:
            return self.spark.createDataFrame([], self._stored())
        return self.spark.read.schema(self._stored()).parquet(*[f"{self.root}/{x['path']}" for x in layers])

    def read(self, version: int | None = None) -> DataFrame:
        """The state as of ``version`` (default: the newest); empty if there is none.

        Rows of the oldest layers are taken where no later layer has their
        key, if the later layers are a fraction of the state, and these are
        ranked by version; else all layers are.
        """
        number = self.log.newest() if version is None else version
        if number < 0:
            return self.spark.createDataFrame([], self.schema)
        layers = self.log.entry(number)["layers"]
        oldest, later = _split_layers(layers)
        if _bytes(later) * FEW >= _bytes(oldest):
            return self._newest(self._files(layers)).drop(VERSION)
        rows = self._files(oldest)
        if later:
            newest = self._newest(self._files(later))
            rows = within(rows, newest, self.keys, "left_anti").unionByName(newest)
        return rows.drop(VERSION)

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_version(rows, self.keys, [VERSION], [])

    def content_version(self) -> int:
        """The version that last changed rows; merging layers does not."""
        entry = self.head()[1]
        return -1 if entry is None else entry["content"]

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The stored rows of some keys (a frame that has the key columns); only their buckets are read."""
        entry = self.head()[1]
        if entry is None:
            return self.spark.createDataFrame([], self.schema)
        held = self._with_bucket(keys.select(*self.keys), entry["directory"])
        return self.rows_of(keys, entry, [bucket_name(r[0]) for r in held.select(BUCKET).distinct().collect()])

    def rows_of(self, keys: DataFrame, entry: dict, buckets: Sequence[str]) -> DataFrame:
        """The stored rows of some keys, reading the given buckets only."""
        chosen = set(buckets)
        layers = [x for x in entry["layers"] if x["bucket"] in chosen]
        found = within(self._files(layers), keys, self.keys)
        # A bucket of one layer has a key once.
        return (self._newest(found) if len(layers) > len(chosen & {x["bucket"] for x in layers}) else found).drop(VERSION)

    def changes(self, after: int) -> DataFrame | None:
        """What changed since version ``after``: key columns, ``old`` and ``new`` row (structs; old is NULL for new keys).

        One row per key that changed, however often: its row as of ``after``
        and its row now.  None if that is not known, because the state began
        later or the commits in between are not kept any more.
        """
        numbers = self.log.numbers()
        if not numbers or after + 1 < numbers[0]:
            return None
        entries = [self.log.entry(n) for n in numbers if n > after]
        if any(e.get("first") for e in entries):
            return None
        paths = [f"{self.root}/{e['feed']}" for e in entries if e.get("feed")]
        if not paths:
            return self.spark.createDataFrame([], self._feed_schema()).drop(VERSION)
        feed = self.spark.read.schema(self._feed_schema()).parquet(*paths)
        if len(paths) == 1:
            return feed.drop(VERSION)
        return feed.groupBy(*self.keys).agg(F.min_by("old", VERSION).alias("old"), F.max_by("new", VERSION).alias("new"))

    def _feed_schema(self) -> StructType:
        by_name = {f.name: f for f in self.schema.fields}
        return StructType([by_name[k] for k in self.keys] + [
            StructField("old", self.schema), StructField("new", self.schema), StructField(VERSION, LongType())])

    # ------------------------------------------------------------------ writing

    def _with_bucket(self, df: DataFrame, directory: Sequence[str]) -> DataFrame:
        """Add the number of the bucket whose name the key's hash begins with; ``directory`` is small: the names of all buckets."""
        depth = max(map(len, directory))
        if depth == 0:
            return df.withColumn(BUCKET, F.lit(bucket_number("")).cast("long"))
        slot = F.shiftrightunsigned(F.xxhash64(*self.keys), 64 - depth)
        slots = self.spark.createDataFrame(
            [(i, bucket_number(name)) for name in directory
             for i in range(int(name or "0", 2) << (depth - len(name)), (int(name or "0", 2) + 1) << (depth - len(name)))],
            StructType([StructField(SLOT, LongType()), StructField(BUCKET, LongType())]))
        return df.withColumn(SLOT, slot).join(F.broadcast(slots), SLOT).drop(SLOT)

    def _limit(self, total: int) -> int:
        return min(self.bucket_bytes, max(LEAST_BUCKET_BYTES, total // 128))

    def _first_directory(self, total: int) -> list[str]:
        depth = max(0, math.ceil(math.log2(max(1, total / self._limit(total)))))
        return [format(i, f"0{depth}b") if depth else "" for i in range(1 << depth)]

    def _write(self, rows: DataFrame, folder: str, buckets: Sequence[str], since: int) -> list[dict]:
        """One file set per bucket under ``folder``; their layers.  ``rows`` were dealt out by bucket before."""
        path = f"{self.root}/{folder}"
        rows.select(*self.schema.names, VERSION, BUCKET).write.partitionBy(BUCKET).parquet(path)
        have = {n.split("=", 1)[1] for n in list_folder(self.spark, path) if n.startswith(f"{BUCKET}=")}
        out = []
        for b in buckets:
            name = str(bucket_number(b))
            if name in have:
                where = f"{folder}/{BUCKET}={name}"
                out.append({"bucket": b, "path": where, "bytes": input_bytes(self.spark, [f"{self.root}/{where}"]), "since": since})
        return out

    def merge(self, batch: DataFrame, meta: dict | None = None, tries: int = 20,
              stored: tuple[int, int] | None = None) -> Merged:
        """Merge ``batch`` into the state; whatever else is committed meanwhile, no row is lost.

        ``meta`` is kept with the commit, for example up to where a source was read.
        A batch is read several times, so it is written down first, unless it
        is read from files that stay: then ``stored`` are their bytes and rows.
        """
        self.schema = merge_schema(self.schema, batch.schema)
        work = scratch_path(self.spark, "upsert")
        if stored is None:
            given = Observation()
            aligned(batch, self.schema).observe(given, F.count(F.lit(1)).alias("rows")).write.parquet(f"{work}/candidates")
            size, n_rows = input_bytes(self.spark, [f"{work}/candidates"]), int(given.get["rows"])
            candidates = self.spark.read.schema(self.schema).parquet(f"{work}/candidates")
        else:
            (size, n_rows), candidates = stored, aligned(batch, self.schema)
        for _ in range(tries):
            number, entry = self.head()
            feed, changed = None, n_rows
            if entry is None:
                directory = self._first_directory(size)
                seen = Observation()
                rows = self._latest(self._with_bucket(self._few_a_key(candidates, n_rows), directory).repartition(BUCKET), BUCKET
                                    ).observe(seen, F.count(F.lit(1)).alias("rows"))
            else:
                self.schema = merge_schema(StructType.fromJson(json.loads(entry["schema"])), self.schema)
                directory = entry["directory"]
                feed, seen = f"feed/{uuid.uuid4().hex}", Observation()
                (self._changed(aligned(candidates, self.schema), size, n_rows, entry).withColumn(VERSION, F.lit(number + 1).cast("long"))
                 .observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/{feed}"))
                changed = int(seen.get["rows"])
                rows = self.spark.read.schema(StructType([*self._feed_schema().fields, StructField(BUCKET, LongType())])
                                              ).parquet(f"{self.root}/{feed}").select("new.*", BUCKET)
            if not changed:
                if feed:
                    delete_folder(self.spark, f"{self.root}/{feed}")
                if entry is not None and (not meta or meta == entry["meta"]):
                    delete_folder(self.spark, work)
                    return Merged(None, 0, [])
            layers = self._write(rows.withColumn(VERSION, F.lit(number + 1).cast("long")), f"data/{uuid.uuid4().hex}",
                                 directory, number + 1) if changed else []
            if entry is None and changed:
                changed = int(seen.get["rows"])
            # Upkeep may write as much as the batches did, and a share of the state's bytes for each of them.
            total = sum(x["bytes"] for x in [*(entry["layers"] if entry else []), *layers])
            written = sum(x["bytes"] for x in layers)
            credit = 0 if entry is None else entry["credit"] + written + max(LEAST_BUDGET, int(BUDGET * total))
            made = {"op": "merge", "first": entry is None, "schema": self.schema.json(), "directory": directory,
                    "feed": feed if changed else None, "credit": credit,
                    "content": number + 1 if changed or entry is None else entry["content"], "layers": (entry["layers"] if entry else []) + layers,
                    "meta": meta or (entry or {}).get("meta", {})}
            try:
                self.log.put(number + 1, made)
            except CommitConflict:
                # The state is another one now: what this attempt wrote is not named by any commit.
                for path in {feed, *(x["path"].rsplit("/", 1)[0] for x in layers)} - {None}:
                    delete_folder(self.spark, f"{self.root}/{path}")
                continue
            delete_folder(self.spark, work)
            self._upkeep(written)
            return Merged(number + 1, changed, sorted(x["bucket"] for x in layers))
        raise CommitConflict(f"{self.root}: other writers kept committing")

    def _latest(self, rows: DataFrame, *dealt_by: str) -> DataFrame:
        order = version_order(rows.drop(*dealt_by), self.keys, self.order_by, self.tiebreak)
        return top_one_per_key(rows, [*self.keys, *dealt_by], order)

    def _few_a_key(self, candidates: DataFrame, n_rows: int) -> DataFrame:
        """The candidates, reduced to the newest of each key if any has so many that they should not meet in one task.

        Counted are slots of the keys' hash: each task holds and sends these
        counts only.  A key has no more rows than its slot, and a slot without
        such a key has about as many as the others.
        """
        slot = F.pmod(F.xxhash64(*self.keys), F.lit(OFTEN_SLOTS))
        most = candidates.groupBy(slot.alias(SLOT)).count().agg(F.max("count")).first()[0] or 0
        return self._latest(candidates) if most > max(OFTEN, 2 * n_rows // OFTEN_SLOTS) else candidates

    def _changed(self, candidates: DataFrame, size: int, n_rows: int, entry: dict) -> DataFrame:
        """The newest candidates that are newer than the stored rows of their keys: (keys, old, new, bucket).

        ``size`` are the candidates' bytes.  If they are few beside what their
        buckets hold, the stored rows of their keys are picked out first; else
        that would cost more than it saves, and all rows of these buckets are
        dealt out by bucket, once, with the candidates.
        """
        held = self._with_bucket(candidates.select(*self.keys), entry["directory"])
        touched = [bucket_name(r[0]) for r in held.select(BUCKET).distinct().collect()]  # one per bucket
        layers = [x for x in entry["layers"] if x["bucket"] in set(touched)]
        if size * FEW < _bytes(layers):
            candidates = self._latest(candidates)
            stored = self.rows_of(candidates, entry, touched).withColumn(VERSION, F.lit(0).cast("long"))
        else:
            candidates, stored = self._few_a_key(candidates, n_rows), self._files(layers)
        row = F.struct(*[F.col(f"`{n}`") for n in self.schema.names])
        union = stored.withColumn("__given", F.lit(0)).unionByName(
            candidates.withColumn(VERSION, F.lit(None).cast("long")).withColumn("__given", F.lit(1)))
        order = version_order(union.drop("__given", VERSION), self.keys, self.order_by, self.tiebreak)
        # Of equal rows the stored one is first, so a repeated batch changes nothing; only stored rows have a version.
        w = Window.partitionBy(*self.keys, BUCKET).orderBy(*order, "__given")
        group = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # in the same order: one sort
        newer = (self._with_bucket(union, entry["directory"]).repartition(BUCKET)
                 .withColumn("old", F.max_by(F.when(F.col("__given") == 0, row), VERSION).over(group))
                 .withColumn("__rn", F.row_number().over(w))
                 .where((F.col("__rn") == 1) & (F.col("__given") == 1)))
        return newer.select(*self.keys, "old", row.alias("new"), BUCKET)

    # ------------------------------------------------------------------ upkeep

    def _upkeep(self, written: int) -> None:
        """Merge layers and split buckets within the budget of a batch, then forget old commits."""
        number, entry = self.head()
        total = sum(x["bytes"] for x in entry["layers"])
        budget = min(entry["credit"], max(LEAST_BUDGET, int(BUDGET * total), 2 * written))
        runs: dict[str, list[dict]] = {}
        cost = 0
        for bucket, run in sorted(_tiers(entry["layers"], self._limit(total)).items(), key=lambda kv: (-len(kv[1]), kv[0])):
            size = sum(x["bytes"] for x in run)
            if cost + size <= budget:
                runs[bucket], cost = run, cost + size
        if runs:
            self._rewrite(entry, runs, self._limit(total))
        self._clean()

    def _rewrite(self, entry: dict, runs: dict[str, list[dict]], limit: int) -> None:
        """Replace the layers of each run by one; a bucket that is too large by those of its two halves."""
        by_bucket = _by_bucket(entry["layers"])
        names = list(entry["directory"])
        split = {b for b, run in runs.items() if len(run) == len(by_bucket[b]) and sum(x["bytes"] for x in run) > SPLIT_AT * limit}
        for b in split:
            names.remove(b)
            names += [b + "0", b + "1"]
        rows = self._with_bucket(self._files([x for run in runs.values() for x in run]), names).repartition(BUCKET)
        made = self._write(latest_version(rows, [*self.keys, BUCKET], [VERSION], []), f"data/{uuid.uuid4().hex}", sorted(names),
                           max(x["since"] for run in runs.values() for x in run))
        taken = {x["path"] for run in runs.values() for x in run}
        for _ in range(20):
            number, now = self.head()
            same = {x["path"] for x in now["layers"]}
            later = {x["bucket"] for x in now["layers"]} - {x["bucket"] for x in entry["layers"]}
            fresh = [x for x in now["layers"] if x["bucket"] in split and x["path"] not in taken]
            if not taken <= same or now["directory"] != entry["directory"] or fresh or later:
                return  # another writer has changed these buckets; their layers are merged another time
            # A merged layer stands where its run stood: before layers that came later.
            kept = [x for x in now["layers"] if x["path"] not in taken]
            try:
                self.log.put(number + 1, {**now, "op": "compact", "feed": None, "directory": names, "layers": made + kept,
                                          "credit": now["credit"] - sum(x["bytes"] for run in runs.values() for x in run)})
                return
            except CommitConflict:
                continue

    def _clean(self) -> None:
        numbers = self.log.numbers()
        old, kept = numbers[:-self.keep], numbers[-self.keep:]
        if not old:
            return

        def named(ns: Sequence[int]) -> set[str]:
            return {p for n in ns for e in [self.log.entry(n)] for p in [*(x["path"] for x in e["layers"]), e.get("feed")] if p}
        for path in sorted(named(old) - named(kept)):
            delete_folder(self.spark, f"{self.root}/{path}")
        self.log.drop(kept[0])


def _bytes(layers: Sequence[dict]) -> int:
    return sum(x["bytes"] for x in layers)


def _by_bucket(layers: Sequence[dict]) -> dict[str, list[dict]]:
    """Layers per bucket, oldest first."""
    out: dict[str, list[dict]] = {}
    for x in sorted(layers, key=lambda x: x["since"]):
        out.setdefault(x["bucket"], []).append(x)
    return out


def _split_layers(layers: Sequence[dict]) -> tuple[list[dict], list[dict]]:
    """(the oldest layer of every bucket, all others)."""
    grouped = _by_bucket(layers).values()
    return [g[0] for g in grouped], [x for g in grouped for x in g[1:]]


def _tiers(layers: Sequence[dict], bucket_bytes: int) -> dict[str, list[dict]]:
    """Per bucket the newest layers that are worth merging: none is much larger than those after it together."""
    out = {}
    for bucket, group in _by_bucket(layers).items():
        run, size = [], 0
        for x in reversed(group):
            if run and x["bytes"] > TIER_RATIO * size:
                break
            run.append(x)
            size += x["bytes"]
        whole = len(run) == len(group)
        if len(run) >= TIER_LAYERS or whole and size > SPLIT_AT * bucket_bytes:
            out[bucket] = run
    return out


def incremental_upsert(batches: Sequence[DataFrame], root: str, keys: Sequence[str],
                       order_by: Sequence[Column | str],
                       tiebreak: Sequence[Column | str] | None = None, **options) -> DataFrame:
    """Apply ``batches`` one after another to the state at ``root``; return the stored state."""
    if not batches:
        raise ValueError("no batches")
    state = KeyedState(batches[0].sparkSession, root, batches[0].schema, keys, order_by, tiebreak, **options)
    for batch in batches:
        state.merge(batch)
    return state.read()


def stream_latest(spark: SparkSession, bronze_dir: str, schema, state_root: str,
                  checkpoint: str, keys: Sequence[str], order_by: Sequence[Column | str],
                  tiebreak: Sequence[Column | str] | None = None,
                  max_files_per_trigger: int | None = None
                  ) -> tuple[StreamingQuery, list[int], DataFrame]:
    """Run one ``availableNow`` pass over the new files in ``bronze_dir``.

    Returns the finished query, the batch ids it merged (none without new
    files) and the current state.  Restarting with the same ``checkpoint``
    resumes after the last committed batch.
    """
    state = KeyedState(spark, state_root, schema, keys, order_by, tiebreak)
    merged: list[int] = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        # The stream's batch number names no version: after a lost checkpoint it begins at 0 again.
        state.merge(batch, {"batch": batch_id, "checkpoint": checkpoint})
        merged.append(batch_id)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (reader.parquet(bronze_dir).writeStream.foreachBatch(merge)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query, merged, state.read()


@dataclass
class Refreshed:
    """A refreshed fact: the stored rows, and the changed keys' rows before and after (stored)."""

    rows: DataFrame
    old: DataFrame
    new: DataFrame
    written: Written


def refresh_partitions(rebuild: Callable[[DataFrame], DataFrame], path: str, changed: DataFrame,
                       key: str = "venda_id", had: DataFrame | None = None, meta: dict | None = None) -> Refreshed:
    """Bring the fact published at ``path`` (``storage.tables``) up to date for the keys in ``changed``.

    ``rebuild(keys)`` returns the fact rows of these keys as they are now; it
    restricts its inputs to the keys before ranking them.  Touched are the
    partitions that a changed key has in the stored fact and those it has now;
    they are rewritten from the stored rows of other keys and the rebuilt rows,
    partitions that end empty are left out, all others keep their files.
    ``had`` may name the partitions in which stored rows of the keys lie, so
    that no others are searched.  The list of touched partitions (bounded by
    the number of partitions) is the only thing that reaches the driver.
    """
    spark = changed.sparkSession
    table = Table(spark, path)
    base, entry = table.head()
    if entry is None:
        raise FileNotFoundError(f"{path} was never published")
    by, schema = entry["partition_by"], table.schema(base)
    scratch = scratch_path(spark, "refresh")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    def values(df: DataFrame) -> set[tuple]:
        return {tuple(r) for r in df.select(*by).distinct().collect()}

    keys = kept(changed.select(key).dropDuplicates(), "keys")
    new = kept(rebuild(keys).select(*schema.names), "new")
    searched = entry["parts"] if had is None else table.partitions_of(sorted(values(had), key=str), base)
    old = kept(within(table.read(base, searched), keys, [key]), "old")
    touched = sorted(values(old) | values(new), key=str)
    if not touched:
        return Refreshed(table.read(base), old, new, Written(base, 0))
    others = within(table.read(base, table.partitions_of(touched, base)), keys, [key], "left_anti")
    rows = others.unionByName(new).hint("rebalance", *by)
    written = table.replace_partitions(rows, touched, base, meta)
    return Refreshed(table.read(written.number), old, new, written)
