"""Quality checks that follow changes instead of reading whole tables again.

``UniqueCheck`` keeps the number of rows per key in a ``KeyedState``; a batch
looks up the counts of its own keys only.  ``OrphanCheck`` looks in both
directions: changed children are looked up among the parents, and parents that
arrive or go are matched with the children that name them.  Both keep the
violations themselves as a published table; the result equals the full check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tributary.operators.checks import orphan_rows, unique_violations
from tributary.storage.tables import Table
from tributary.streaming.upsert import KeyedState, within

SEQ = "__seq"


class UniqueCheck:
    """Keys that occur more than once, with their row count, of a table that rows are added to and taken from."""

    def __init__(self, spark: SparkSession, root: str, counts_root: str, keys: Sequence[str]):
        self.spark, self.found, self.counts_root, self.keys = spark, Table(spark, root), counts_root, list(keys)

    def _counts(self, rows: DataFrame) -> KeyedState:
        by_name = {f.name: f for f in rows.schema.fields}
        schema = StructType([by_name[k] for k in self.keys] + [StructField("n_rows", LongType()), StructField(SEQ, LongType())])
        return KeyedState(self.spark, self.counts_root, schema, self.keys, [SEQ], [])

    def rebuild(self, rows: DataFrame, meta: dict) -> DataFrame:
        """Count all rows anew."""
        counts = self._counts(rows)
        seq = (counts.head()[1] or {"meta": {}})["meta"].get("seq", -1) + 1
        now = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_rows"))
        gone = within(counts.read().where("n_rows > 0"), now, self.keys, "left_anti").select(
            *self.keys, F.lit(0).cast("long").alias("n_rows"))
        counts.merge(now.unionByName(gone).withColumn(SEQ, F.lit(seq).cast("long")), {"seq": seq, "made_from": meta})
        self.found.replace(unique_violations(rows, self.keys), meta=meta)
        return self.found.read()

    def apply(self, gone: DataFrame, came: DataFrame, meta: dict) -> DataFrame:
        """Rows ``gone`` were taken from the table and rows ``came`` added; ``meta`` says what the table is now made from.

        A change that the counts have already (a run that was lost before the
        violations were published) is not counted twice.
        """
        counts = self._counts(came)
        entry = counts.head()[1]
        delta = (came.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("d"))
                 .unionByName(gone.groupBy(*self.keys).agg((-F.count(F.lit(1))).alias("d")))
                 .groupBy(*self.keys).agg(F.sum("d").alias("d")))
        if entry["meta"].get("made_from") != meta:
            seq = entry["meta"]["seq"] + 1
            held = counts.lookup(delta).select(*[F.col(k).alias(f"__r_{k}") for k in self.keys], "n_rows")
            same = F.lit(True)
            for k in self.keys:
                same = same & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
            now = delta.join(held, same, "left").select(
                *self.keys, (F.coalesce("n_rows", F.lit(0)) + F.col("d")).cast("long").alias("n_rows"),
                F.lit(seq).cast("long").alias(SEQ))
            counts.merge(now, {"seq": seq, "made_from": meta})
        now = counts.lookup(delta).where("n_rows > 1").select(*self.keys, "n_rows")
        self.found.replace(within(self.found.read(), delta, self.keys, "left_anti").unionByName(now), meta=meta)
        return self.found.read()


class OrphanCheck:
    """Rows of a child table whose ``fk`` names no parent (a NULL names none and is no orphan)."""

    def __init__(self, spark: SparkSession, root: str, child_key: str, fk: str):
        self.found, self.child_key, self.fk = Table(spark, root), child_key, fk

    def rebuild(self, children: DataFrame, parents: DataFrame, meta: dict) -> DataFrame:
        self.found.replace(orphan_rows(children, parents, self.fk), meta=meta)
        return self.found.read()

    def apply(self, changed: DataFrame, came: DataFrame, parents_of: Callable[[DataFrame], DataFrame],
              arrived: DataFrame, meta: dict, left: DataFrame | None = None,
              children_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Follow a change; applying it twice gives the same.

        ``changed``: keys of the children that changed or went; ``came``: their
        rows now; ``parents_of(keys)``: which of some keys (column ``fk``) have
        a parent; ``arrived``: keys of parents that are new; ``left``: keys of
        parents that went, with ``children_of(keys)`` the children that name them.
        """
        asked = came.where(F.col(self.fk).isNotNull())
        if left is not None:
            asked = asked.unionByName(within(children_of(left), changed, [self.child_key], "left_anti"))
        orphans = within(asked, parents_of(asked.select(self.fk).distinct()), [self.fk], "left_anti")
        kept = within(self.found.read(), changed, [self.child_key], "left_anti")
        if left is not None:
            kept = within(kept, orphans, [self.child_key], "left_anti")
        kept = within(kept, arrived, [self.fk], "left_anti")
        self.found.replace(kept.unionByName(orphans, allowMissingColumns=True), meta=meta)
        return self.found.read()
