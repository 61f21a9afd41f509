"""Document sinks: separate streaming queries over an output log.

A sink has its own checkpoint and its own log of documents, so computing and
sinking stop, fail and restart independently of each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators import changelog, partial, skew, upsert
from starweave.operators.sqlinsert import insert_select
from starweave.sources.logs import BATCH, LogTable
from starweave.specs import TableSpec

SOURCE = "source_batch"
"""Batch of the log the rows were read from: orders documents across batches."""


@dataclass
class ReplaceSink:
    """Whole-document replace by key; a delete row removes the document."""

    spark: SparkSession
    root: str
    key: str
    schema: T.StructType
    op: str | None = "op"
    compact_every: int = 20
    buckets: int = 16
    updates: list[UpdateMatching] = field(default_factory=list)
    """Jobs that push single fields into these documents."""
    docs: LogTable = field(init=False)

    def __post_init__(self) -> None:
        stored = T.StructType([*self.schema.fields, T.StructField(SOURCE, T.LongType())])
        self.docs = LogTable(self.spark, f"{self.root}/docs", stored, self.key, self.buckets)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        stamped = rows.withColumnRenamed(BATCH, SOURCE)
        self.docs.write(changelog.latest_by_key(stamped, self.key, SOURCE), batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def stored(self) -> DataFrame:
        """Current documents with the source batch they came from."""
        rows = upsert.replace_documents(self.docs.read(), self.key, [SOURCE, BATCH], self.op)
        rows = rows.drop(BATCH, *([self.op] if self.op else []))
        for update in self.updates:
            rows = update.applied(rows)
        return rows

    def documents(self) -> DataFrame:
        return self.stored().drop(SOURCE)

    def compact(self, batch_id: int) -> None:
        self.docs.compact(
            batch_id, lambda rows: changelog.latest_by_key(rows, self.key, [SOURCE, BATCH])
        )


@dataclass
class UpdateMatching:
    """Push dimension changes straight into stored documents; never inserts.

    The changes are kept as a table of their own, newest version per key, and meet
    the documents whose ``match`` field equals the key when these are read. So it
    does not matter which of the two jobs is ahead, and a batch of changes costs
    what it holds, not what the collection holds. Order is the version: an older
    change never replaces a newer one, nor (with ``held``) a sub-document of a
    newer version. A deleted key changes no document.
    """

    sink: ReplaceSink
    field: str
    match: str
    change_key: str
    version: Sequence[str]
    value: Column
    changes: T.StructType
    """Row schema of the followed changelog."""
    op: str | None = None
    held: Column | None = None
    """Version (a struct like ``version``) of the sub-document in a document; none: changes are newer."""
    policy: skew.SkewPolicy | None = skew.DEFAULT
    compact_every: int = 20
    log: LogTable = field(init=False)

    def __post_init__(self) -> None:
        path = f"{self.sink.root}/updates-{self.field}"
        self.log = LogTable(self.sink.spark, path, self.changes, self.change_key, self.sink.buckets)
        self.sink.updates.append(self)

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        self.log.write(changelog.latest_by_key(changes, self.change_key, self.version), batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def compact(self, batch_id: int) -> None:
        order = [*self.version, BATCH]
        self.log.compact(batch_id, lambda rows: changelog.latest_by_key(rows, self.change_key, order))

    def applied(self, docs: DataFrame) -> DataFrame:
        newest = changelog.latest_by_key(self.log.read(), self.change_key, [*self.version, BATCH], self.op)
        at = F.struct(*[c.alias(f"v{i}") for i, c in enumerate(changelog.version_columns(newest, self.version))])
        staged = newest.select(F.col(self.change_key).alias("__changed"), self.value.alias("__value"), at.alias("__at"))
        keyed = docs.withColumns({"__match": F.col(self.match), "__held": F.lit(None) if self.held is None else self.held})
        rows = skew.lookup_join(keyed, staged, "__match", "__changed", "left", [self.sink.key], self.policy)
        wins = F.col("__changed").isNotNull()
        if self.held is not None:
            names = staged.schema["__at"].dataType.names
            kept = docs.select(self.held.alias("held")).schema["held"].dataType.names
            held = F.struct(*[F.col("__held")[k].alias(n) for k, n in zip(kept, names, strict=True)])
            wins &= F.col("__held").isNull() | (F.col("__at") > held)
        new = F.when(wins, F.col("__value")).otherwise(F.col(self.field))
        return rows.withColumn(self.field, new).drop("__match", "__held", "__changed", "__value", "__at")


@dataclass
class MergeSink:
    """Partial update by key: fields present are set, others kept, documents
    inserted if absent. Stored stamped, so batches compact field by field."""

    spark: SparkSession
    root: str
    key: str
    fields: Sequence[str]
    version: Sequence[str]
    schema: T.StructType
    """Schema of the incoming rows (without ``batch_id``)."""
    op: str | None = "op"
    compact_every: int = 20
    buckets: int = 16
    settled: bool = False
    """A new base replaces what it covers at once: only where no one else reads meanwhile."""
    docs: LogTable = field(init=False)

    def __post_init__(self) -> None:
        sample = self.spark.createDataFrame(
            [], T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        )
        self.docs = LogTable(self.spark, self.root, self._stamped(sample).schema, self.key, self.buckets)

    def _stamped(self, rows: DataFrame) -> DataFrame:
        present = [f for f in self.fields if f in rows.columns]
        stamped = partial.stamp(rows, self.key, present, [*self.version, BATCH], self.op)
        return partial.merge_stamped(stamped, self.key, present)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        if not self.docs.holds(batch_id):
            merged = self._stamped(rows)
            kinds = {f.name: f.dataType for f in self.docs.schema.fields}
            absent = {n: F.lit(None).cast(k) for n, k in kinds.items() if n not in merged.columns}
            self.docs.write(merged.withColumns(absent) if absent else merged, batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def documents(self, more: DataFrame | None = None) -> DataFrame:
        """Documents as stored, with the rows of ``more`` (not stored yet) merged in."""
        fields = list(self.fields)
        rows = self.docs.read().drop(BATCH)
        if more is not None:
            rows = rows.unionByName(self._stamped(more))
        return partial.unstamp(partial.merge_stamped(rows, self.key, fields), self.key, fields)

    def compact(self, batch_id: int) -> None:
        last = F.lit(batch_id).cast("long")
        self.docs.compact_dealt(
            batch_id,
            [self.key],
            lambda rows, by: partial.merge_stamped(rows, by, list(self.fields)).withColumn(BATCH, last),
        )
        if self.settled:
            self.docs.settle_base()


@dataclass
class InsertSelect:
    """``INSERT INTO target SELECT ... FROM {rows}``, run for every batch of a document log.

    The SELECT sees the newest row of each key in the batch and fills the target's
    columns by position. A deleted key leaves the target.
    """

    spark: SparkSession
    root: str
    target: TableSpec
    select: str
    key: str
    """Column of the rows that becomes the target's key."""
    op: str = "op"
    compact_every: int = 20
    buckets: int = 16
    log: LogTable = field(init=False)

    def __post_init__(self) -> None:
        if self.target.schema is None:
            raise ValueError(f"table {self.target.name} declares no columns")
        stored = T.StructType([*self.target.schema.fields, T.StructField(self.op, T.StringType())])
        self.log = LogTable(self.spark, self.root, stored, self.target.key, self.buckets)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        newest = changelog.latest_by_key(rows, self.key, BATCH)
        live = newest.where(F.col(self.op) != changelog.DELETE)
        made = insert_select(rows.sparkSession, self.target.name, self.target, self.select, rows=live)
        key = self.target.schema[self.target.key]
        gone = newest.where(F.col(self.op) == changelog.DELETE).select(F.col(self.key).cast(key.dataType).alias(key.name))
        tagged = made.withColumn(self.op, F.lit(changelog.UPSERT))
        dead = gone.withColumn(self.op, F.lit(changelog.DELETE))
        self.log.write(tagged.unionByName(dead, allowMissingColumns=True), batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.log.compact(batch_id, lambda kept: changelog.latest_by_key(kept, self.target.key, BATCH))

    def table(self) -> DataFrame:
        return changelog.latest_by_key(self.log.read(), self.target.key, BATCH, self.op).drop(BATCH, self.op)


@dataclass
class FanOut:
    """One log, several sinks with different filters. Each sink reads the rows of the log itself, and of them the columns
    it stores: nothing is held in memory between them. Filters have
    to let deletes pass (``only_present`` with ``op``), or a sink keeps what is gone."""

    legs: Sequence[tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame, int], None]]]

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        for choose, sink in self.legs:
            sink(choose(rows), batch_id)
