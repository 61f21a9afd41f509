"""The change feed of a table that arrives as a stream: insert, update, delete with old and new values.

A version may arrive after its successors. Then its own change is new, and the
change of its successor is not what was said before: both are emitted. The newest
emission for a version counts, so the feed converges to the one that all versions
in order would have given, whatever the order of arrival. An emission with an
empty ``change`` withdraws an earlier one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators import changelog, skew
from starweave.sources.logs import BATCH, LogTable
from starweave.specs import TableSpec
from starweave.streaming.working import rows_of

_FEW = 16
"""A batch whose files are below this part of the stored versions touches few keys."""


@dataclass
class ChangeFeed:
    """``foreachBatch`` function over the rows of a versioned table.

    A batch reads the stored versions of the keys that it touches, and nothing else. Two rows with the same key
    and version are the same row: what arrives again is ignored.
    """

    spark: SparkSession
    table: TableSpec
    root: str
    schema: T.StructType
    columns: Sequence[str]
    """What ``old`` and ``new`` hold."""
    compact_every: int = 20
    buckets: int = 16
    policy: skew.SkewPolicy | None = skew.DEFAULT
    settled: bool = False
    """A new base replaces what it covers at once: only where no one else reads meanwhile."""
    versions: LogTable = field(init=False)
    output: LogTable = field(init=False)

    def __post_init__(self) -> None:
        self.versions = LogTable(self.spark, f"{self.root}/versions", self.schema, self.table.key, self.buckets)
        values = T.StructType([self.schema[c] for c in self.columns])
        fields = [f for f in self.schema.fields if f.name != self.table.op]
        emitted = [T.StructField("change", T.StringType()), T.StructField("old", values), T.StructField("new", values)]
        self.output = LogTable(self.spark, f"{self.root}/out", T.StructType([*fields, *emitted]), self.table.key, self.buckets)
        self.output.ensure()

    @property
    def _one_version(self) -> list[str]:
        return [self.table.key, *self.table.version]

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        if not self.output.holds(batch_id):
            known = rows.where(F.col(self.table.key).isNotNull())
            self.versions.write(known.dropDuplicates(self._one_version), batch_id)
            self.output.write(self._emitted(batch_id), batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def _emitted(self, batch_id: int) -> DataFrame:
        """Changes at versions of this batch and right behind them."""
        spec = self.table
        stored = self.versions.read(batch_id)
        history = self._touched(stored, batch_id)
        for name in spec.version:
            history = history.where(F.col(name).isNotNull())
        marked = history.withColumn("__fresh", F.col(BATCH) == batch_id)
        # One shuffle brings the rows of a key together: of a version that came again the first arrival counts there as well.
        pairs = changelog.paired(marked, spec.key, spec.version, self.columns, spec.op, self.policy, "__fresh", stored, BATCH)
        return pairs.where("__fresh OR coalesce(__prev_fresh, false)")

    def _touched(self, stored: DataFrame, batch_id: int) -> DataFrame:
        """The stored versions, at least those of keys that this batch touches. Other keys give nothing that is emitted, so
        they are left out only if that spares more than finding them shuffles."""
        batch = self.versions.read_batch(batch_id)
        size = skew.scan_bytes(batch)
        if size > skew.broadcast_limit(batch) and size * _FEW > skew.scan_bytes(stored):
            return stored
        return rows_of(self.versions, batch.select(self.table.key).distinct(), batch_id, self.policy)

    def changes(self) -> DataFrame:
        """The feed as it stands."""
        newest = changelog.latest_by_key(self.output.read(), self._one_version, BATCH)
        return newest.where("change <> ''").drop(BATCH)

    def compact(self, batch_id: int) -> None:
        """Versions are all kept, as they first came: any of them may still get a new neighbour."""
        aged = lambda rows, by: changelog.latest_by_key(rows.withColumn("__age", -F.col(BATCH)), by, "__age")
        self.versions.compact_dealt(batch_id, self._one_version, aged)
        if self.settled:
            self.versions.settle_base()
        newest = lambda rows, by: changelog.latest_by_key(rows, by, BATCH)
        self.output.compact_dealt(batch_id, self._one_version, newest)
        if self.settled:
            self.output.settle_base()
