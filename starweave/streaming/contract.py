"""A contract that the rows of a stream have to keep.

Every batch is judged in one pass: what keeps the contract goes on, what breaks it goes to a log of rejected
rows with the names of what it breaks. A batch with too large a share of those stops the stream
before anything of it is passed on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators import changelog
from starweave.sources.logs import BATCH, LogTable
from starweave.streaming.working import forget, settle

BROKEN = "broken"
"""Column of the rejected rows: names of the rules that the row breaks, in the order of the rules."""


class ContractBroken(Exception):
    """A batch in which more rows break the contract than it allows."""


@dataclass
class Contract:
    """``foreachBatch`` function over rows with a key; both its logs can be followed.

    A row keeps the contract if all of ``required`` (dotted paths reach into structs) are there and all ``rules`` are
    true; a rule that is null is broken. Rows whose ``op`` says delete carry no fields and are accepted.
    """

    spark: SparkSession
    root: str
    key: str
    schema: T.StructType
    required: Sequence[str] = ()
    rules: Mapping[str, Column] = field(default_factory=dict)
    op: str | None = None
    most: float = 1.0
    """Largest share of a batch's rows that may be rejected."""
    version: Sequence[str] = ()
    """What orders the rows of a key, before the batch that they came in."""
    compact_every: int = 20
    buckets: int = 16
    accepted: LogTable = field(init=False)
    rejected: LogTable = field(init=False)

    def __post_init__(self) -> None:
        if not 0 <= self.most <= 1:
            raise ValueError("most is a share between 0 and 1")
        if BROKEN in self.schema.names:
            raise ValueError(f"the rows have a column of their own called {BROKEN}")
        self.accepted = LogTable(self.spark, f"{self.root}/accepted", self.schema, self.key, self.buckets)
        judged = T.StructType([*self.schema.fields, T.StructField(BROKEN, T.ArrayType(T.StringType()))])
        self.rejected = LogTable(self.spark, f"{self.root}/rejected", judged, self.key, self.buckets)
        self.accepted.ensure()
        self.rejected.ensure()

    def judged(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the names of what each of them breaks."""
        conditions = {name: F.col(name).isNotNull() for name in self.required} | dict(self.rules)
        broken = F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items()))
        names = F.array_compact(broken) if conditions else F.array().cast("array<string>")
        if self.op is not None:
            names = F.when(F.col(self.op) == changelog.DELETE, F.array().cast("array<string>")).otherwise(names)
        return rows.select(*self.schema.names, names.alias(BROKEN))

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        if not self.accepted.committed(batch_id):
            bad = F.size(BROKEN) > 0
            if not self.rejected.committed(batch_id):
                seen = Observation()
                watched = self.judged(rows).observe(
                    seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("bad")
                )
                # Counted while it is written: one pass over the batch.
                judged = settle(self.rejected, "judged", watched, batch_id, again=True)
                count = seen.get
                if count["bad"] > self.most * count["rows"]:
                    raise ContractBroken(f"batch {batch_id}: {count['bad']} of {count['rows']} rows break the contract")
                self.rejected.write(judged.where(bad), batch_id)
            judged = settle(self.rejected, "judged", self.judged(rows), batch_id)
            self.accepted.write(judged.where(~bad), batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def current(self) -> DataFrame:
        """The newest row of each key that is not deleted, and what it breaks (empty: accepted)."""
        kept = self.accepted.read().withColumn(BROKEN, F.array().cast("array<string>"))
        both = kept.unionByName(self.rejected.read())
        return changelog.latest_by_key(both, self.key, [*self.version, BATCH], self.op).drop(BATCH)

    def compact(self, batch_id: int) -> None:
        order = [*self.version, BATCH]
        for log in (self.accepted, self.rejected):
            log.compact(batch_id, lambda rows: changelog.latest_by_key(rows, self.key, order))
        forget(self.rejected, ("judged",), batch_id - 1)
