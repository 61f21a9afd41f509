"""Maintained tables that feed others: changes travel over several hops within one batch.

A step is a ``foreachBatch`` function with an ``output`` log. What it emits in a
batch is a table of the steps behind it, in the same batch. So a change of a
dimension's own dimension reaches the facts through one index per edge, and
reads only what it touches on the way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starweave.sources.logs import BATCH, LogTable
from starweave.sources.streams import tagged, untag

AT = "emitted_in"
"""Column that orders the emissions of a step: the batch they come from."""


def emitted_schema(output: LogTable) -> T.StructType:
    """Row schema of a step's output as a table of later steps."""
    if AT in output.schema.names:
        raise ValueError(f"{output.path} has a column of its own called {AT}")
    return T.StructType([*output.schema.fields, T.StructField(AT, T.LongType())])


@dataclass(frozen=True)
class Step:
    handler: Callable[[DataFrame, int], None]
    output: LogTable
    takes: Sequence[str]
    """Tables of the stream, or names of earlier steps, that the handler is given."""
    name: str
    """What later steps call the output."""
    tag: bool = True
    """Whether the handler wants the tagged union; a single table is else handed over as it is."""


@dataclass(frozen=True)
class Cascade:
    """``foreachBatch`` function over a tagged union that runs its steps in order.

    Every step commits its batch on its own. A batch that stopped between two steps is replayed: the first ones
    find it committed and change nothing, the others go on.
    """

    steps: Sequence[Step]

    def __post_init__(self) -> None:
        known: set[str] = set()
        for step in self.steps:
            if step.name in known or step.name in step.takes:
                raise ValueError(f"two tables are called {step.name}")
            if not step.tag and len(step.takes) != 1:
                raise ValueError(f"{step.name}: only a single table can be handed over untagged")
            known.add(step.name)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        emitted: dict[str, DataFrame] = {}
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for step in self.steps:
                tables = {n: emitted[n] if n in emitted else untag(rows, n) for n in step.takes}
                step.handler(tagged(tables) if step.tag else next(iter(tables.values())), batch_id)
                emitted[step.name] = step.output.read_batch(batch_id).withColumnRenamed(BATCH, AT)
        finally:
            rows.unpersist()
