"""Contiguous shards of nearly equal bytes, by global prefix sums.

Rows are range-partitioned in the wanted order; each partition sums its own
sizes; the partition totals (one row per partition) are prefix-summed and added
back. The middle of a row's byte range decides its shard, so a shard differs
from its target by less than one row at either end. No task sees more than one
range of rows, and only per-partition and per-shard totals are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.prefix import running
from starweave.llm.tables import free_name


def shard_by_bytes(df: DataFrame, size: Column, order: Sequence[Column], shards: int) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    * ``size``: bytes of a row. Null or negative counts as 0; if all are 0, everything is in shard 0.
    * ``order``: shards are contiguous in this order, nulls first. Equal rows, and other ties, follow
      the order of the input files, so a key that holds a third of all rows is still split.
    * A row larger than a whole target makes a shard larger, and may leave the next ones empty.
    * An empty table gives an empty result. Input columns ``shard`` and ``slot`` are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    df = df.drop("shard", "slot")
    bytes_, upto, nth, total, place, first = free_name(df, "row_bytes", "upto", "nth", "total", "place", "first_row")
    sized = df.withColumn(bytes_, F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)))
    summed = running(sized, F.col(bytes_), order, upto=upto, nth=nth)
    whole = summed.agg(F.greatest(F.max(upto), F.lit(1)).alias(total))  # one row
    placed = summed.join(F.broadcast(whole)).withColumn(
        place,
        F.least(
            F.expr(
                f"int(cast(2 * `{upto}` - `{bytes_}` as decimal(20,0)) * cast({shards} as decimal(10,0))"
                f" div cast(2 * `{total}` as decimal(20,0)))"
            ),
            F.lit(shards - 1),
        ),
    )
    starts = placed.groupBy(place).agg(F.min(nth).alias(first))  # one row per shard
    return placed.join(F.broadcast(starts), place).select(
        *df.columns, F.col(place).alias("shard"), (F.col(nth) - F.col(first)).alias("slot")
    )
