"""Exact running sums over a global order, without one task for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.llm.tables import free_name
from starweave.session import stage


def running(
    df: DataFrame, value: Column, order: Sequence[Column], group: Sequence[Column] = (), upto: str = "upto", nth: str = "nth"
) -> DataFrame:
    """``df`` with the sum of ``value`` up to and with each row, and its position from 1, in each group.

    Rows are range-partitioned by group and order, so a hot group is cut into many ranges. Each range sums
    its own rows; the totals (one row per range, and per group that begins in it) are prefix-summed and added
    back. Nulls come first. Ties follow the order of the input files. A null value counts as 0. The result
    is a table in the shared folder. ``upto`` and ``nth`` must not be columns of ``df``.
    """
    row, part = free_name(df, "row_id", "range_id")
    groups = free_name(df, *(f"group_{i}" for i in range(len(group))))
    keys = free_name(df, *(f"order_{i}" for i in range(len(order))))
    numbered = df.select(
        "*",
        F.coalesce(value.cast("long"), F.lit(0)).alias(upto),
        *(c.alias(k) for c, k in zip(group, groups, strict=True)),
        *(c.alias(k) for c, k in zip(order, keys, strict=True)),
        F.monotonically_increasing_id().alias(row),
    )
    in_group = [*(F.col(k).asc_nulls_first() for k in keys), F.col(row)]
    ranged = numbered.repartitionByRange(*(F.col(g).asc_nulls_first() for g in groups), *in_group)
    in_range = Window.partitionBy(part, *groups).orderBy(*in_group)
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = stage(
        ranged.withColumn(part, F.spark_partition_id())
        .withColumns({upto: F.sum(upto).over(so_far), nth: F.row_number().over(in_range).cast("long")})
        .drop(*keys, row),
        "running",
    )
    sum_before, rows_before = free_name(local, "sum_before", "rows_before")
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        local.groupBy(part, *groups)
        .agg(F.max(upto).alias(upto), F.max(nth).alias(nth))
        .select(
            part,
            *groups,
            F.coalesce(F.sum(upto).over(earlier), F.lit(0)).alias(sum_before),
            F.coalesce(F.sum(nth).over(earlier), F.lit(0)).alias(rows_before),
        )
    )
    match = local[part] == totals[part]
    for g in groups:
        match &= local[g].eqNullSafe(totals[g])
    return local.join(totals if groups else F.broadcast(totals), match).select(
        *(local[c] for c in df.columns),
        (local[upto] + totals[sum_before]).alias(upto),
        (local[nth] + totals[rows_before]).alias(nth),
    )
