"""Joins and ordered scans that stay parallel when one key holds a third of the rows.

The heavy keys are found from a *hash* sample of the rows: the same rows are
drawn every time the plan runs, so both sides of a join agree and a task that is
retried on another executor agrees too. The sample only decides how work is
spread. Every row is still processed, and results never depend on it.

All side tables that are broadcast here have at most about ``parts`` rows
whatever the size of the data, because a key only counts as heavy when it holds
more than a ``1 / parts`` share.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SAMPLES_PER_SHARE = 32
"""Sampled rows that stand for one share; more gives steadier estimates."""
_SEARCH_STEPS = 18
"""Halvings of the search in a key's cut points, of which there are at most as many as sampled rows."""


@dataclass(frozen=True)
class SkewPolicy:
    parts: int = 4096
    """Heavy keys are cut to about ``total rows / parts`` rows per piece."""
    min_rows: int = 1_000_000
    """Pieces are never made smaller than this."""
    one_task_bytes: int = 64 << 20
    """Inputs below this fit in a single task, so no key in them can be too big."""

    def __post_init__(self) -> None:
        if not 1 <= self.parts * _SAMPLES_PER_SHARE < 1 << _SEARCH_STEPS:
            raise ValueError(f"parts must be between 1 and {((1 << _SEARCH_STEPS) - 1) // _SAMPLES_PER_SHARE}")


DEFAULT = SkewPolicy()

Sample = DataFrame | Callable[[], DataFrame] | None
"""A cheap table in which keys are about as frequent as in the rows at hand; a
callable is only asked for it when it is needed."""


def scan_bytes(df: DataFrame) -> int:
    """Bytes behind the leaves of a plan; huge for inputs of unknown size."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (negative: never)."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def rows_per_share(counted: Sequence[DataFrame], policy: SkewPolicy) -> Column:
    """Rows in one share of the tables together: scalar subqueries, so nothing
    runs while planning, and counting a stored table reads no columns."""
    totals = [df.agg(F.count(F.lit(1)).alias("n")).scalar() for df in counted]
    total = totals[0]
    for more in totals[1:]:
        total = total + more
    return F.greatest(F.lit(policy.min_rows), F.ceil(total / policy.parts))


def draw(rows: DataFrame, ids: Sequence[str], step: Column) -> DataFrame:
    """One row in ``step``. Filters on the ids alone, so it reaches the scan that
    holds them, below any joins."""
    return rows.where(F.pmod(F.xxhash64(*ids), step) == 0)


def heavy_keys(
    rows: DataFrame, key: str, ids: Sequence[str], policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """``(__heavy, __salts)``: each key over one share, and how many pieces it needs."""
    step = F.greatest(F.lit(1), F.floor(rows_per_share([rows], policy) / _SAMPLES_PER_SHARE))
    drawn = draw(rows.where(F.col(key).isNotNull()), [c for c in ids if c in rows.columns], step)
    return (
        drawn.groupBy(F.col(key).alias("__heavy"))
        .agg(F.ceil(F.count(F.lit(1)) / _SAMPLES_PER_SHARE).cast("int").alias("__salts"))
        .where("__salts > 1")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str,
    ids: Sequence[str],
    policy: SkewPolicy = DEFAULT,
    sample_from: Sample = None,
    pieces: int = 1,
) -> DataFrame:
    """Equi-join where heavy left keys are spread over several tasks, and every key over ``pieces`` at least.

    Every left row meets exactly one copy of each matching right row, so
    ``inner``, ``left`` and ``left_semi`` keep their meaning. Null keys cannot
    match and are spread freely.
    """
    sample = sample_from() if callable(sample_from) else sample_from
    heavy = heavy_keys(left if sample is None else sample, left_key, ids, policy)
    piece = F.when(F.col(left_key).isNull(), F.lit(policy.parts)).otherwise(
        F.greatest(F.coalesce("__salts", F.lit(1)), F.lit(pieces))
    )
    spread = (
        left.join(F.broadcast(heavy), F.col(left_key) == F.col("__heavy"), "left")
        .withColumn("__salt", F.pmod(F.xxhash64(*ids), piece).cast("int"))
        .drop("__heavy", "__salts")
    )
    copied = (
        right.join(F.broadcast(heavy), F.col(right_key) == F.col("__heavy"), "left")
        .withColumn("__copy", F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce("__salts", F.lit(1)), F.lit(pieces)) - 1)))
        .drop("__heavy", "__salts")
    )
    if pieces > 1:
        copied = copied.hint("merge")  # a broadcast would leave the left rows as they lie
    match = (F.col(left_key) == F.col(right_key)) & (F.col("__salt") == F.col("__copy"))
    return spread.join(copied, match, how).drop("__salt", "__copy")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str,
    ids: Sequence[str],
    policy: SkewPolicy | None = DEFAULT,
    sample_from: Sample = None,
) -> DataFrame:
    """Join a large left side to a lookup side, choosing by checked size.

    A right side within the session's broadcast threshold is broadcast: the left
    side is then not shuffled at all. Beyond it both sides are shuffled, with
    heavy keys salted unless the whole left side fits in one task. A stream
    cannot be sampled: pass a table of the same rows as ``sample_from``.
    """
    if scan_bytes(right) <= broadcast_limit(right):
        return left.join(F.broadcast(right), F.col(left_key) == F.col(right_key), how)
    unsampled = left.isStreaming and sample_from is None
    if policy is None or unsampled or scan_bytes(left) <= policy.one_task_bytes:
        return left.join(right, F.col(left_key) == F.col(right_key), how)
    return salted_join(left, right, left_key, right_key, how, ids, policy, sample_from)


def split_points(drawn: DataFrame, key: str, order: Column) -> DataFrame:
    """``(__heavy, __points)``: where to cut the ordered rows of each heavy key.

    ``drawn`` holds one row per share. ``__points`` is a sorted array of
    ``(at, n)``; ``n`` counts how often the position was drawn, which exceeds 1
    where many rows share one position.
    """
    return (
        drawn.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__heavy"), order.alias("at"))
        .agg(F.count(F.lit(1)).cast("int").alias("n"))
        .groupBy("__heavy")
        .agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("__points"), F.sum("n").alias("drawn"))
        .where("drawn > 1")
        .drop("drawn")
    )


def with_segments(rows: DataFrame, key: str, order: Column, points: DataFrame) -> DataFrame:
    """Add ``__seg`` (number of cut points at or before the row) and ``__salts``.

    Binary search in the key's points; rows of other keys are in segment 0.
    """
    steps = F.array(*[F.lit(1 << i) for i in range(_SEARCH_STEPS - 1, -1, -1)])

    def narrow(at: Column, step: Column) -> Column:
        reached = F.get("__points", at + step - 1)["at"] <= order
        return F.when(reached, at + step).otherwise(at)

    seg = F.when(F.col("__points").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), narrow))
    return (
        rows.join(F.broadcast(points), F.col(key) == F.col("__heavy"), "left")
        .withColumn("__seg", seg)
        .withColumn("__salts", F.coalesce(F.get("__points", F.col("__seg") - 1)["n"], F.lit(1)))
        .withColumn("__is_heavy", F.col("__heavy").isNotNull())
        .drop("__heavy", "__points")
    )
