"""Keyed changelogs: latest value per key, tombstones, change streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from starweave.operators import skew
from starweave.specs import TableSpec, as_list

DELETE = "delete"
UPSERT = "upsert"


def version_columns(df: DataFrame, version: str | Sequence[str]) -> list[Column]:
    """Version columns with structs opened, so sorts compare plain values."""
    columns = []
    for name in as_list(version):
        kind = df.schema[name].dataType if name in df.columns else None
        if isinstance(kind, T.StructType):
            columns += [F.col(f"{name}.{f}") for f in kind.names]
        else:
            columns.append(F.col(name))
    return columns


def latest_by_key(
    df: DataFrame,
    key: str | Sequence[str],
    version: str | Sequence[str],
    op: str | None = None,
) -> DataFrame:
    """Newest row per key; with ``op``, keys whose newest row is a delete vanish.

    The rank filter lets Spark keep one row per key in each map task before the
    shuffle, so a hot key costs one row per task. Deletes must take part in the
    ranking: removing them first would bring back the value they deleted. Rows
    without a key belong to no table.
    """
    for name in as_list(key):
        df = df.where(F.col(name).isNotNull())
    newest_first = [c.desc() for c in version_columns(df, version)]
    ranked = Window.partitionBy(*as_list(key)).orderBy(*newest_first)
    latest = df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")
    return latest.where(F.col(op) != DELETE) if op else latest


def table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The current contents of a changelog table."""
    return latest_by_key(df, spec.key, spec.version, spec.op)


def latest_per_group(
    rows: DataFrame, group: str, order: Sequence[str]
) -> DataFrame:
    """Most recent row per foreign key, over *current* rows.

    Grouping current rows means a row that moved to another group is not left
    behind in the old one.
    """
    return latest_by_key(rows, group, order)


def with_previous(
    df: DataFrame,
    key: str,
    version: str | Sequence[str],
    columns: Sequence[str],
    policy: skew.SkewPolicy | None = skew.DEFAULT,
    sample_from: DataFrame | None = None,
    first_by: str | None = None,
) -> DataFrame:
    """Add struct ``prev``: the given columns of the key's preceding version.

    Rows without a key belong to no table and are left out. One task handles one
    key, unless the key is heavy: then its version range is
    cut into segments, and the first row of each takes ``prev`` from the last
    row of the nearest non-empty segment before it. ``sample_from`` is a stored table with
    the key and version of about these rows, in which heavy keys are looked for. With ``first_by``, of rows with
    one key and version only the one with the lowest value counts; that takes no shuffle of its own.
    """
    df = df.where(F.col(key).isNotNull())
    order = version_columns(df, version)
    payload = F.struct(*columns)
    if policy is None or skew.scan_bytes(df) <= policy.one_task_bytes:
        by_key = Window.partitionBy(key).orderBy(*order)
        if first_by is not None:
            df = _first_of_each(df, [key], order, first_by)
        return df.withColumn("prev", F.lag(payload).over(by_key))

    position = F.struct(*[c.alias(f"v{i}") for i, c in enumerate(order)])
    located = df.withColumn("__pos", position)
    known = df if sample_from is None else sample_from
    drawn = skew.draw(known.withColumn("__pos", position), [key, "__pos"], skew.rows_per_share([known], policy))
    points = skew.split_points(drawn, key, F.col("__pos"))
    rows = skew.with_segments(located, key, F.col("__pos"), points)
    heavy = rows.where("__is_heavy")
    if first_by is not None:
        rows, heavy = (_first_of_each(df, [key, "__seg"], order, first_by) for df in (rows, heavy))
    ends = (
        heavy.groupBy(F.col(key).alias("__ckey"), F.col("__seg").alias("__cseg"))
        .agg(F.max_by(payload, "__pos").alias("__end"))
    )
    across = Window.partitionBy("__ckey").orderBy("__cseg")
    carried = ends.select("__ckey", "__cseg", F.lag("__end").over(across).alias("__carry"))
    within = Window.partitionBy(key, "__seg").orderBy(*version_columns(df, version))
    return (
        rows.withColumn("prev", F.lag(payload).over(within))
        .join(
            F.broadcast(carried),
            (F.col(key) == F.col("__ckey")) & (F.col("__seg") == F.col("__cseg")),
            "left",
        )
        .withColumn("prev", F.coalesce("prev", "__carry"))
        .drop("__pos", "__seg", "__salts", "__is_heavy", "__ckey", "__cseg", "__carry")
    )


def _first_of_each(rows: DataFrame, by: Sequence[str], version: Sequence[Column], first_by: str) -> DataFrame:
    """One row per version, found where the rows lie once they are partitioned ``by``, which holds a version together."""
    ranked = Window.partitionBy(*by, *version).orderBy(first_by)
    dealt = rows.repartition(*[F.col(c) for c in by])
    return dealt.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def paired(
    df: DataFrame,
    key: str,
    version: str | Sequence[str],
    columns: Sequence[str],
    op: str | None = None,
    policy: skew.SkewPolicy | None = skew.DEFAULT,
    carry: str | None = None,
    sample_from: DataFrame | None = None,
    first_by: str | None = None,
) -> DataFrame:
    """Every version with its ``change`` (insert / update / delete, empty: none) and structs ``old`` and ``new``.

    ``carry`` names a column that the preceding version lends as ``__prev_<name>`` (underscores stripped); ``first_by``:
    see ``with_previous``.
    """
    dead = F.col(op) == DELETE if op else F.lit(False)
    marked = df.withColumn("__dead", dead)
    lent = [*columns, "__dead", *([carry] if carry else [])]
    rows = with_previous(marked, key, version, lent, policy, sample_from, first_by)
    had = F.col("prev").isNotNull() & ~F.col("prev.__dead")
    old = F.when(had, F.struct(*[F.col(f"prev.{c}").alias(c) for c in columns]))
    new = F.when(~F.col("__dead"), F.struct(*columns))
    change = (
        F.when(~F.col("__dead") & ~had, "insert")
        .when(~F.col("__dead") & had, "update")
        .when(F.col("__dead") & had, DELETE)
    )
    made = {"change": F.coalesce(change, F.lit("")), "old": old, "new": new}
    if carry:
        made[f"__prev_{carry.strip('_')}"] = F.col(f"prev.{carry}")
    return rows.withColumns(made).drop("prev", "__dead")


def to_changelog(
    df: DataFrame,
    key: str,
    version: str | Sequence[str],
    columns: Sequence[str],
    op: str | None = None,
    policy: skew.SkewPolicy | None = skew.DEFAULT,
) -> DataFrame:
    """Turn a versioned table into its change stream.

    Adds ``change`` (insert / update / delete) and structs ``old`` and ``new``.
    Deleting an absent key is no change and yields no row.
    """
    return paired(df, key, version, columns, op, policy).where("change <> ''")


def key_switches(
    df: DataFrame,
    key: str,
    fk: str,
    version: str | Sequence[str],
    policy: skew.SkewPolicy | None = skew.DEFAULT,
) -> DataFrame:
    """Every point where a row starts to reference another key: ``(key, old, new)``."""
    rows = with_previous(df, key, version, [fk], policy)
    return rows.where(
        F.col("prev").isNotNull() & ~F.col(f"prev.{fk}").eqNullSafe(F.col(fk))
    ).select(key, F.col(f"prev.{fk}").alias("old"), F.col(fk).alias("new"))
