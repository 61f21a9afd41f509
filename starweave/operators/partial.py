"""Partial documents: independent legs that each fill some fields, and the
field-by-field merge that puts them together.

A merged document is a set of last-writer-wins fields. Each field is *stamped*
with the version that wrote it, so merging is associative, commutative and
idempotent: batches may be split, reordered or replayed freely.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions.records import flatten
from starweave.operators import skew
from starweave.operators.changelog import DELETE, version_columns
from starweave.operators.enrich import lookup
from starweave.specs import Dimension, as_list

LIVE, DEAD = "__live", "__dead"


def main_leg(fact: DataFrame, key: str, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The fact's own fields, without any reference."""
    return fact.select(key, *keep, *columns)


def dimension_leg(
    fact: DataFrame,
    rows: DataFrame,
    dim: Dimension,
    key: str,
    keep: Sequence[str] = (),
    policy: skew.SkewPolicy | None = skew.DEFAULT,
    sample_from: skew.Sample = None,
) -> DataFrame:
    """One sub-document per fact row, null on a miss; only the key goes along."""
    narrow = fact.select(key, *keep, dim.fk)
    found = lookup(narrow, rows, dim, [key, *keep], "null", None, policy, sample_from)
    return found.select(key, *keep, dim.name)


def union_legs(*legs: DataFrame) -> DataFrame:
    """All legs in one output; fields a leg does not fill are null."""
    merged = legs[0]
    for leg in legs[1:]:
        merged = merged.unionByName(leg, allowMissingColumns=True)
    return merged


def wide_rows(
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    dims: Sequence[Dimension],
    key: str,
    columns: Sequence[str],
    keep: Sequence[str] = (),
    policy: skew.SkewPolicy | None = skew.DEFAULT,
    samples: Mapping[str, skew.Sample] | None = None,
) -> DataFrame:
    """All legs of a fact row side by side: one scan of the facts for all of them.

    Legs fill disjoint fields at the same version, so merging this row by field
    gives what merging the separate legs gives.
    """
    rows = fact.select(key, *keep, *columns, *dict.fromkeys(d.fk for d in dims))
    for dim in dims:
        sample = (samples or {}).get(dim.name)
        rows = lookup(rows, tables[dim.name], dim, [key, *keep], "null", None, policy, sample)
    return rows.select(key, *keep, *columns, *[d.name for d in dims])


def stacked_legs(rows: DataFrame, key: str, legs: Sequence[Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Wide rows as one row per leg, each with only its own fields set."""
    fields = [f for leg in legs for f in leg]
    kinds = {f: rows.schema[f].dataType for f in fields}

    def only(leg: Sequence[str]) -> Column:
        return F.struct(*[(F.col(f) if f in leg else F.lit(None).cast(kinds[f])).alias(f) for f in fields])

    stacked = rows.select(key, *keep, F.explode(F.array(*[only(leg) for leg in legs])).alias("__leg"))
    return stacked.select(key, *keep, "__leg.*")


def stamp(
    df: DataFrame,
    key: str,
    fields: Sequence[str],
    version: str | Sequence[str],
    op: str | None = None,
) -> DataFrame:
    """Present each field as ``(value, at)``, null where the row does not set it."""
    at = F.struct(*[c.alias(f"v{i}") for i, c in enumerate(version_columns(df, version))])
    dead = F.col(op) == DELETE if op else F.lit(False)
    return df.select(
        key,
        F.when(~dead, at).alias(LIVE),
        F.when(dead, at).alias(DEAD),
        *[
            F.when(~dead & F.col(f).isNotNull(), F.struct(F.col(f).alias("value"), at.alias("at"))).alias(f)
            for f in fields
        ],
    )


def merge_stamped(stamped: DataFrame, key: str | Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Newest stamp per field. The result is stamped again, so it can be merged on.
    Rows without a key belong to no document."""
    for name in as_list(key):
        stamped = stamped.where(F.col(name).isNotNull())
    return stamped.groupBy(*as_list(key)).agg(
        F.max(LIVE).alias(LIVE),
        F.max(DEAD).alias(DEAD),
        *[F.max_by(f, F.col(f)["at"]).alias(f) for f in fields],
    )


def unstamp(merged: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Plain documents. A delete drops every field written before it, and the
    document itself unless something was written after."""
    gone = F.col(DEAD)

    def kept(field: str) -> Column:
        stale = gone.isNotNull() & (F.col(field)["at"] <= gone)
        return F.when(~stale, F.col(field)["value"]).alias(field)

    visible = merged.where(F.col(LIVE).isNotNull() & (gone.isNull() | (F.col(LIVE) > gone)))
    return visible.select(key, *[kept(f) for f in fields])


def merge_fields(
    rows: DataFrame,
    key: str,
    version: str | Sequence[str],
    fields: Sequence[str],
    op: str | None = None,
    flat: bool = False,
) -> DataFrame:
    """Documents from partial rows: per field the last non-null value.

    A sub-document is replaced as a whole; with ``flat`` its fields are opened
    to dotted columns first and merged one by one. A field cannot be unset.
    """
    if flat:
        hold = [key, *([version] if isinstance(version, str) else version), *([op] if op else [])]
        opened = flatten(rows.select(*fields))
        names = opened.columns
        plain = [n.replace(".", "_") for n in names]
        twice = sorted({n for n in plain if plain.count(n) + hold.count(n) > 1})
        if twice:
            raise ValueError(f"nested fields clash when joined by '_': {twice}")
        rows = rows.select(*hold, *[_path(n).alias(p) for n, p in zip(names, plain, strict=True)])
        fields = plain
    if op is None:
        order = F.struct(*version_columns(rows, version))
        return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
            *[F.max_by(f, F.when(F.col(f).isNotNull(), order)).alias(f) for f in fields]
        )
    stamped = stamp(rows, key, fields, version, op)
    return unstamp(merge_stamped(stamped, key, fields), key, fields)


def _path(dotted: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in dotted.split(".")))
