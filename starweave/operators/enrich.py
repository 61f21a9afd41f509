"""Foreign-key lookups from a fact table into its dimensions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.functions.records import blank, record
from starweave.operators import skew
from starweave.operators.changelog import latest_per_group
from starweave.specs import Dimension, OnMiss, StarSpec

Joiner = Callable[[Column, Column], Column]
"""(matched record or null, foreign key) -> the sub-document, as expressions."""


def _as_lookup(rows: DataFrame, dim: Dimension) -> DataFrame:
    """``(__key, <name>)`` with only the columns that go in the sub-document."""
    renames = {dim.table.key: dim.rename_key} if dim.rename_key else {}
    return rows.select(
        F.col(dim.table.key).alias("__key"), record(rows.schema, dim.columns, renames).alias(dim.name)
    )


def lookup(
    fact: DataFrame,
    rows: DataFrame,
    dim: Dimension,
    ids: Sequence[str],
    on_miss: OnMiss | None = None,
    joiner: Joiner | None = None,
    policy: skew.SkewPolicy | None = skew.DEFAULT,
    sample_from: skew.Sample = None,
    lookup_by: str | None = None,
) -> DataFrame:
    """Add the sub-document of one dimension to every fact row.

    ``rows`` holds one row per key. On a miss the sub-document is a blank record
    that keeps the foreign key, or null, or the fact row is dropped. The whole
    record is replaced, so nulls inside a matched row survive. ``ids`` identify
    a fact row; they spread heavy keys. ``lookup_by`` looks the dimension up by
    another column than the foreign key.
    """
    miss = on_miss or dim.on_miss
    how = "inner" if miss == "drop" else "left"
    by = lookup_by or dim.fk
    if miss == "default" and joiner is None:
        flat, kind = _flat_lookup(rows, dim)
        found = skew.lookup_join(fact, flat, by, "__key", how, ids, policy, sample_from)
        filled = _filled(kind, dim)
        return found.withColumn(dim.name, filled).drop("__key", *[f"__{f}" for f in kind.names])
    found = skew.lookup_join(
        fact, _as_lookup(rows, dim), by, "__key", how, ids, policy, sample_from
    ).drop("__key")
    if joiner is not None:
        return found.withColumn(dim.name, joiner(F.col(dim.name), F.col(dim.fk)))
    return found


def _flat_lookup(rows: DataFrame, dim: Dimension) -> tuple[DataFrame, T.StructType]:
    """The sub-document's fields as plain columns, so that fields nobody reads
    are pruned down to the scan of the dimension."""
    key = dim.table.key
    names = [dim.rename_key if c == key and dim.rename_key else c for c in dim.columns]
    record(rows.schema, dim.columns)
    flat = rows.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{n}") for c, n in zip(dim.columns, names)])
    kinds = [rows.schema[c].dataType for c in dim.columns]
    return flat, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])


def _filled(kind: T.StructType, dim: Dimension) -> Column:
    """The matched row, or a blank record. The choice is made for the row as a
    whole, so nulls inside a matched row survive."""
    hit = F.col("__key").isNotNull()
    key = dim.rename_key or dim.table.key
    return F.struct(
        *[
            F.when(hit, F.col(f"__{f.name}"))
            .otherwise(F.col(dim.fk).cast(f.dataType) if f.name == key else blank(f.dataType))
            .alias(f.name)
            for f in kind.fields
        ]
    )


def star_join(
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    star: StarSpec,
    on_miss: OnMiss | None = None,
    policy: skew.SkewPolicy | None = skew.DEFAULT,
    samples: Mapping[str, skew.Sample] | None = None,
) -> DataFrame:
    """Full documents: the fact columns plus one sub-document per dimension.

    ``samples`` gives, per dimension, a cheap table to find heavy keys in.
    """
    ids = [star.fact.key]
    docs = fact
    for dim in star.dims:
        sample = (samples or {}).get(dim.name)
        docs = lookup(docs, tables[dim.name], dim, ids, on_miss, None, policy, sample)
    return docs.select(*star.columns, *[d.name for d in star.dims])


def dimension_led(
    rows: DataFrame,
    facts: DataFrame,
    lead: Dimension,
    order: Sequence[str],
) -> DataFrame:
    """Each dimension row with the most recent fact that references it.

    Rows that no fact references are dropped. Both sides hold one row per key,
    partitioned by that key, so the join adds no shuffle and cannot skew.
    """
    latest = latest_per_group(facts, lead.fk, order)
    return (
        _as_lookup(rows, lead)
        .join(latest, F.col("__key") == F.col(lead.fk), "inner")
        .drop("__key")
    )


def affected_facts(
    facts: DataFrame,
    changed_facts: DataFrame | None,
    changed_dims: Sequence[tuple[Dimension, DataFrame]],
    key: str,
    policy: skew.SkewPolicy | None = skew.DEFAULT,
    samples: Mapping[str, skew.Sample] | None = None,
) -> DataFrame:
    """Keys of the facts whose document may change: changed themselves, or
    referencing a changed dimension row."""
    legs = [] if changed_facts is None else [changed_facts.select(key)]
    for dim, changed in changed_dims:
        keys = changed.select(F.col(dim.table.key).alias("__key")).distinct()
        narrow = facts.select(key, dim.fk).where(F.col(dim.fk).isNotNull())
        sample = (samples or {}).get(dim.name)
        hit = skew.lookup_join(narrow, keys, dim.fk, "__key", "left_semi", [key], policy, sample)
        legs.append(hit.select(key))
    if not legs:
        return facts.select(key).limit(0)
    merged = legs[0]
    for leg in legs[1:]:
        merged = merged.unionByName(leg)
    return merged.distinct()
