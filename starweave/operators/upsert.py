"""What a document sink does with the rows it receives, as batch operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.operators import skew
from starweave.operators.changelog import DELETE, latest_by_key


def replace_documents(
    rows: DataFrame, key: str, version: str | Sequence[str], op: str | None = None
) -> DataFrame:
    """Whole-document replace: the newest row wins with all its fields, nulls
    included; a newest row that is a delete removes the document."""
    return latest_by_key(rows, key, version, op)


def update_matching(
    docs: DataFrame,
    changes: DataFrame,
    field: str,
    match: str,
    key: str,
    change_key: str,
    version: str | Sequence[str],
    value: Column,
    policy: skew.SkewPolicy | None = skew.DEFAULT,
    sample_from: skew.Sample = None,
    op: str | None = None,
) -> DataFrame:
    """Set ``field`` in every document whose ``match`` equals a changed key.

    Only the newest change per key counts. Changes without a document insert
    nothing; with ``op``, a key whose newest change is a delete changes nothing. ``match`` may be a nested field such as ``customer.id``;
    ``sample_from`` holds the same values in a column ``__match``.
    """
    newest = latest_by_key(changes, change_key, version, op).select(
        F.col(change_key).alias("__changed"), value.alias("__value")
    )
    keyed = docs.withColumn("__match", F.col(match))
    joined = skew.lookup_join(keyed, newest, "__match", "__changed", "left", [key], policy, sample_from)
    return joined.withColumn(field, F.coalesce("__value", field)).drop(
        "__match", "__changed", "__value"
    )


def only_present(rows: DataFrame, field: str, drop: Sequence[str] = (), op: str | None = None) -> DataFrame:
    """Rows that carry a field, without the fields other sinks are in charge of.
    With ``op``, deletes pass as well: every sink has to see them."""
    wanted = F.col(field).isNotNull()
    if op is not None:
        wanted |= F.col(op) == DELETE
    return rows.where(wanted).drop(*drop)
