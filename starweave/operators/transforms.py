"""Single-record transforms, applied in the order they are named.

A record is a row with columns ``key`` and ``value`` (struct or map; null for a
tombstone). Transforms are ``DataFrame -> DataFrame`` and chain with
``DataFrame.transform``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.functions import records

Transform = Callable[[DataFrame], DataFrame]

_PRESENT = re.compile(r"^\$\.?\[\?\(@\.(\w+)\)\]$")


def as_records(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as records; ``key`` becomes a one-field key, or the key stays null."""
    named = F.struct(key) if key else F.lit(None).cast("string")
    return df.select(named.alias("key"), F.struct(*df.columns).alias("value"))


def _field(df: DataFrame, name: str) -> Column | None:
    """A field of the value; null in records without it, None if no record can have it."""
    kind = df.schema["value"].dataType
    if isinstance(kind, T.MapType):
        return F.try_element_at("value", F.lit(name))
    return F.col("value")[name] if name in kind.names else None


def value_to_key(fields: Sequence[str]) -> Transform:
    """Copy value fields into the key."""

    def apply(df: DataFrame) -> DataFrame:
        found = {f: _field(df, f) for f in fields}
        missing = [f for f, c in found.items() if c is None]
        if missing:
            raise ValueError(f"the value has no fields {missing}")
        return df.withColumn("key", F.struct(*[c.alias(f) for f, c in found.items()]))

    return apply


def _renamed(column: str, renames: Mapping[str, str]) -> Transform:
    def apply(df: DataFrame) -> DataFrame:
        kind = df.schema[column].dataType
        if isinstance(kind, T.MapType):
            names = F.create_map(*[F.lit(n) for pair in renames.items() for n in pair])
            new = F.transform_keys(column, lambda k, _: F.coalesce(F.try_element_at(names, k), k))
        else:
            new = records.rename_fields(F.col(column), kind, renames)
        return df.withColumn(column, new)

    return apply


def rename_key(renames: Mapping[str, str]) -> Transform:
    return _renamed("key", renames)


def rename_value(renames: Mapping[str, str]) -> Transform:
    return _renamed("value", renames)


def _chosen(column: str, fields: Sequence[str], keep: bool) -> Transform:
    def apply(df: DataFrame) -> DataFrame:
        kind = df.schema[column].dataType
        whole = F.col(column)
        if isinstance(kind, T.MapType):
            listed = F.array(*[F.lit(f) for f in fields])
            inside = lambda k: F.array_contains(listed, k)
            return df.withColumn(column, F.map_filter(whole, lambda k, _: inside(k) if keep else ~inside(k)))
        if not isinstance(kind, T.StructType):
            return df  # a key that is not a record yet
        kept = [n for n in kind.names if (n in fields) == keep]
        if not kept:
            raise ValueError(f"no field of the {column} would be left of {kind.names}")
        if kept == kind.names:
            return df
        return df.withColumn(column, F.when(whole.isNotNull(), F.struct(*[whole[n].alias(n) for n in kept])))

    return apply


def exclude(fields: Sequence[str], column: str = "value") -> Transform:
    """Drop fields; names the record does not have are ignored."""
    return _chosen(column, fields, keep=False)


def include(fields: Sequence[str], column: str = "value") -> Transform:
    """Keep only these fields."""
    return _chosen(column, fields, keep=True)


def keep_present(field: str, otherwise: str = "exclude", drop: bool = False) -> Transform:
    """Keep (with ``drop``: drop) records whose value has the field.

    ``otherwise`` says what a record gets whose field is missing or null:
    ``exclude`` drops it, ``include`` keeps it, ``fail`` stops the job.
    """
    if otherwise not in ("exclude", "include", "fail"):
        raise ValueError(f"unknown behaviour {otherwise!r} for a missing field")

    def apply(df: DataFrame) -> DataFrame:
        found = _field(df, field)
        absent = F.lit(True) if found is None else found.isNull()
        if otherwise == "fail":
            fallback = F.raise_error(F.lit(f"field {field} is missing or null")).cast("boolean")
        else:
            fallback = F.lit(otherwise == "include")
        return df.where(F.when(absent, fallback).otherwise(F.lit(not drop)))

    return apply


def remove_nulls() -> Transform:
    """Structs lose nulls at every depth (as JSON text), maps at the top level."""

    def apply(df: DataFrame) -> DataFrame:
        nested = isinstance(df.schema["value"].dataType, T.StructType)
        strip = records.strip_nulls if nested else records.strip_null_entries
        return df.withColumn("value", strip(F.col("value")))

    return apply


def flatten_value(separator: str = ".") -> Transform:
    """Open nested fields of the value, so that they can be merged one by one."""

    def apply(df: DataFrame) -> DataFrame:
        def leaves(kind: T.StructType, at: Column, label: str) -> list[Column]:
            out: list[Column] = []
            for f in kind.fields:
                if isinstance(f.dataType, T.StructType):
                    out += leaves(f.dataType, at[f.name], label + f.name + separator)
                else:
                    out.append(at[f.name].alias(label + f.name))
            return out

        value = F.col("value")
        opened = F.struct(*leaves(df.schema["value"].dataType, value, ""))
        return df.withColumn("value", F.when(value.isNotNull(), opened))

    return apply


def chain(df: DataFrame, steps: Sequence[Transform]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


Factory = Callable[[Mapping[str, str]], Transform]
"""From a transform's own options (without its name) to the transform."""

_REGISTERED: dict[str, Factory] = {}


def register_transform(kind: str, factory: Factory) -> None:
    """Make a transform available to settings under a type name (its last part)."""
    _REGISTERED[kind] = factory


def chain_from_config(config: Mapping[str, str]) -> list[Transform]:
    """Read a sink connector's ``transforms`` settings, in their named order.

    An option that a transform does not understand is an error.
    """
    names = [n.strip() for n in config.get("transforms", "").split(",") if n.strip()]
    return [_step(name, config) for name in names]


def _step(name: str, config: Mapping[str, str]) -> Transform:
    start = f"transforms.{name}."
    options = {k.removeprefix(start): v for k, v in config.items() if k.startswith(start)}
    kind = options.pop("type", "").rsplit(".", 1)[-1]
    if kind not in _REGISTERED:
        raise ValueError(f"transform {name}: unknown type {config.get(start + 'type')!r}")
    try:
        return _REGISTERED[kind](options)
    except ValueError as e:
        raise ValueError(f"transform {name}: {e}") from e


def _only(options: Mapping[str, str], *known: str) -> None:
    unknown = sorted(set(options) - set(known))
    if unknown:
        raise ValueError(f"options {unknown} are not supported")


def _listed(text: str) -> list[str]:
    return [f.strip() for f in text.split(",") if f.strip()]


def _replace_field(column: str) -> Factory:
    def make(options: Mapping[str, str]) -> Transform:
        _only(options, "exclude", "include", "renames")
        dropped, kept = _listed(options.get("exclude", "")), _listed(options.get("include", ""))
        renames = dict(pair.split(":", 1) for pair in _listed(options.get("renames", "")))
        steps = [exclude(dropped, column)] if dropped else []
        steps += [include(kept, column)] if kept else []
        steps += [_renamed(column, renames)] if renames else []
        return lambda df: chain(df, steps)

    return make


def _filter(options: Mapping[str, str]) -> Transform:
    _only(options, "filter.condition", "filter.type", "missing.or.null.behavior")
    found = _PRESENT.match(options.get("filter.condition", ""))
    kind = options.get("filter.type", "include")
    if not found or kind not in ("include", "exclude"):
        raise ValueError("only 'field is present' filters are supported")
    return keep_present(found.group(1), options.get("missing.or.null.behavior", "fail"), kind == "exclude")


def _value_to_key(options: Mapping[str, str]) -> Transform:
    _only(options, "fields")
    return value_to_key(_listed(options.get("fields", "")))


def _remove_nulls(options: Mapping[str, str]) -> Transform:
    _only(options)
    return remove_nulls()


def _flatten(options: Mapping[str, str]) -> Transform:
    _only(options, "delimiter")
    return flatten_value(options.get("delimiter", "."))


# Type names that connector settings use.
for _kind, _factory in {
    "ValueToKey": _value_to_key,
    "ReplaceField$Key": _replace_field("key"),
    "ReplaceField$Value": _replace_field("value"),
    "Filter$Value": _filter,
    "RemoveNullFields": _remove_nulls,
    "Flatten$Value": _flatten,
}.items():
    register_transform(_kind, _factory)


def route(kind: Column, routes: Mapping[str, str]) -> Column:
    """Target per record type; an unknown type fails the job."""
    chosen = F.lit(None).cast("string")
    known = F.lit(False)
    for name, target in routes.items():
        chosen = F.when(kind == name, target).otherwise(chosen)
        known = known | kind.eqNullSafe(name)
    complaint = F.concat(F.lit("no route for record type "), F.coalesce(kind, F.lit("null")))
    return F.when(known, chosen).otherwise(F.raise_error(complaint).cast("string"))


def contract_violations(df: DataFrame, key: str, required: Sequence[str]) -> DataFrame:
    """One row per required field that is null: ``(key, missing_field)``."""
    absent = F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in required])
    return df.select(key, F.explode(F.array_compact(absent)).alias("missing_field"))


def enforce_contract(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail the job at the first row that misses a required field."""
    for f in required:
        df = df.where(
            F.assert_true(F.col(f).isNotNull(), f"required field {f} is null").isNull()
        )
    return df


CUSTOMER_RENAMES = {"first_name": "firstName", "last_name": "lastName"}
"""Fixed values: field spellings of the stored customer sub-document."""


def document(df: DataFrame, key: str, customer: str = "customer", renames: Mapping[str, str] = CUSTOMER_RENAMES) -> DataFrame:
    """Stored form of an enriched row: ``_id`` beside the key, customer renamed."""
    kind = df.schema[customer].dataType
    return df.withColumn(customer, records.rename_fields(F.col(customer), kind, renames)).select(
        F.col(key).alias("_id"), *df.columns
    )
