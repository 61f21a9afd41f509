"""Column expressions on nested records: defaults, null stripping, renames, maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def record(schema: T.StructType, columns: Sequence[str], renames: Mapping[str, str] | None = None) -> Column:
    """Struct of the named columns of a table, some under another name."""
    renames = renames or {}
    missing = [c for c in columns if c not in schema.names]
    if missing:
        raise ValueError(f"unknown columns {missing}; the table has {schema.names}")
    return F.struct(*[F.col(c).alias(renames.get(c, c)) for c in columns])


def blank(kind: T.DataType) -> Column:
    """What a missing field is filled with: "" for text, 0 for numbers, else null."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[blank(f.dataType).alias(f.name) for f in kind.fields])
    return F.lit(None).cast(kind)


def strip_nulls(value: Column) -> Column:
    """JSON text of a struct without null fields, at any depth; ``{}`` is kept.

    Text, because a typed struct cannot lose fields row by row.
    """
    return F.to_json(value, {"ignoreNullFields": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS"})


def strip_null_entries(value: Column) -> Column:
    """A map without its null values (top level only)."""
    return F.map_filter(value, lambda _, v: v.isNotNull())


def text_map(fields: Mapping[str, Column]) -> Column:
    """``map<string,string>`` from named columns, all cast to text."""
    parts: list[Column] = []
    for name, column in fields.items():
        parts += [F.lit(name), column.cast("string")]
    return F.create_map(*parts)


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Open struct columns, at any depth, to ``parent<sep>child`` columns."""

    def leaves(schema: T.StructType, path: str, label: str) -> list[Column]:
        found: list[Column] = []
        for f in schema.fields:
            here, name = f"{path}`{f.name}`", label + f.name
            if isinstance(f.dataType, T.StructType):
                found += leaves(f.dataType, here + ".", name + separator)
            else:
                found.append(F.col(here).alias(name))
        return found

    return df.select(*leaves(df.schema, "", ""))


def rename_fields(value: Column, kind: T.StructType, renames: Mapping[str, str]) -> Column:
    """A struct with some fields renamed, null where the input is null."""
    renamed = F.struct(*[value[f.name].alias(renames.get(f.name, f.name)) for f in kind.fields])
    return F.when(value.isNotNull(), renamed)
