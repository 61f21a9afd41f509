"""Declarations: what is a table's key, how are its versions ordered, which
dimensions hang off a fact table. The library is written against these, not
against any particular star."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import types as T

OnMiss = Literal["default", "null", "drop"]


@dataclass(frozen=True)
class TableSpec:
    """A keyed changelog. Row order is ``version`` (oldest first), never arrival."""

    name: str
    key: str
    version: tuple[str, ...]
    schema: T.StructType | None = None
    op: str | None = None


@dataclass(frozen=True)
class Dimension:
    """One foreign key of a fact table and the sub-document it fills."""

    name: str
    table: TableSpec
    fk: str
    columns: tuple[str, ...]
    on_miss: OnMiss = "default"
    rename_key: str | None = None
    """Name of the key inside the sub-document (default: the table's key)."""


@dataclass(frozen=True)
class StarSpec:
    """A fact table, its dimensions, and the fact columns that go in the document."""

    fact: TableSpec
    dims: tuple[Dimension, ...]
    columns: tuple[str, ...]

    def tables(self) -> list[TableSpec]:
        """Every table once, also if several foreign keys refer to it."""
        found: dict[str, TableSpec] = {}
        for spec in (self.fact, *(d.table for d in self.dims)):
            if found.setdefault(spec.name, spec) != spec:
                raise ValueError(f"two different tables are called {spec.name}")
        return list(found.values())


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)
