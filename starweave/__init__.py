"""Keep denormalised documents up to date from changing tables, on Spark."""

from starweave.specs import Dimension, StarSpec, TableSpec

__all__ = ["Dimension", "StarSpec", "TableSpec"]
