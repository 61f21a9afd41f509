"""Record shapes of the shoe-shop feeds. Streams never infer a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _record(required: bool = True, **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, not required) for n, t in fields.items()])


_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()

# Field names, order and types of the published records.
CUSTOMER = _record(
    id=_S, first_name=_S, last_name=_S, email=_S, phone=_S,
    street_address=_S, state=_S, zip_code=_S, country=_S, country_code=_S,
)
ORDER = _record(order_id=_I, product_id=_S, customer_id=_S, ts=_TS)
PRODUCT = _record(id=_S, brand=_S, name=_S, sale_price=_I, rating=_D)
ORDER_DOCUMENT = _record(order_id=_I, product=PRODUCT, customer=CUSTOMER, ts=_TS)


def to_millis(df: DataFrame, *columns: str) -> DataFrame:
    """Cut timestamps to the millisecond precision the feeds carry."""
    return df.withColumns(
        {c: F.date_trunc("millisecond", c).cast(T.TimestampNTZType()) for c in columns}
    )


def required_fields(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of all fields a schema declares non-null."""
    names = []
    for field in schema.fields:
        if not field.nullable:
            names.append(prefix + field.name)
            if isinstance(field.dataType, T.StructType):
                names += required_fields(field.dataType, f"{prefix}{field.name}.")
    return names
