"""A small shoe shop, in the record shapes of the feeds."""

from datetime import datetime

from pyspark.sql import types as T

from starweave.schemas import CUSTOMER, ORDER, PRODUCT
from starweave.specs import Dimension, StarSpec, TableSpec


def versioned(schema):
    """A feed as a changelog: payload nullable (tombstones), plus op and version."""
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    return T.StructType([*fields, T.StructField("op", T.StringType()), T.StructField("version", T.LongType())])


ORDERS = TableSpec("orders", "order_id", ("version",), versioned(ORDER), op="op")
CUSTOMERS = TableSpec("customers", "id", ("version",), versioned(CUSTOMER), op="op")
PRODUCTS = TableSpec("products", "id", ("version",), versioned(PRODUCT), op="op")
STAR = StarSpec(
    ORDERS,
    (
        Dimension("customer", CUSTOMERS, "customer_id", tuple(CUSTOMER.names)),
        Dimension("product", PRODUCTS, "product_id", tuple(PRODUCT.names)),
    ),
    ("order_id", "ts"),
)
SCHEMAS = {s.name: s.schema for s in STAR.tables()}
TS = datetime(2024, 3, 1, 12, 0, 0, 123000)


def order(order_id, product_id, customer_id, version, op="upsert", ts=TS):
    return (order_id, product_id, customer_id, ts, op, version)


def customer(id, first, version, op="upsert", email="a@b.c"):
    return (id, first, "Doe", email, "555", "1 Main St", "NY", "10001", "USA", "US", op, version)


def product(id, name, version, op="upsert", price=100, rating=4.5):
    return (id, "nike", name, price, rating, op, version)


def rows(spark, spec, *data):
    return spark.createDataFrame(list(data), spec.schema)
