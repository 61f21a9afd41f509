"""Changelog views over the test tables.

``lineitem`` joined to ``orders`` is the fact changelog (every line is a version
of its order), ``customer`` plus ``events`` the customer changelog, ``part`` the
product changelog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.operators import skew
from starweave.operators.changelog import DELETE, UPSERT, latest_by_key
from starweave.specs import Dimension, StarSpec, TableSpec

ORDERS = TableSpec("orders", "order_id", ("version",))
ORDERS_DEL = TableSpec("orders", "order_id", ("version",), op="op")
CUSTOMERS = TableSpec("customers", "customer_id", ("version",))
CUSTOMERS_DEL = TableSpec("customers", "customer_id", ("version",), op="op")
PRODUCTS = TableSpec("products", "product_id", ("version",))

CUSTOMER = Dimension("customer", CUSTOMERS, "customer_id", ("customer_id", "name", "segment"))
PRODUCT = Dimension(
    "product", PRODUCTS, "product_id", ("product_id", "brand", "name", "sale_price", "rating")
)
STAR = StarSpec(ORDERS, (CUSTOMER, PRODUCT), ("order_id", "ts"))


# Columns and types of the tables, so that no job infers them.
SCHEMAS = {
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,
        props STRING""",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_lines(lineitem: DataFrame, *more: Column) -> DataFrame:
    """Order versions without their customer, straight from the line table; with ``more`` columns of it."""
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_linenumber").alias("line"),
        F.when(F.col("l_returnflag") == "R", DELETE).otherwise(UPSERT).alias("op"),
        F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("version"),
        *more,
    )


def with_customer(
    lines: DataFrame, orders: DataFrame, unique: bool, sample_from: skew.Sample = None
) -> DataFrame:
    """Attach each order's customer. ``unique``: one line per order, so no order is heavy."""
    owners = orders.select(
        F.col("o_orderkey").alias("__order"), F.col("o_custkey").cast("string").alias("customer_id")
    )
    policy = None if unique else skew.DEFAULT
    return skew.lookup_join(
        lines, owners, "order_id", "__order", "inner", ["order_id", "version"], policy, sample_from
    ).drop("__order")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(read(spark, sf_dir, "lineitem"))
    return with_customer(lines, read(spark, sf_dir, "orders"), unique=False)


def dealt_order_log(spark: SparkSession, sf_dir: str, pieces: int) -> DataFrame | None:
    """``order_log`` with the rows of an order dealt over ``pieces`` partitions by the shuffle that finds its customer;
    none if that needs no shuffle. What is made of the line's columns is made behind the shuffle."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    owners = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("__order"), F.col("o_custkey").alias("__owner"))
    if skew.scan_bytes(owners) <= skew.broadcast_limit(owners):
        return None
    owned = skew.salted_join(lines, owners, "l_orderkey", "__order", "inner", lines.columns, pieces=pieces)
    return order_lines(owned, F.col("__owner").cast("string").alias("customer_id"))


def orders_latest(spark: SparkSession, sf_dir: str, deletes: bool = False) -> DataFrame:
    """Current orders. Lines are compacted before the customer is attached: the
    version does not involve the customer, so only one row per order is joined,
    on the key the compaction already partitioned by."""
    lines = order_lines(read(spark, sf_dir, "lineitem"))
    current = latest_by_key(lines, "order_id", "version", "op" if deletes else None)
    return with_customer(current, read(spark, sf_dir, "orders"), unique=True)


def samples(spark: SparkSession, sf_dir: str) -> dict[str, skew.Sample]:
    """Where to look for heavy foreign keys: the stored tables that hold them."""

    def owners() -> DataFrame:
        orders = read(spark, sf_dir, "orders")
        customer = F.col("o_custkey").cast("string")
        return orders.select(
            F.col("o_orderkey").alias("order_id"), customer.alias("customer_id"), customer.alias("__match")
        )

    return {
        "customer": owners,
        "product": lambda: order_lines(read(spark, sf_dir, "lineitem")).select("order_id", "product_id", "version"),
    }


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer")
    events = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    named = customers.select("c_custkey", "c_name", "c_mktsegment")
    joined = skew.lookup_join(events, named, "user_id", "c_custkey", "inner", ["event_id"])
    when = F.col("ts") - F.expr("INTERVAL 25 YEARS")
    return joined.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("value").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
        when.alias("ts"),
        F.when(F.col("event_type") == "error", DELETE).otherwise(UPSERT).alias("op"),
        F.struct(when.alias("at"), F.col("event_id").alias("seq")).alias("version"),
    )


_START = "TIMESTAMP_NTZ '1990-01-01 00:00:00'"


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
        F.expr(_START).alias("ts"),
        F.lit(UPSERT).alias("op"),
        F.struct(F.expr(_START).alias("at"), F.lit(-1).cast("long").alias("seq")).alias("version"),
    )
    return base.unionByName(customer_updates(spark, sf_dir))


def product_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("sale_price"),
        F.col("p_size").alias("rating"),
        F.expr(_START).alias("ts"),
        F.lit(UPSERT).alias("op"),
        F.struct(F.expr(_START).alias("at"), F.col("p_partkey").alias("seq")).alias("version"),
    )


def customer_dim(spark: SparkSession, sf_dir: str, deletes: bool = False) -> DataFrame:
    """Current customers, one segment left out so that lookups miss."""
    log = customer_log(spark, sf_dir)
    current = latest_by_key(log, "customer_id", "version", "op" if deletes else None)
    return current.where("segment <> 'FURNITURE'")


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current products, small ratings left out so that lookups miss."""
    return latest_by_key(product_log(spark, sf_dir), "product_id", "version").where("rating > 10")


def customers_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All current customers."""
    return latest_by_key(customer_log(spark, sf_dir), "customer_id", "version")


def products_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All current products."""
    return latest_by_key(product_log(spark, sf_dir), "product_id", "version")
