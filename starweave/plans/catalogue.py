"""The batch queries, each over whole tables. Nested results are opened to plain
columns so that they can be compared with SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.functions.records import strip_null_entries, strip_nulls, text_map
from starweave.operators import asof, changelog, enrich, partial, skew, transforms, upsert
from starweave.plans import sqltables
from starweave.sources import streams
from starweave.sources import tables as t
from starweave.specs import Dimension, StarSpec, TableSpec

Query = Callable[[SparkSession, str], DataFrame]

BATCH: dict[str, Query] = {}


def query(fn: Query) -> Query:
    BATCH[fn.__name__] = fn
    return fn


def _open(name: str, fields: tuple[str, ...], key: str) -> list[Column]:
    return [F.col(f"{name}.{f}").alias(f if f == key else f"{name}_{f}") for f in fields]


CUSTOMER_FIELDS = ("customer_id", "name", "segment")
PRODUCT_FIELDS = ("product_id", "brand", "name", "sale_price", "rating")


def _customer() -> list[Column]:
    return _open("customer", CUSTOMER_FIELDS, "customer_id")


def _product() -> list[Column]:
    return _open("product", PRODUCT_FIELDS, "product_id")


def _dims(spark: SparkSession, d: str, deletes: bool = False) -> dict[str, DataFrame]:
    return {"customer": t.customer_dim(spark, d, deletes), "product": t.product_dim(spark, d)}


# --- tables, tombstones, reductions -------------------------------------------------


@query
def orders_latest_by_key(spark, d):
    return t.orders_latest(spark, d).select("order_id", "product_id", "customer_id", "ts")


@query
def orders_latest_with_tombstones(spark, d):
    return t.orders_latest(spark, d, deletes=True).select("order_id", "product_id", "customer_id", "ts")


@query
def latest_order_per_customer(spark, d):
    latest = changelog.latest_per_group(t.orders_latest(spark, d), "customer_id", ["version", "order_id"])
    return latest.select("customer_id", "order_id", "product_id", "ts")


@query
def latest_order_per_product(spark, d):
    latest = changelog.latest_per_group(t.orders_latest(spark, d), "product_id", ["version", "order_id"])
    return latest.select("product_id", "order_id", "customer_id", "ts")


@query
def table_to_changelog(spark, d):
    # The change stream is per order and needs no customer, so only lines are read.
    lines = t.order_lines(t.read(spark, d, "lineitem"))
    changes = changelog.to_changelog(lines, "order_id", "version", ["product_id"], "op")
    return changes.select(
        "order_id",
        F.col("change").alias("op"),
        F.col("old.product_id").alias("old_product_id"),
        F.col("new.product_id").alias("new_product_id"),
        "ts",
    )


@query
def fk_switch_orders(spark, d):
    lines = t.order_lines(t.read(spark, d, "lineitem"))
    moved = changelog.key_switches(lines, "order_id", "product_id", "version")
    return moved.toDF("order_id", "old_product_id", "new_product_id")


@query
def rekey_by_fk(spark, d):
    return t.order_log(spark, d).select(F.col("customer_id").alias("key"), "order_id", "product_id", "ts")


# --- lookups ------------------------------------------------------------------------


@query
def enrich_orders_customer(spark, d):
    orders = t.orders_latest(spark, d)
    docs = enrich.lookup(
        orders, t.customer_dim(spark, d), t.CUSTOMER, ["order_id"],
        sample_from=t.samples(spark, d)["customer"],
    )
    return docs.select("order_id", "product_id", *_customer(), "ts")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Current orders with both sub-documents, blanks on a miss."""
    return enrich.star_join(t.orders_latest(spark, d), _dims(spark, d), t.STAR, samples=t.samples(spark, d))


@query
def enrich_orders_left(spark, d):
    return flagship(spark, d).select("order_id", *_customer(), *_product(), "ts")


@query
def enrich_orders_tombstones(spark, d):
    docs = enrich.star_join(
        t.orders_latest(spark, d, deletes=True), _dims(spark, d, True), t.STAR, samples=t.samples(spark, d)
    )
    return docs.select("order_id", *_customer(), *_product(), "ts")


@query
def default_fill_on_miss(spark, d):
    docs = flagship(spark, d)
    missed = docs.where((F.col("customer.name") == "") | (F.col("product.name") == ""))
    return missed.select(
        "order_id",
        "customer.customer_id",
        F.col("customer.name").alias("customer_name"),
        "product.product_id",
        F.col("product.name").alias("product_name"),
        F.col("product.rating").alias("product_rating"),
    )


@query
def stream_table_left_asof(spark, d):
    orders = t.order_log(spark, d).select("order_id", "customer_id", "ts", "product_id", "version")
    found = asof.asof_lookup(
        orders,
        t.customer_log(spark, d),
        "customer_id", "ts", "customer_id", "ts", ["version"], ["acctbal"], "at_ts",
        ["order_id", "version"],
        count_from=t.read(spark, d, "lineitem"),
    )
    return found.select(
        "order_id", "customer_id", "ts", "product_id", F.col("at_ts.acctbal").alias("acctbal_at_ts")
    )


def _customer_led(spark: SparkSession, d: str, orders: DataFrame) -> DataFrame:
    people = changelog.table(t.customer_log(spark, d), t.CUSTOMERS)
    led = enrich.dimension_led(people, orders, t.CUSTOMER, ["version", "order_id"])
    return enrich.lookup(
        led, t.products_now(spark, d), t.PRODUCT, ["order_id"], sample_from=t.samples(spark, d)["product"]
    )


def _product_led(spark: SparkSession, d: str, orders: DataFrame, lookup_by: str | None = None) -> DataFrame:
    goods = changelog.table(t.product_log(spark, d), t.PRODUCTS)
    led = enrich.dimension_led(goods, orders, t.PRODUCT, ["version", "order_id"])
    sample = t.samples(spark, d)["customer"] if lookup_by is None else None
    return enrich.lookup(
        led, t.customers_now(spark, d), t.CUSTOMER, ["order_id"], sample_from=sample, lookup_by=lookup_by
    )


@query
def customer_led_enrichment(spark, d):
    docs = _customer_led(spark, d, t.orders_latest(spark, d))
    return docs.select("order_id", *_customer(), *_product(), "ts")


@query
def product_led_enrichment(spark, d):
    docs = _product_led(spark, d, t.orders_latest(spark, d))
    return docs.select("order_id", *_customer(), *_product(), "ts")


@query
def product_led_as_written(spark, d):
    """The literal form of the leg: the customer is looked up by product id."""
    docs = _product_led(spark, d, t.orders_latest(spark, d), "product_id")
    return docs.select("order_id", *_customer(), *_product(), "ts")


@query
def three_leg_union(spark, d):
    """The three legs over the current orders; their common exchange is reused."""
    orders = t.orders_latest(spark, d).select("order_id", "product_id", "customer_id", "ts", "version")
    whole = {"customer": t.customers_now(spark, d), "product": t.products_now(spark, d)}
    legs = {
        "orders": enrich.star_join(orders, whole, t.STAR, samples=t.samples(spark, d)),
        "customers": _customer_led(spark, d, orders),
        "products": _product_led(spark, d, orders),
    }
    tagged = [
        leg.select(F.lit(name).alias("leg"), "order_id", "customer.customer_id", "product.product_id")
        for name, leg in legs.items()
    ]
    return partial.union_legs(*tagged)


@query
def affected_orders(spark, d):
    changed = t.customer_updates(spark, d).select("customer_id")
    return enrich.affected_facts(
        t.orders_latest(spark, d), None, [(t.CUSTOMER, changed)], "order_id", samples=t.samples(spark, d)
    )


@query
def sql_three_way_inner(spark, d):
    docs = spark.sql(
        sqltables.ENRICH_SQL,
        orders=t.orders_latest(spark, d),
        customers=t.customer_dim(spark, d),
        products=t.product_dim(spark, d),
    )
    return opened_maps(docs)


def opened_maps(docs: DataFrame) -> DataFrame:
    """One row per entry of the two maps of an inserted row."""
    named = F.array(
        *[F.struct(F.lit(m).alias("map_name"), F.col(m).alias("entries")) for m in ("product", "customer")]
    )
    return (
        docs.select("order_id", "id", "ts", F.explode(named).alias("m"))
        .select("order_id", "id", "ts", "m.map_name", F.explode("m.entries"))
        .select("order_id", "id", "map_name", "key", "value", "ts")
    )


@query
def pk_table_project(spark, d):
    """A keyed table filled by position from a wider log."""
    target = TableSpec("people", "customer_id", (), T.StructType.fromDDL("customer_id STRING, name STRING"))
    current = changelog.table(t.customer_log(spark, d), t.CUSTOMERS)
    return sqltables.insert_select(spark, "people", target, "SELECT customer_id, name FROM {log}", log=current)


# --- partial documents --------------------------------------------------------------

PARTIAL_CUSTOMER = Dimension("customer", t.CUSTOMERS, "customer_id", CUSTOMER_FIELDS, "null")
PARTIAL_PRODUCT = Dimension("product", t.PRODUCTS, "product_id", ("product_id", "brand", "name"), "null")


PARTIAL_DIMS = (PARTIAL_CUSTOMER, PARTIAL_PRODUCT)
FLAT_RATING = 30


def partial_legs(spark: SparkSession, d: str) -> list[DataFrame]:
    """The three legs as separate plans; what one sink filters out is never computed."""
    orders, tables, samples = t.orders_latest(spark, d), _dims(spark, d), t.samples(spark, d)
    return [
        partial.main_leg(orders, "order_id", ["ts"]),
        *[
            partial.dimension_leg(orders, tables[dim.name], dim, "order_id", sample_from=samples[dim.name])
            for dim in PARTIAL_DIMS
        ],
    ]


def _nested_partials(spark: SparkSession, d: str) -> DataFrame:
    """All three legs, from one pass over the orders."""
    wide = partial.wide_rows(
        t.orders_latest(spark, d), _dims(spark, d), PARTIAL_DIMS, "order_id", ["ts"],
        samples=t.samples(spark, d),
    )
    return partial.stacked_legs(wide, "order_id", [["ts"], ["customer"], ["product"]])


@query
def partial_orders_main(spark, d):
    return partial_legs(spark, d)[0]


@query
def partial_orders_customer(spark, d):
    leg = partial_legs(spark, d)[1]
    return leg.select("order_id", "customer.customer_id", F.col("customer.name").alias("customer_name"))


@query
def partial_orders_product(spark, d):
    leg = partial_legs(spark, d)[2]
    return leg.select("order_id", "product.product_id", F.col("product.name").alias("product_name"))


@query
def partial_union(spark, d):
    return _nested_partials(spark, d).select("order_id", "customer.customer_id", "product.product_id", "ts")


@query
def sink_ts_only(spark, d):
    return upsert.only_present(partial.union_legs(*partial_legs(spark, d)), "ts", ["product", "customer"])


@query
def sink_product_only(spark, d):
    rows = upsert.only_present(partial.union_legs(*partial_legs(spark, d)), "product", ["ts", "customer"])
    return rows.select("order_id", "product.product_id", F.col("product.name").alias("product_name"))


@query
def sink_customer_only(spark, d):
    rows = upsert.only_present(partial.union_legs(*partial_legs(spark, d)), "customer", ["ts", "product"])
    return rows.select("order_id", "customer.customer_id", F.col("customer.name").alias("customer_name"))


def _merged_legs(spark: SparkSession, d: str) -> DataFrame:
    """Per order and sub-document the newest version whose key the dimension has: found on
    keys and versions alone, so each sub-document is fetched once per order."""
    rows, tables, samples = t.order_log(spark, d), _dims(spark, d), t.samples(spark, d)
    found = [F.max_by("ts", F.when(F.col("ts").isNotNull(), F.col("version"))).alias("ts")]
    for dim in PARTIAL_DIMS:
        known = tables[dim.name].select(F.col(dim.table.key).alias("__key"))
        ids = ["order_id", "version"]
        rows = skew.lookup_join(rows, known, dim.fk, "__key", "left", ids, sample_from=samples[dim.name])
        rows = rows.withColumnRenamed("__key", f"known_{dim.fk}")
        held = F.col(f"known_{dim.fk}")
        found.append(F.max_by(held, F.when(held.isNotNull(), F.col("version"))).alias(dim.fk))
    docs = rows.groupBy("order_id").agg(*found)
    for dim in PARTIAL_DIMS:
        docs = enrich.lookup(docs, tables[dim.name], dim, ["order_id"], sample_from=samples[dim.name])
    return docs


@query
def partial_merge_converged(spark, d):
    return _merged_legs(spark, d).select(
        "order_id",
        *_customer(),
        *_open("product", ("product_id", "brand", "name"), "product_id"),
        "ts",
    )


@query
def partial_merge_flattened(spark, d):
    # Products of a lower rating have no brand here: a newer one keeps the brand of the one before.
    tables = _dims(spark, d)
    brand = F.when(F.col("rating") > FLAT_RATING, F.col("brand"))
    tables["product"] = tables["product"].withColumn("brand", brand)
    rows = partial.wide_rows(
        t.order_log(spark, d), tables, PARTIAL_DIMS, "order_id", ["ts"], ["version"], samples=t.samples(spark, d)
    )
    docs = partial.merge_fields(rows, "order_id", "version", ["customer", "product", "ts"], flat=True)
    return docs.select(
        "order_id",
        F.col("customer_customer_id").alias("customer_id"),
        "customer_name",
        "customer_segment",
        F.col("product_product_id").alias("product_id"),
        "product_brand",
        "product_name",
        "ts",
    )


@query
def contract_violations(spark, d):
    return transforms.contract_violations(
        _nested_partials(spark, d), "order_id", ["customer", "product", "ts"]
    )


# --- sinks --------------------------------------------------------------------------


@query
def replace_one_converged(spark, d):
    """The last version's document wins with its nulls. It is replaced whole, so
    orders are compacted first and only the newest version is looked up."""
    docs, tables, samples = t.orders_latest(spark, d), _dims(spark, d), t.samples(spark, d)
    for dim in (PARTIAL_CUSTOMER, PARTIAL_PRODUCT):
        docs = enrich.lookup(docs, tables[dim.name], dim, ["order_id"], sample_from=samples[dim.name])
    return docs.select(
        "order_id",
        "customer.customer_id",
        F.col("customer.name").alias("customer_name"),
        "product.product_id",
        F.col("product.name").alias("product_name"),
        "ts",
    )


@query
def sink_delete_on_null(spark, d):
    """A message without a body removes its document. Lines are ranked before the customer is attached."""
    lines = t.order_lines(t.read(spark, d, "lineitem"))
    body = F.when(F.col("op") != changelog.DELETE, F.struct("product_id", "ts"))
    rows = lines.select("order_id", "version", body.alias("body"))
    marked = rows.withColumn("op", F.when(F.col("body").isNull(), changelog.DELETE).otherwise(changelog.UPSERT))
    stored = upsert.replace_documents(marked, "order_id", "version", "op").select("order_id", "version", "body.*")
    owned = t.with_customer(stored, t.read(spark, d, "orders"), unique=True)
    return owned.select("order_id", "product_id", "customer_id", "ts")


@query
def update_many_dimension(spark, d):
    docs = enrich.lookup(
        t.orders_latest(spark, d),
        t.customers_now(spark, d),
        Dimension("customer", t.CUSTOMERS, "customer_id", ("customer_id", "name", "acctbal"), "default"),
        ["order_id"],
        sample_from=t.samples(spark, d)["customer"],
    ).select("order_id", "customer", "ts")
    changed = upsert.update_matching(
        docs,
        t.customer_updates(spark, d),
        "customer",
        "customer.customer_id",
        "order_id",
        "customer_id",
        "version",
        F.struct("customer_id", "name", "acctbal"),
        sample_from=t.samples(spark, d)["customer"],
    )
    return changed.select(
        "order_id",
        "customer.customer_id",
        F.col("customer.name").alias("customer_name"),
        F.col("customer.acctbal").alias("customer_acctbal"),
        "ts",
    )


# --- transforms ---------------------------------------------------------------------


@query
def remove_null_fields_struct(spark, d):
    rows = _nested_partials(spark, d).select("order_id", "customer", "product", "ts")
    return rows.select("order_id", strip_nulls(F.struct(*rows.columns)).alias("doc"))


@query
def remove_null_fields_map(spark, d):
    rows = _nested_partials(spark, d)
    entries = text_map(
        {
            "customer_id": F.col("customer.customer_id"),
            "product_id": F.col("product.product_id"),
            "product_name": F.col("product.name"),
        }
    )
    return rows.select("order_id", F.explode(strip_null_entries(entries)))


@query
def value_to_key_rename(spark, d):
    rows = transforms.as_records(t.orders_latest(spark, d).select("order_id", "product_id"))
    keyed = transforms.chain(
        rows, [transforms.value_to_key(["order_id"]), transforms.rename_key({"order_id": "_id"})]
    )
    return keyed.select("key._id", "value.*")


# Option and type names of connector settings.
SINGLE_SINK = {
    "transforms": "copyIdToKey,replaceFieldInKey,removeNullFields",
    "transforms.copyIdToKey.type": "ValueToKey",
    "transforms.copyIdToKey.fields": "order_id",
    "transforms.replaceFieldInKey.type": "ReplaceField$Key",
    "transforms.replaceFieldInKey.renames": "order_id:_id",
    "transforms.removeNullFields.type": "RemoveNullFields",
}


@query
def transform_chain(spark, d):
    rows = _nested_partials(spark, d).select("order_id", "customer", "product", "ts")
    done = transforms.chain(transforms.as_records(rows), transforms.chain_from_config(SINGLE_SINK))
    return done.select("key._id", F.col("value").alias("doc"))


@query
def document_projection(spark, d):
    halves = F.split("name", "#")
    people = t.customers_now(spark, d).withColumns(
        {"first_name": F.get(halves, F.lit(0)), "last_name": F.get(halves, F.lit(1))}
    )
    dim = Dimension("customer", t.CUSTOMERS, "customer_id", ("customer_id", "first_name", "last_name", "segment"))
    star = StarSpec(t.ORDERS, (dim, t.PRODUCT), ("order_id", "ts"))
    docs = enrich.star_join(
        t.orders_latest(spark, d), {"customer": people, "product": t.products_now(spark, d)}, star,
        samples=t.samples(spark, d),
    )
    stored = transforms.document(docs.select("order_id", "customer", "product", "ts"), "order_id")
    return stored.select(
        "_id",
        "order_id",
        "customer.customer_id",
        F.col("customer.firstName").alias("customer_firstName"),
        F.col("customer.lastName").alias("customer_lastName"),
        F.col("customer.segment").alias("customer_segment"),
        *_product(),
        "ts",
    )


ROUTES = {
    "signup": "customer",
    "error": "customer",
    "view": "product",
    "click": "product",
    "purchase": "product",
}


@query
def route_by_record_type(spark, d):
    events = t.read(spark, d, "events")
    return events.select("event_id", transforms.route(F.col("event_type"), ROUTES).alias("route"))


@query
def decode_json_records(spark, d):
    """Events as messages with a key, a JSON body and a position; one without a body is a tombstone."""
    events = t.read(spark, d, "events")
    body = F.when(F.col("event_type") != "error", F.col("props"))
    messages = events.select(
        F.col("event_id").alias("key"),
        body.alias("value"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    decoded = streams.keyed_messages(messages, streams.decode_json(F.col("value"), "k BIGINT"))
    return decoded.select(F.col("key").cast("long").alias("event_id"), "op", "value.k")
