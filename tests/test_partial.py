import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starweave.operators import partial, upsert
from tests import shop

SCHEMA = "id INT, a STRING, b STRING, version INT, op STRING"
FIELDS = ["a", "b"]


def _docs(df):
    return {r.id: (r.a, r.b) for r in df.collect()}


def test_last_non_null_per_field(spark):
    rows = spark.createDataFrame(
        [(1, "x", None, 1, "upsert"), (1, None, "y", 2, "upsert"), (1, "z", None, 3, "upsert"), (2, None, None, 1, "upsert")],
        SCHEMA,
    )
    want = {1: ("z", "y"), 2: (None, None)}
    assert _docs(partial.merge_fields(rows, "id", "version", FIELDS)) == want
    assert _docs(partial.merge_fields(rows, "id", "version", FIELDS, "op")) == want


def test_delete_drops_what_was_written_before(spark):
    rows = spark.createDataFrame(
        [(1, "x", "y", 1, "upsert"), (1, None, None, 2, "delete"), (1, None, "new", 3, "upsert"), (2, "q", None, 1, "upsert"),
         (2, None, None, 2, "delete")],
        SCHEMA,
    )
    assert _docs(partial.merge_fields(rows, "id", "version", FIELDS, "op")) == {1: (None, "new")}


def test_flat_merge_goes_below_the_sub_document(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES (1, named_struct('x', 'a', 'y', 'b'), 1), (1, named_struct('x', 'c', 'y', CAST(NULL AS STRING)), 2)
           AS t(id, sub, version)"""
    )
    whole = partial.merge_fields(rows, "id", "version", ["sub"]).collect()[0]
    assert tuple(whole.sub) == ("c", None)
    flat = partial.merge_fields(rows, "id", "version", ["sub"], flat=True).collect()[0]
    assert (flat.sub_x, flat.sub_y) == ("c", "b")


def test_filtered_sinks_drop_the_all_null_row(spark):
    rows = spark.createDataFrame([(1, None, None, 1, "upsert"), (2, "x", None, 1, "upsert")], SCHEMA)
    kept = upsert.only_present(rows, "a", ["b"])
    assert [r.id for r in kept.collect()] == [2] and "b" not in kept.columns


def test_update_matching_inserts_nothing(spark):
    docs = spark.sql("SELECT 1 AS id, named_struct('id', 'c1', 'name', 'old') AS customer")
    changes = spark.sql("SELECT * FROM VALUES ('c1', 'mid', 1), ('c1', 'new', 2), ('c9', 'none', 1) AS t(cid, name, v)")
    got = upsert.update_matching(docs, changes, "customer", "customer.id", "id", "cid", "v",
                                 F.struct(F.col("cid").alias("id"), "name")).collect()
    assert [(r.id, r.customer.name) for r in got] == [(1, "new")]


row = st.tuples(
    st.integers(1, 3), st.sampled_from([None, "p", "q"]), st.sampled_from([None, "r", "s"]), st.sampled_from(["upsert"] * 4 + ["delete"])
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=12), st.integers(0, 10**6), st.integers(1, 4))
def test_batches_may_be_split_and_reordered(spark, data, seed, parts):
    versioned = [(i, a, b, n, op) for n, (i, a, b, op) in enumerate(data)]
    whole = spark.createDataFrame(versioned, SCHEMA)
    want = _docs(partial.merge_fields(whole, "id", "version", FIELDS, "op"))
    mixed = versioned[:]
    random.Random(seed).shuffle(mixed)
    batches = [mixed[i::parts] for i in range(parts) if mixed[i::parts]]
    batches.append(batches[0])  # one batch is delivered twice
    merged = None
    for batch in batches:
        stamped = partial.stamp(spark.createDataFrame(batch, SCHEMA), "id", FIELDS, "version", "op")
        stamped = partial.merge_stamped(stamped, "id", FIELDS)
        merged = stamped if merged is None else partial.merge_stamped(merged.unionByName(stamped), "id", FIELDS)
    assert _docs(partial.unstamp(merged, "id", FIELDS)) == want


def test_stacked_legs_equal_separate_legs(spark):
    orders = shop.rows(spark, shop.ORDERS, shop.order(1, "p1", "A", 1), shop.order(2, "px", "A", 1))
    tables = {
        "customer": shop.rows(spark, shop.CUSTOMERS, shop.customer("A", "Ann", 1)),
        "product": shop.rows(spark, shop.PRODUCTS, shop.product("p1", "shoe", 1)),
    }
    dims = shop.STAR.dims
    legs = [partial.main_leg(orders, "order_id", ["ts"])]
    legs += [partial.dimension_leg(orders, tables[d.name], d, "order_id") for d in dims]
    wide = partial.wide_rows(orders, tables, dims, "order_id", ["ts"])
    stacked = partial.stacked_legs(wide, "order_id", [["ts"], ["customer"], ["product"]])
    separate = partial.union_legs(*legs).select(*stacked.columns)
    assert sorted(map(repr, stacked.collect())) == sorted(map(repr, separate.collect()))
