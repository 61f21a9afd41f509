from pyspark.sql import functions as F

from starweave.operators import changelog
from tests import shop


def _orders(spark, *data):
    return shop.rows(spark, shop.ORDERS, *data)


def test_latest_ignores_arrival_order(spark):
    log = _orders(spark, shop.order(1, "p2", "c1", 2), shop.order(1, "p1", "c1", 1))
    assert [r.product_id for r in changelog.latest_by_key(log, "order_id", "version").collect()] == ["p2"]


def test_delete_hides_the_older_value(spark):
    log = _orders(spark, shop.order(1, "p1", "c1", 1), shop.order(1, None, None, 2, "delete"),
                  shop.order(2, "p1", "c1", 1))
    assert [r.order_id for r in changelog.table(log, shop.ORDERS).collect()] == [2]


def test_value_after_delete_comes_back(spark):
    log = _orders(spark, shop.order(1, None, None, 1, "delete"), shop.order(1, "p3", "c1", 2))
    assert [r.product_id for r in changelog.table(log, shop.ORDERS).collect()] == ["p3"]


def test_moved_order_leaves_its_old_group(spark):
    log = _orders(spark, shop.order(1, "p1", "A", 1), shop.order(1, "p1", "B", 2), shop.order(2, "p1", "A", 1))
    groups = changelog.latest_per_group(changelog.table(log, shop.ORDERS), "customer_id", ["version", "order_id"])
    assert {(r.customer_id, r.order_id) for r in groups.collect()} == {("A", 2), ("B", 1)}


def test_changelog_of_a_table(spark):
    log = _orders(
        spark,
        shop.order(1, "p0", "c1", 0, "delete"),  # deletes nothing
        shop.order(1, "p1", "c1", 1),
        shop.order(1, "p2", "c1", 2),
        shop.order(1, None, None, 3, "delete"),
        shop.order(1, None, None, 4, "delete"),  # nothing left to delete
        shop.order(1, "p5", "c1", 5),
    )
    changes = changelog.to_changelog(log, "order_id", "version", ["product_id"], "op").orderBy("version").collect()
    seen = [(r.version, r.change, r.old and r.old.product_id, r.new and r.new.product_id) for r in changes]
    assert seen == [
        (1, "insert", None, "p1"), (2, "update", "p1", "p2"), (3, "delete", "p2", None), (5, "insert", None, "p5"),
    ]


def test_key_switches(spark):
    log = _orders(spark, shop.order(1, "p1", "c1", 1), shop.order(1, "p1", "c1", 2), shop.order(1, "p2", "c1", 3))
    assert [tuple(r) for r in changelog.key_switches(log, "order_id", "product_id", "version").collect()] == [
        (1, "p1", "p2")
    ]


def test_hot_key_is_cut_to_one_row_before_the_shuffle(spark):
    log = _orders(spark, *[shop.order(1, f"p{i}", "c", i) for i in range(50)])
    plan = changelog.latest_by_key(log, "order_id", "version")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_struct_versions_compare_field_by_field(spark):
    log = _orders(spark, shop.order(1, "p1", "c", 1), shop.order(1, "p2", "c", 2)).withColumn(
        "v", F.struct(F.lit(0).alias("a"), F.col("version").alias("b"))
    )
    assert [r.product_id for r in changelog.latest_by_key(log, "order_id", "v").collect()] == ["p2"]
