"""Heavy keys: the split forms give the rows of the plain forms."""

import pytest
from pyspark.sql import functions as F

from starweave.operators import asof, changelog, enrich, skew
from starweave.sources import tables as t
from tests.compare import difference

SF = "/root/testdata/sf0.001"
TINY = skew.SkewPolicy(parts=16, min_rows=20, one_task_bytes=0)


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture(scope="module")
def lines(spark):
    """Every third row belongs to one order, as do a few rows without any."""
    raw = t.order_lines(t.read(spark, SF, "lineitem"))
    spread = F.xxhash64("version") % 3
    key = F.when(spread == 0, F.lit(7).cast("long")).when(
        F.col("order_id") > 1450, F.lit(None).cast("long")
    ).otherwise(F.col("order_id"))
    return raw.withColumn("order_id", key).withColumn("uid", F.xxhash64("version", "order_id")).cache()


def test_heavy_keys_are_found(spark, lines):
    heavy = skew.heavy_keys(lines, "order_id", ["uid"], skew.SkewPolicy(16, 64, 0)).collect()
    assert [r["__heavy"] for r in heavy] == [7]
    assert 2 <= heavy[0]["__salts"] <= 12


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join(spark, lines, how, no_broadcast):
    right = lines.select(F.col("order_id").alias("k")).where("k % 2 = 1").distinct().withColumn(
        "extra", F.col("k") * 10
    )
    plain = lines.join(right, F.col("order_id") == F.col("k"), how)
    salted = skew.lookup_join(lines, right, "order_id", "k", how, ["uid"], TINY)
    text = salted._jdf.queryExecution().toString()
    assert "__salt" in text
    drop = ["version"]
    assert difference(salted.drop(*drop).toPandas(), plain.drop(*drop).toPandas()) is None


def test_salted_join_spreads_the_heavy_key(spark, lines, no_broadcast):
    right = lines.select(F.col("order_id").alias("k")).distinct()
    salted = skew.lookup_join(lines, right, "order_id", "k", "left", ["uid"], TINY)
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = salted.withColumn("task", F.spark_partition_id()).where("order_id = 7")
        assert tasks.select("task").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_small_lookup_is_broadcast(spark, lines):
    right = t.read(spark, SF, "part").select(F.col("p_partkey").alias("k"))
    joined = skew.lookup_join(lines, right, "order_id", "k", "left", ["uid"], TINY)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_previous_version_across_segments(spark, lines):
    rows = lines.where("order_id IS NOT NULL")
    plain = changelog.with_previous(rows, "order_id", "version", ["product_id", "line"], None)
    split = changelog.with_previous(rows, "order_id", "version", ["product_id", "line"], TINY)
    show = ["order_id", "uid", "prev.product_id", "prev.line"]
    assert difference(split.select(*show).toPandas(), plain.select(*show).toPandas()) is None


def test_segments_cut_the_heavy_key(spark, lines):
    located = lines.withColumn("pos", F.struct("ts", "line"))
    drawn = skew.draw(located, ["uid"], skew.rows_per_share([located], TINY))
    points = skew.split_points(drawn, "order_id", F.col("pos"))
    cut = skew.with_segments(located, "order_id", F.col("pos"), points)
    sizes = [r["count"] for r in cut.where("order_id = 7").groupBy("__seg").count().collect()]
    assert len(sizes) > 5 and max(sizes) < sum(sizes) / 3
    # Segments follow the order.
    spans = cut.where("order_id = 7").groupBy("__seg").agg(F.min("pos"), F.max("pos")).orderBy("__seg").collect()
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("tied", [False, True])
def test_asof_across_segments(spark, tied):
    """One customer has a third of the facts and of the versions; with ``tied``
    most of the facts share one instant."""
    orders = t.order_log(spark, SF).withColumn("id", F.xxhash64("order_id", "version"))
    hot = F.col("id") % 3 == 0
    orders = orders.withColumn(
        "customer_id", F.when(hot, "9").when(F.col("id") % 17 == 0, None).otherwise(F.col("customer_id"))
    )
    if tied:
        orders = orders.withColumn(
            "ts", F.when(hot & (F.col("id") % 2 == 0), F.expr("TIMESTAMP_NTZ '1999-01-15'")).otherwise(F.col("ts"))
        )
    log = t.customer_log(spark, SF)
    log = log.withColumn("customer_id", F.when(F.col("version.seq") % 3 == 0, "9").otherwise(F.col("customer_id")))
    args = ("customer_id", "ts", "customer_id", "ts", ["version"], ["acctbal", "name"], "then", ["id"])
    plain = asof.asof_lookup(orders, log, *args, policy=None)
    split = asof.asof_lookup(orders, log, *args, policy=TINY)
    show = ["id", "customer_id", "ts", "then.acctbal", "then.name"]
    assert difference(split.select(*show).toPandas(), plain.select(*show).toPandas()) is None


def test_star_join_without_broadcast(spark, no_broadcast):
    orders = t.orders_latest(spark, SF)
    skewed = orders.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, "9").otherwise(F.col("customer_id")))
    tables = {"customer": t.customer_dim(spark, SF), "product": t.product_dim(spark, SF)}
    plain = enrich.star_join(skewed, tables, t.STAR, policy=None)
    salted = enrich.star_join(skewed, tables, t.STAR, policy=TINY, samples={"customer": lambda: skewed})
    show = ["order_id", "customer.*", "product.brand", "ts"]
    assert difference(salted.select(*show).toPandas(), plain.select(*show).toPandas()) is None


@pytest.mark.parametrize(
    "name",
    ["enrich_orders_left", "stream_table_left_asof", "table_to_changelog", "update_many_dimension",
     "partial_merge_converged", "affected_orders", "stream_static_lookup"],
)
def test_queries_without_small_inputs(spark, no_broadcast, monkeypatch, name):
    """The registered queries take the large-data paths and still match."""
    import __spark_entry__ as contract
    from tests.compare import oracle

    forced = skew.SkewPolicy(parts=16, min_rows=20, one_task_bytes=0)
    for fn in (skew.lookup_join, skew.salted_join, changelog.with_previous, changelog.to_changelog,
               changelog.key_switches, asof.asof_lookup, enrich.lookup, enrich.star_join,
               enrich.affected_facts):
        if fn.__defaults__:
            monkeypatch.setattr(
                fn, "__defaults__", tuple(forced if d == skew.DEFAULT else d for d in fn.__defaults__)
            )
    monkeypatch.setattr(skew, "DEFAULT", forced)
    got = contract.queries()[name](spark, SF).toPandas()
    assert difference(got, oracle(contract.oracle_sql()[name], SF)) is None
