"""Streams keep on disk and in memory what they need, and no more: stored copies, bases, shuffles, held rows."""

import os

import pytest
from pyspark.sql import functions as F

from starweave.operators import changelog, skew, upsert
from starweave.plans import incremental
from starweave.plans.streams import followed
from starweave.sources import streams
from starweave.specs import TableSpec
from starweave.streaming.feed import ChangeFeed
from starweave.streaming.intervals import AsOfDocuments
from starweave.streaming.maintain import Maintainer
from starweave.streaming.pipeline import finish, subscribe
from starweave.streaming.sinks import FanOut, MergeSink
from tests import shop

FACTS = TableSpec("facts", "id", ("version",), op="op")
FACT = "id long, grp string, note string, at long, op string, version long"
DIMS = TableSpec("dims", "grp", ("version",))
DIM = "grp string, name string, at long, version long"


@pytest.fixture(autouse=True)
def quick_plans(spark):
    """A few rows per batch: compiling each plan would take longer than running it."""
    before = spark.conf.get("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", before)


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def held(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_copies_of_a_log_go_as_they_are_processed(spark, tmp_path):
    sources, schemas = followed(str(tmp_path), {"rows": spark.range(100).selectExpr("id", "id % 7 AS grp")})
    seen, left = [], []

    def handle(rows, n):
        seen.extend(r.id for r in rows.collect())
        left.append(len([f for f in os.listdir(tmp_path / "source/rows") if f.endswith(".parquet")]))

    finish(subscribe(sources["rows"], handle, str(tmp_path / "check")))
    assert sorted(seen) == list(range(100)) and schemas["rows"].names == ["id", "grp"]
    remaining = len([f for f in os.listdir(tmp_path / "source/rows") if f.endswith(".parquet")])
    assert len(left) > 1 and min(*left, remaining) < left[0]


def test_a_new_base_replaces_what_it_covers(spark, tmp_path):
    schema, dims = (spark.createDataFrame([], s).schema for s in (FACT, DIM))
    docs = AsOfDocuments(
        spark, FACTS, "grp", "at", DIMS, "at", ["name"], "was", str(tmp_path), schema, dims, compact_every=2, buckets=2, settled=True
    )

    def send(n, some=(), more=()):
        docs(streams.tagged({"facts": spark.createDataFrame(list(some), FACT), "dims": spark.createDataFrame(list(more), DIM)}), n)
        return {r.id: r.was and r.was.name for r in docs.documents().collect()}

    send(0, [(1, "a", "", 5, "upsert", 0), (None, "a", "", 5, "upsert", 0)], [("a", "first", 0, 0)])
    second = [(2, "a", "", 1, "upsert", 0), (3, None, "", 1, "upsert", 0)]
    assert send(1, second, [("a", "late", 4, 1)]) == {1: "late", 2: "first", 3: None}
    for log in (docs.log, docs.output, docs.intervals):
        assert log.batches() == [] and log.commits() == [] and log.base() == (1, 2) and log.holds(1) and not log.holds(2)
    assert send(1, second, [("a", "late", 4, 1)]) == {1: "late", 2: "first", 3: None}  # replayed behind its compaction
    assert docs.output.batches() == []
    send(2, [(1, "a", "", 2, "upsert", 1)])
    assert send(3, [(2, "a", "", 1, "delete", 1)], [("a", "later", 2, 2)]) == {1: "later", 3: None}
    assert [log._bases() for log in (docs.log, docs.output)] == [[(3, 2)]] * 2
    assert os.listdir(tmp_path / "facts/index-grp") == ["upto=3,buckets=2"]


def test_working_tables_go_before_the_output_is_written(spark, tmp_path, monkeypatch):
    schema, dims = (spark.createDataFrame([], s).schema for s in (FACT, DIM))
    docs = AsOfDocuments(spark, FACTS, "grp", "at", DIMS, "at", ["name"], "was", str(tmp_path), schema, dims)
    write, seen = type(docs.output).write, {}

    def watched(log, rows, batch_id):
        if log is docs.output:
            seen.update({n: os.listdir(tmp_path / f"facts/work-{n}/log") for n in ("candidates", "current", "touched")})
        write(log, rows, batch_id)

    monkeypatch.setattr(type(docs.output), "write", watched)
    facts = spark.createDataFrame([(1, "a", "", 5, "upsert", 0)], FACT)
    docs(streams.tagged({"facts": facts, "dims": spark.createDataFrame([("a", "first", 0, 0)], DIM)}), 0)
    assert seen == {"candidates": [], "current": [], "touched": ["batch_id=0"]}
    assert [r.was.name for r in docs.documents().collect()] == ["first"]


@pytest.mark.parametrize("policy", [skew.DEFAULT, skew.SkewPolicy(parts=8, min_rows=2, one_task_bytes=0)])
def test_a_feed_shuffles_its_history_once(spark, tmp_path, shuffled_joins, policy):
    schema = spark.createDataFrame([], FACT).schema
    feed = ChangeFeed(spark, FACTS, str(tmp_path), schema, ["grp"], buckets=2, policy=policy, compact_every=3, settled=True)
    rows = [(1 if n % 3 else n, "abc"[n % 3], f"n{n}", n, "delete" if n % 5 == 0 else "upsert", n * 7 % 60) for n in range(60)]
    seen = []
    for n, start in enumerate(range(0, 60, 15)):
        part = rows[start : start + 15]
        again = [(i, "zzz", "again", at, op, v) for i, _, _, at, op, v in seen[::2]]  # known versions say nothing new
        feed(spark.createDataFrame([*part, *again], FACT), n)
        seen += part
        want = changelog.to_changelog(spark.createDataFrame(seen, FACT), "id", "version", ["grp"], "op")
        got = [sorted(map(str, df.select("id", "version", "change", "old", "new").collect())) for df in (feed.changes(), want)]
        assert got[0] == got[1]
    assert feed.versions.batches() == [3] and feed.output.base() == (2, 2)
    if policy is skew.DEFAULT:
        plan = feed._emitted(3)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def partial_keep(spark, tmp_path):
    keep = Maintainer(spark, shop.STAR, str(tmp_path / "state"), shop.SCHEMAS, mode="partial", buckets=2)
    keep(streams.tagged({"customers": shop.rows(spark, shop.CUSTOMERS, shop.customer("A", "Ann", 1))}), 0)
    keep(streams.tagged({"products": shop.rows(spark, shop.PRODUCTS, shop.product("p1", "shoe", 1))}), 1)
    return keep


def test_partial_rows_of_facts_alone(spark, tmp_path, shuffled_joins, monkeypatch):
    keep = partial_keep(spark, tmp_path)
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *a, **k: pytest.fail("the batch was kept"))
    orders = [shop.order(1, "p1", "A", 1), shop.order(1, "p1", "A", 1), shop.order(1, "p9", None, 2), shop.order(2, None, None, 1, "delete")]
    keep(streams.tagged({"orders": shop.rows(spark, shop.ORDERS, *orders)}), 2)
    got = [(r.order_id, r.version, r.ts is not None, r.customer and r.customer.first_name, r.product and r.product.name, r.op)
           for r in keep.output.read_batch(2).collect()]
    none, up = (False, None, None, "upsert"), "upsert"
    want = [(1, 1, True, None, None, up), (1, 1, False, "Ann", None, up), (1, 1, False, None, "shoe", up),
            (1, 2, True, None, None, up), (1, 2, *none), (1, 2, *none), (2, 1, False, None, None, "delete")]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert keep.inputs["orders"].read_batch(2).count() == 3  # a version that came twice is stored once
    rows = keep._partial(None, keep.inputs["orders"].read_batch(2), 2)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2 and plan.count("Generate explode") == 1  # legs lie together
    monkeypatch.undo()
    keep(streams.tagged({"orders": shop.rows(spark, shop.ORDERS)}), 3)
    assert keep.output.read_batch(3).count() == 0


def test_merge_sink_settles_its_documents(spark, tmp_path):
    keep = partial_keep(spark, tmp_path)
    sink = MergeSink(
        spark, str(tmp_path / "store"), "order_id", ["ts", "customer", "product"], ["version"], keep.output.schema,
        compact_every=2, buckets=2, settled=True,
    )
    for n, order in enumerate([shop.order(1, "p1", None, 1), shop.order(1, None, "A", 2), shop.order(None, None, "A", 2)]):
        keep(streams.tagged({"orders": shop.rows(spark, shop.ORDERS, order)}), n + 2)
        sink(keep.output.read_batches([n + 2]), n)
    sink(keep.output.read_batches([3]), 1)  # replayed behind its compaction
    assert sink.docs.batches() == [2] and sink.docs.base() == (1, 2)
    [doc] = sink.documents().collect()
    assert (doc.order_id, doc.customer.first_name, doc.product.name) == (1, "Ann", "shoe")


def test_fan_out_holds_nothing_in_memory(spark, tmp_path):
    keep = partial_keep(spark, tmp_path)
    keep(streams.tagged({"orders": shop.rows(spark, shop.ORDERS, shop.order(1, "p1", "A", 1), shop.order(2, None, None, 1, "delete"))}), 2)
    before, during, got = held(spark), [], {}

    def sink(name):
        def run(rows, n):
            during.append(held(spark))
            got[name] = sorted((r.order_id, r.op) for r in rows.collect())
        return run

    legs = [(lambda rows, f=f: upsert.only_present(rows, f, [], "op"), sink(f)) for f in ("ts", "customer")]
    FanOut(legs)(keep.output.read_batches([0, 1, 2]), 0)
    assert during == [before, before]
    assert got == dict.fromkeys(("ts", "customer"), [(1, "upsert"), (2, "delete")])


def test_line_ids_are_made_when_lines_are_read(spark, tmp_path, monkeypatch):
    stored = {}

    def watched(root, logs, *more):
        stored.update({n: rows.columns for n, rows in logs.items()})
        return followed(root, logs, *more)

    monkeypatch.setattr(incremental, "followed", watched)
    lines = [(o, o * 3, 4, n, 1.0, 5.0, 0.0, 0.0, "N", "O", shop.TS) for o in range(5) for n in range(3)]
    for name, rows, schema in (
        ("lineitem", lines, "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
        ("orders", [(o, o % 2, "O", 1.0, shop.TS, "1") for o in range(5)], "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
        ("customer", [(0, "zero", 1, 7.0, "X")], "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
        ("events", [], "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    got = incremental.stream_asof_converged(spark, str(tmp_path)).groupBy("customer_id").agg(F.count("*").alias("n"), F.max("acctbal_at_ts").alias("at"))
    assert sorted(map(tuple, got.collect())) == [("0", 9, 7.0), ("1", 6, None)]
    assert stored["lines"] == ["order_id", "customer_id", "ts", "product_id", "version"]
