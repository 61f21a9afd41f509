import uuid

import pytest
from pyspark.sql import functions as F

from starweave.operators import changelog, enrich, upsert
from starweave.operators import transforms as tr
from starweave.sources import files, streams
from starweave.sources.logs import BATCH, LogTable
from starweave.streaming.maintain import Maintainer
from starweave.streaming.pipeline import Pipeline, finish, subscribe
from starweave.streaming.sinks import FanOut, MergeSink, ReplaceSink, UpdateMatching
from tests import shop

SPECS = {s.name: s for s in shop.STAR.tables()}


class Feeds:
    """Source folders of the three changelogs; each ``add`` is one more file."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.sent = {n: [] for n in SPECS}
        for n in SPECS:
            files.make_directory(spark, f"{self.root}/{n}")

    def add(self, **tables):
        for name, data in tables.items():
            self.sent[name] += data
            rows = shop.rows(self.spark, SPECS[name], *data).coalesce(1)
            rows.write.mode("append").parquet(f"{self.root}/{name}")

    def stream(self, max_files=None):
        return streams.tagged(
            {n: streams.parquet_stream(self.spark, f"{self.root}/{n}", s.schema, max_files) for n, s in SPECS.items()}
        )

    def log(self, name):
        return shop.rows(self.spark, SPECS[name], *self.sent[name])


@pytest.fixture(autouse=True)
def quick_plans(spark):
    """A few rows per batch: compiling each plan would take longer than running it."""
    changes = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def feeds(spark, tmp_path):
    return Feeds(spark, tmp_path / "feeds")


@pytest.fixture
def pipe(tmp_path):
    return Pipeline.open(str(tmp_path / "run"))


def maintainer(spark, pipe, **options):
    return Maintainer(spark, shop.STAR, pipe.path("state"), shop.SCHEMAS, **{"buckets": 3, **options})


def names(docs):
    return {
        r.order_id: (r.customer and r.customer.first_name, r.product and r.product.name) for r in docs.collect()
    }


def recomputed(feeds):
    """The same documents from scratch, in batch."""
    tables = {d.name: changelog.table(feeds.log(d.table.name), d.table) for d in shop.STAR.dims}
    return enrich.star_join(changelog.table(feeds.log("orders"), shop.ORDERS), tables, shop.STAR)


def test_documents_follow_changes_on_every_side(spark, feeds, pipe):
    keep = maintainer(spark, pipe, compact_every=3)

    def step(**tables):
        feeds.add(**tables)
        finish(pipe.run(feeds.stream(), keep, "keep"))
        got = names(keep.documents())
        assert got == names(recomputed(feeds))
        return got

    assert step(orders=[shop.order(1, "p1", "A", 1), shop.order(2, "p1", "B", 1)]) == {1: ("", ""), 2: ("", "")}
    # A late dimension row reaches every order that references it.
    late = step(customers=[shop.customer("A", "Ann", 1)], products=[shop.product("p1", "shoe", 1)])
    assert late == {1: ("Ann", "shoe"), 2: ("", "shoe")}
    # A dimension change, and an order that moves to another customer.
    assert step(customers=[shop.customer("B", "Bob", 1), shop.customer("A", "Anna", 2)],
                orders=[shop.order(2, "p2", "A", 2)]) == {1: ("Anna", "shoe"), 2: ("Anna", "")}
    # An older version that arrives later, a dimension delete; the logs are now compacted.
    assert keep.output.base()[0] == 2 and keep.inputs['orders'].base()[0] == 2
    assert step(orders=[shop.order(2, "p1", "B", 1)], customers=[shop.customer("A", None, 3, "delete")]) == {
        1: ("", "shoe"), 2: ("", "")}
    # A deleted order goes, and comes back.
    assert step(orders=[shop.order(1, None, None, 5, "delete")]) == {2: ("", "")}
    assert step(orders=[shop.order(1, "p1", "B", 6)]) == {1: ("Bob", "shoe"), 2: ("", "")}


def test_dropped_documents_leave_when_a_reference_goes(spark, tmp_path, feeds, pipe):
    from dataclasses import replace

    star = replace(shop.STAR, dims=tuple(replace(d, on_miss="drop") for d in shop.STAR.dims))
    keep = Maintainer(spark, star, pipe.path("state"), shop.SCHEMAS)
    feeds.add(orders=[shop.order(1, "p1", "A", 1)], customers=[shop.customer("A", "Ann", 1)], products=[shop.product("p1", "x", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    assert names(keep.documents()) == {1: ("Ann", "x")}
    feeds.add(customers=[shop.customer("A", None, 2, "delete")])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    assert names(keep.documents()) == {}


def test_partial_documents_keep_what_was_known(spark, feeds, pipe):
    keep = maintainer(spark, pipe, mode="partial")
    feeds.add(orders=[shop.order(1, "p1", "A", 1), shop.order(1, "px", "A", 2)], products=[shop.product("p1", "shoe", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    # The switch to an unknown product cannot unset the known one.
    assert names(keep.documents()) == {1: (None, "shoe")}
    feeds.add(customers=[shop.customer("A", "Ann", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    assert names(keep.documents()) == {1: ("Ann", "shoe")}
    feeds.add(customers=[shop.customer("A", None, 2, "delete")], orders=[shop.order(2, "p1", "A", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    assert names(keep.documents()) == {1: ("Ann", "shoe"), 2: (None, "shoe")}
    feeds.add(orders=[shop.order(1, None, None, 3, "delete")])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    assert names(keep.documents()) == {2: (None, "shoe")}


def test_replays_and_half_written_batches(spark, feeds, pipe):
    keep = maintainer(spark, pipe)
    feeds.add(orders=[shop.order(1, "p1", "A", 1)])
    batch = streams.tagged({n: feeds.log(n) for n in SPECS})
    keep(batch, 0)
    before = keep.output.read().collect()
    keep(batch, 0)
    assert keep.output.read().collect() == before
    # Batch 1 dies after its inputs are stored and leaves half an output behind.
    feeds.add(customers=[shop.customer("A", "Ann", 1)])
    second = streams.tagged({n: (feeds.log(n) if n == "customers" else feeds.log(n).limit(0)) for n in SPECS})
    keep._append_inputs(second, 1)
    half = f"{keep.output.log_path}/{BATCH}=1"
    keep.output.read_batch(0).drop(BATCH).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert not keep.output.committed(1)
    keep(second, 1)
    assert keep.output.read_batch(1).count() == 1
    assert names(keep.documents()) == {1: ("Ann", "")}


def test_sink_resumes_where_it_stopped(spark, feeds, pipe):
    """The sink's store is down for a while; computing goes on regardless."""
    keep = maintainer(spark, pipe)
    sink = ReplaceSink(spark, pipe.path("store"), "order_id", keep.output.schema)
    up = {"now": True}

    def store(rows, batch_id):
        if not up["now"]:
            raise RuntimeError("store is down")
        sink(rows, batch_id)

    def compute(**tables):
        feeds.add(**tables)
        finish(pipe.run(feeds.stream(), keep, "keep"))

    compute(orders=[shop.order(1, "p1", "A", 1)])
    finish(pipe.run(keep.output.stream(), store, "sink"))
    assert names(sink.documents()) == {1: ("", "")}
    up["now"] = False
    compute(customers=[shop.customer("A", "Ann", 1)])
    with pytest.raises(Exception, match="store is down"):
        finish(pipe.run(keep.output.stream(), store, "sink"))
    compute(orders=[shop.order(1, None, None, 2, "delete"), shop.order(3, "p1", "A", 1)])
    assert names(keep.documents()) == {3: ("Ann", "")}
    up["now"] = True
    finish(pipe.run(keep.output.stream(), store, "sink"))
    assert names(sink.documents()) == {3: ("Ann", "")}
    sink.compact(2)
    assert names(sink.documents()) == {3: ("Ann", "")}


def pushes(spark, pipe):
    """A maintained star whose documents know their versions, its sink, and two jobs that push changes."""
    keep = maintainer(spark, pipe, versions=True, refresh="none")
    sink = ReplaceSink(spark, pipe.path("store"), "order_id", keep.output.schema)
    people = UpdateMatching(
        sink, "customer", "customer.id", "id", ["version"], F.struct(*shop.CUSTOMERS.schema.names[:10]),
        shop.CUSTOMERS.schema, "op", F.col("customer_version"), compact_every=2,
    )
    goods = UpdateMatching(
        sink, "product", "product.id", "id", ["version"], F.struct(*shop.PRODUCTS.schema.names[:5]),
        shop.PRODUCTS.schema, held=F.col("product_version"),
    )
    return keep, sink, people, goods


def people_rows(spark, *rows):
    return shop.rows(spark, shop.CUSTOMERS, *rows)


def test_updates_are_pushed_into_stored_documents(spark, feeds, pipe, tmp_path):
    keep, sink, people, goods = pushes(spark, pipe)
    feeds.add(orders=[shop.order(1, "p1", "A", 1), shop.order(2, "p1", "B", 1)], customers=[shop.customer("A", "Ann", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    finish(pipe.run(keep.output.stream(), sink, "sink"))
    people(people_rows(spark, shop.customer("A", "Anna", 2), shop.customer("Z", "Zed", 1)), 0)
    goods(shop.rows(spark, shop.PRODUCTS, shop.product("p1", "boot", 2)), 0)
    assert names(sink.documents()) == {1: ("Anna", "boot"), 2: ("", "boot")}
    # A replacement made from an older customer does not undo the newer one.
    feeds.add(orders=[shop.order(1, "p1", "A", 2)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    finish(pipe.run(keep.output.stream(), sink, "sink"))
    assert names(sink.documents()) == {1: ("Anna", "boot"), 2: ("", "boot")}


def test_pushed_updates_follow_versions(spark, feeds, pipe):
    keep, sink, people, _ = pushes(spark, pipe)
    # A change that is handled before its document is stored is not lost.
    people(people_rows(spark, shop.customer("B", "Bea", 7)), 0)
    feeds.add(orders=[shop.order(1, "p1", "A", 1), shop.order(2, "p1", "B", 1)], customers=[shop.customer("A", "v3", 3)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    finish(pipe.run(keep.output.stream(), sink, "sink"))
    assert names(sink.documents()) == {1: ("v3", ""), 2: ("Bea", "")}
    people(people_rows(spark, shop.customer("A", "v2", 2)), 1)  # lags behind what the document holds
    assert names(sink.documents())[1] == ("v3", "")
    people(people_rows(spark, shop.customer("A", "v5", 5)), 2)
    people(people_rows(spark, shop.customer("A", "v4", 4)), 3)  # older, in a later batch
    assert names(sink.documents())[1] == ("v5", "")
    people(people_rows(spark, shop.customer("A", None, 6, "delete")), 4)  # changes no document
    assert names(sink.documents())[1] == ("v3", "")
    assert people.log.base() is not None


def test_deletes_reach_every_filtered_sink(spark, feeds, pipe):
    keep = maintainer(spark, pipe, mode="partial")
    feeds.add(orders=[shop.order(1, "p1", "A", 1)], customers=[shop.customer("A", "Ann", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    sink = MergeSink(spark, pipe.path("ts"), "order_id", ["ts"], ["version"], keep.output.schema, compact_every=1)
    out = FanOut([(lambda rows: upsert.only_present(rows, "ts", ["product", "customer"], "op"), sink)])
    finish(pipe.run(keep.output.stream(), out, "ts"))
    assert sink.documents().count() == 1
    feeds.add(orders=[shop.order(1, None, None, 2, "delete")])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    finish(pipe.run(keep.output.stream(), out, "ts"))
    assert sink.documents().count() == 0


def test_old_files_are_read(spark, feeds):
    import os

    feeds.add(customers=[shop.customer("A", "Ann", 1)])
    feeds.add(customers=[shop.customer("B", "Bob", 1)])
    folder = f"{feeds.root}/customers"
    old = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[0]
    os.utime(f"{folder}/{old}", (1, 1))
    seen = []
    source = streams.parquet_stream(spark, folder, shop.CUSTOMERS.schema)
    finish(subscribe(source, lambda rows, n: seen.extend(r.id for r in rows.collect()), f"{feeds.root}/check"))
    assert sorted(seen) == ["A", "B"]


def test_half_written_batches_are_invisible_and_logs_stay_short(spark, tmp_path):
    log = LogTable(spark, str(tmp_path / "log"), shop.PRODUCTS.schema, "id", 2)
    log.write(shop.rows(spark, shop.PRODUCTS, shop.product("p", "a", 1)), 0)
    half = shop.rows(spark, shop.PRODUCTS, shop.product("q", "b", 1))
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{log.log_path}/{BATCH}=1")
    assert {r.id for r in log.read().collect()} == {"p"}
    log.write(half, 1)
    assert {r.id for r in log.read().collect()} == {"p", "q"}
    log.trim(1)
    assert log.batches() == [0, 1]  # nothing covers them yet
    log.compact(0, lambda rows: rows)
    log.trim(5)
    assert log.batches() == [1] and log.read().count() == 2


def test_one_table_behind_two_references(spark, feeds, pipe):
    from dataclasses import replace

    customer, product = shop.STAR.dims
    both = replace(shop.STAR, dims=(customer, replace(customer, name="other", fk="product_id")))
    keep = Maintainer(spark, both, pipe.path("state"), shop.SCHEMAS, buckets=2, compact_every=2)
    assert [s.name for s in both.tables()] == ["orders", "customers"]
    source = streams.tagged({n: streams.parquet_stream(spark, f"{feeds.root}/{n}", SPECS[n].schema) for n in ("orders", "customers")})
    feeds.add(orders=[shop.order(1, "B", "A", 1)], customers=[shop.customer("A", "Ann", 1), shop.customer("B", "Bob", 1)])
    finish(pipe.run(source, keep, "keep"))
    feeds.add(customers=[shop.customer("B", "Bert", 2)])
    finish(pipe.run(source, keep, "keep"))
    got = keep.documents().collect()
    assert [(r.customer.first_name, r.other.first_name) for r in got] == [("Ann", "Bert")]
    with pytest.raises(ValueError, match="two different tables"):
        replace(shop.STAR, dims=(customer, replace(product, table=replace(product.table, name="customers")))).tables()


def test_partial_log_into_one_sink_and_into_three(spark, feeds, pipe):
    keep = maintainer(spark, pipe, mode="partial")
    fields = ["ts", "product", "customer"]

    def merge(part):
        return MergeSink(spark, pipe.path(part), "order_id", fields, ["version"], keep.output.schema)

    one, three = merge("one"), merge("three")
    feeds.add(orders=[shop.order(1, "p1", "A", 1), shop.order(2, "px", "B", 1, ts=None)],
              customers=[shop.customer("A", "Ann", 1)], products=[shop.product("p1", "shoe", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    feeds.add(customers=[shop.customer("A", "Anna", 2)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    finish(pipe.run(keep.output.stream(max_files=1), one, "one"))

    # Three filtered sinks of one log, each in charge of one field.
    legs = []
    for f in fields:
        others = [o for o in fields if o != f]
        sink = MergeSink(spark, pipe.path(f"three-{f}"), "order_id", [f], ["version"], keep.output.schema)
        legs.append((lambda rows, f=f, o=others: upsert.only_present(rows, f, o), sink))
    finish(pipe.run(keep.output.stream(), FanOut(legs), "three"))

    whole = names(one.documents())
    assert whole == {1: ("Anna", "shoe"), 2: (None, None)}
    # An order without any field is stored by the single sink only.
    seen = [{r.order_id for r in sink.documents().collect()} for _, sink in legs]
    assert seen == [{1}, {1}, {1}]
    one.compact(0) if one.docs.committed(0) else None
    assert names(one.documents()) == whole


def test_named_view_tap_and_rebuild(spark, feeds, pipe, tmp_path):
    tapped = []
    keep = maintainer(spark, pipe, tap=lambda rows, n: tapped.append((n, rows.count())))
    feeds.add(orders=[shop.order(1, "p1", "A", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    keep.register("orders_now")
    assert spark.sql("SELECT order_id FROM orders_now").collect()[0][0] == 1
    assert tapped == [(0, 1)]
    again = Pipeline.open(pipe.root, rebuild=True)
    assert again.path("state") != pipe.path("state")
    fresh = maintainer(spark, again)
    feeds.add(orders=[shop.order(2, "p1", "A", 1)])
    finish(again.run(feeds.stream(max_files=1), fresh, "keep"))
    assert set(names(fresh.documents())) == {1, 2}
    assert set(names(keep.documents())) == {1}  # the old run is left alone


def test_file_by_file_equals_all_at_once(spark, feeds, pipe):
    people = [shop.customer(c, f"{c}{v}", v) for v in (1, 2, 3) for c in "ABC"]
    goods = [shop.product(p, f"{p}-{v}", v) for v in (1, 2) for p in ("p1", "p2")]
    orders = [shop.order(i, f"p{i % 3}", "ABCD"[i % 4], v) for v in (1, 2) for i in range(8)]
    for n in range(3):
        feeds.add(customers=people[n::3], products=goods[n::3], orders=orders[2 - n :: 3])
    keep = maintainer(spark, pipe, compact_every=2)
    finish(pipe.run(feeds.stream(max_files=1), keep, "keep"))
    assert keep.output.committed(2)
    assert names(keep.documents()) == names(recomputed(feeds))


def test_steps_run_before_the_handler(spark, feeds, tmp_path):
    feeds.add(orders=[shop.order(1, "p1", "A", 1), shop.order(2, None, "A", 1)])
    seen = []
    source = streams.parquet_stream(spark, f"{feeds.root}/orders", shop.ORDERS.schema)
    query = subscribe(
        tr.as_records(source), lambda rows, n: seen.extend(r.key._id for r in rows.collect()), str(tmp_path / "c"),
        steps=[tr.keep_present("product_id"), tr.value_to_key(["order_id"]), tr.rename_key({"order_id": "_id"})],
    )
    finish(query)
    assert seen == [1]


def test_log_reads_as_of_a_batch(spark, tmp_path):
    schema = shop.versioned(shop.PRODUCT)
    log = LogTable(spark, str(tmp_path / uuid.uuid4().hex), schema)
    for n in range(3):
        log.write(shop.rows(spark, shop.PRODUCTS, shop.product("p", f"v{n}", n)), n)
    assert {r.name for r in log.read(1).collect()} == {"v0", "v1"}
    log.compact(1, lambda rows: changelog.latest_by_key(rows, "id", ["version", BATCH]))
    assert {(r.name, r[BATCH]) for r in log.read().collect()} == {("v1", 1), ("v2", 2)}
    with pytest.raises(ValueError, match="compacted"):
        log.read(0)


def test_compacted_log_opens_only_the_directories_it_needs(spark, tmp_path):
    log = LogTable(spark, str(tmp_path / "log"), shop.ORDERS.schema, "order_id", 8, ("customer_id",))
    keep = lambda rows: changelog.latest_by_key(rows, "order_id", ["version", BATCH])
    data = [shop.order(i, "p", f"c{i % 5}", 1) for i in range(40)]
    log.write(shop.rows(spark, shop.ORDERS, *data), 0)
    log.compact(0, keep)
    log.write(shop.rows(spark, shop.ORDERS, shop.order(41, "p", "c1", 1)), 1)
    near = spark.createDataFrame([(3,)], "order_id INT")
    found = log.read(near=near)
    assert 0 < found.count() < 41 and {3, 41} <= {r.order_id for r in found.collect()}
    by_fk = log.read_keys("customer_id", None, spark.createDataFrame([("c1",)], "customer_id STRING"))
    want = {i for i in range(40) if i % 5 == 1} | {41}
    assert {r.order_id for r in by_fk.where("customer_id = 'c1'").collect()} == want
    assert by_fk.count() < 41
    for n in (1, 2, 3):
        log.write(shop.rows(spark, shop.ORDERS, shop.order(50 + n, "p", "c9", 1)), n + 1)
        log.compact(n + 1, keep)
    log.vacuum(keep=2)
    assert len(log._bases()) == 2 and not log.committed(3) and log.committed(4)
    assert log.read().count() == 44


def test_index_may_be_missing(spark, tmp_path):
    log = LogTable(spark, str(tmp_path / "log"), shop.ORDERS.schema, "order_id", 4, ("customer_id",))
    log.write(shop.rows(spark, shop.ORDERS, shop.order(1, "p", "c1", 1), shop.order(2, "p", "c2", 1)), 0)
    log.compact(0, lambda rows: rows)
    files.delete(spark, log._part("index-customer_id", log.base()))
    near = spark.createDataFrame([("c1",)], "customer_id STRING")
    assert {r.order_id for r in log.read_keys("customer_id", None, near).collect()} == {1, 2}
    log.compact(0, lambda rows: rows)  # completes what is missing
    assert {r.order_id for r in log.read_keys("customer_id", None, near).collect() if r.customer_id == "c1"} == {1}


def test_a_dimension_change_may_reach_the_latest_order_only(spark, feeds, pipe):
    keep = maintainer(spark, pipe, refresh="latest")
    feeds.add(orders=[shop.order(1, "p1", "A", 1), shop.order(2, "p1", "A", 2), shop.order(3, "p1", "B", 3)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    feeds.add(customers=[shop.customer("A", "Ann", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    assert names(keep.documents()) == {1: ("", ""), 2: ("Ann", ""), 3: ("", "")}


def test_orders_as_a_stream_with_pushed_updates(spark, feeds, pipe):
    """Orders see the dimensions of their arrival; two more jobs push changes."""
    keep, sink, push, _ = pushes(spark, pipe)
    feeds.add(orders=[shop.order(1, "p1", "A", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    finish(pipe.run(keep.output.stream(), sink, "sink"))
    feeds.add(customers=[shop.customer("A", "Ann", 1)], orders=[shop.order(2, "p1", "A", 1)])
    finish(pipe.run(feeds.stream(), keep, "keep"))
    finish(pipe.run(keep.output.stream(), sink, "sink"))
    assert names(sink.documents()) == {1: ("", ""), 2: ("Ann", "")}
    people = streams.parquet_stream(spark, f"{feeds.root}/customers", shop.CUSTOMERS.schema)
    finish(pipe.run(people, push, "push"))
    assert names(sink.documents()) == {1: ("Ann", ""), 2: ("Ann", "")}


@pytest.mark.parametrize("mode", ["full", "partial"])
def test_logs_stay_bounded_over_many_batches(spark, pipe, mode):
    """Followers note how far they are; what is compacted and no longer needed goes, in both modes."""
    keep = maintainer(spark, pipe, mode=mode, compact_every=4)
    fields = ["ts", "customer", "product"]
    if mode == "full":
        sink = ReplaceSink(spark, pipe.path("store"), "order_id", keep.output.schema, compact_every=2)
    else:
        sink = MergeSink(spark, pipe.path("store"), "order_id", fields, ["version"], keep.output.schema, compact_every=2)
    slow = keep.output.follower("slow", lambda rows, n: None)
    sizes, n = [], 0
    for turn in range(5):
        for _ in range(4):
            orders = [shop.order(n % 7, "p1", "A", n), shop.order(100 + n, "p1", "B", n)]
            people = [shop.customer("A", f"Ann{n}", n)]
            batch = {"orders": shop.rows(spark, shop.ORDERS, *orders), "customers": shop.rows(spark, shop.CUSTOMERS, *people)}
            keep(streams.tagged({**batch, "products": shop.rows(spark, shop.PRODUCTS)}), n)
            n += 1
        if turn == 1:
            keep.trim()
            assert keep.output.batches() == list(range(8))  # one follower has read nothing yet
        finish(pipe.follow(keep.output, sink, "sink"))
        slow(spark.createDataFrame([(n - 1,)], "batch_id long"), turn)
        keep.trim()
        keep.vacuum(1)
        logs = [keep.output, keep._affected, keep._touched, *keep.inputs.values(), *([keep.folded.docs] if keep.folded else [])]
        sizes.append(sum(len(log.batches()) + len(log.commits()) + len(log._bases()) for log in logs))
    assert sizes[2:] == [sizes[2]] * 3
    want = {i: f"Ann{n - 1}" for i in range(7)}
    got = {r.order_id: r.customer.first_name for r in keep.documents().where("order_id < 100").collect()}
    assert got == want and keep.documents().count() == 7 + n
    assert {r.order_id: r.customer.first_name for r in sink.documents().where("order_id < 100").collect()} == want


def test_followers_see_committed_batches_only(spark, tmp_path):
    log = LogTable(spark, str(tmp_path / "log"), shop.PRODUCTS.schema, "id", 2)
    pipe, seen = Pipeline.open(str(tmp_path / "run")), []

    def handler(rows, n):
        seen.append((n, sorted((r.id, r[BATCH]) for r in rows.collect())))

    log.write(shop.rows(spark, shop.PRODUCTS, shop.product("p", "a", 1)), 0)
    half = shop.rows(spark, shop.PRODUCTS, shop.product("q", "b", 1))
    half.write.parquet(f"{log.log_path}/{BATCH}=1")  # complete, but not in the manifest
    finish(pipe.follow(log, handler, "f"))
    assert seen == [(0, [("p", 0)])] and log.needed_from() == 0
    log.write(half, 1)
    log.write(shop.rows(spark, shop.PRODUCTS, shop.product("r", "c", 1)), 2)
    log.write(shop.rows(spark, shop.PRODUCTS), 3)
    finish(pipe.follow(log, handler, "f", max_batches=2))
    assert [rows for _, rows in seen[1:]] == [[("q", 1), ("r", 2)], []]
    assert log.needed_from() == 3
    late = log.follower("late", handler)
    assert log.needed_from() == 0
    # Batch 1 is listed behind batch 2: it is needed until it was handed over.
    for n, (number, needed) in enumerate([(0, 0), (2, 1), (1, 1), (3, 3)]):
        late(spark.createDataFrame([(number,)], f"{BATCH} long"), n)
        assert log.needed_from() == needed
    log.follower("later", handler)
    log.compact(3, lambda rows: rows)
    log.trim()
    assert log.batches() == [0, 1, 2, 3]
    log.follower("later", handler)(spark.createDataFrame([(2,), (3,)], f"{BATCH} long"), 0)
    log.trim()
    assert log.batches() == log.commits() == [2, 3] and log.read().count() == 3


def test_partial_facts_alone_emit_only_what_arrived(spark, pipe):
    """Without a change of a dimension, the rows of the versions before are not looked up and emitted again."""
    keep = maintainer(spark, pipe, mode="partial")
    first = {
        "orders": shop.rows(spark, shop.ORDERS, shop.order(1, "p1", "A", 2)),
        "customers": shop.rows(spark, shop.CUSTOMERS, shop.customer("A", "Ann", 1)),
        "products": shop.rows(spark, shop.PRODUCTS),
    }
    keep(streams.tagged(first), 0)
    before = keep.documents().collect()
    keep(streams.tagged({"orders": shop.rows(spark, shop.ORDERS, shop.order(1, "p2", "A", 1))}), 1)
    assert keep.output.read_batch(1).count() == 3
    assert keep.documents().collect() == before
