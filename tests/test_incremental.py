"""Stateful handlers against recomputation from all rows seen so far, batch by batch."""

import random

import pytest
from pyspark.sql import functions as F

from starweave.operators import asof, changelog, enrich
from starweave.sources import streams
from starweave.specs import Dimension, StarSpec, TableSpec
from starweave.streaming.cascade import AT, Cascade, Step, emitted_schema
from starweave.streaming.contract import Contract, ContractBroken
from starweave.streaming.feed import ChangeFeed
from starweave.streaming.intervals import AsOfDocuments
from starweave.streaming.latest import LatestPerGroup
from starweave.streaming.maintain import Maintainer

FACTS = TableSpec("facts", "id", ("version",), op="op")
FACT = "id long, grp string, note string, at long, op string, version long"
DIMS = TableSpec("dims", "grp", ("version",))
DIM = "grp string, name string, at long, version long"


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


def facts(seed: int, n: int, ids: int, groups: str = "abc") -> list[tuple]:
    """Fact versions in any order: moves between groups, deletes, no group, several of one fact."""
    rnd = random.Random(seed)
    out = []
    for version in range(n):
        op = "delete" if rnd.random() < 0.25 else "upsert"
        out.append((rnd.randrange(ids), rnd.choice([*groups, None]), f"n{version}", rnd.randrange(20), op, version))
    rnd.shuffle(out)
    return out


def batches(rows: list, sizes: list[int]) -> list[list]:
    out, start = [], 0
    for size in sizes:
        out.append(rows[start : start + size])
        start += size
    return [*out, rows[start:]]


def same(got, want) -> None:
    assert sorted(map(str, got)) == sorted(map(str, want))


# --- the change feed ------------------------------------------------------------------


def feed_rows(df):
    return [tuple(r) for r in df.select("id", "version", "change", "old.grp", "new.grp").collect()]


def test_feed_equals_the_batch_feed_after_every_batch(spark, tmp_path):
    schema = spark.createDataFrame([], FACT).schema
    feed = ChangeFeed(spark, FACTS, str(tmp_path), schema, ["grp"], compact_every=3, buckets=2)
    seen = []
    for n, part in enumerate(batches(facts(1, 30, 4), [8, 1, 9])):
        seen += part
        feed(spark.createDataFrame(part, FACT), n)
        want = changelog.to_changelog(spark.createDataFrame(seen, FACT), "id", "version", ["grp"], "op")
        same(feed_rows(feed.changes()), feed_rows(want))


def test_feed_ignores_repeats_and_withdraws_what_a_late_version_undoes(spark, tmp_path):
    schema = spark.createDataFrame([], FACT).schema
    feed = ChangeFeed(spark, FACTS, str(tmp_path), schema, ["grp"])
    first = [(1, "a", "", 0, "upsert", 1), (1, None, "", 0, "delete", 5), (None, "a", "", 0, "upsert", 1)]
    feed(spark.createDataFrame(first, FACT), 0)
    feed(spark.createDataFrame(first + first, FACT), 1)
    assert feed.output.read_batch(1).count() == 0
    same(feed_rows(feed.changes()), [(1, 1, "insert", None, "a"), (1, 5, "delete", "a", None)])
    feed(spark.createDataFrame([(1, None, "", 0, "delete", 3)], FACT), 2)
    same(feed_rows(feed.changes()), [(1, 1, "insert", None, "a"), (1, 3, "delete", "a", None)])
    feed(spark.createDataFrame([(1, "z", "", 0, "upsert", 9)], FACT), 2)  # a replayed batch is done already
    assert feed.changes().count() == 2


# --- the head of each group -----------------------------------------------------------


def heads(spark, seen):
    current = changelog.table(spark.createDataFrame(seen, FACT), FACTS)
    newest = changelog.latest_per_group(current, "grp", ["at", "id"])
    return [tuple(r) for r in newest.select("grp", "id", "note", "at").collect()]


def latest(spark, path, **options):
    schema = spark.createDataFrame([], FACT).schema
    return LatestPerGroup(spark, FACTS, "grp", ["at", "id"], str(path), schema, **{"buckets": 2, **options})


@pytest.mark.parametrize("depth", [1, 3])
def test_heads_equal_recomputation_after_every_batch(spark, tmp_path, depth):
    keep = latest(spark, tmp_path, depth=depth, compact_every=3)
    seen = []
    for n, part in enumerate(batches(facts(depth, 40, 9, "ab"), [12, 1, 9])):
        seen += part
        keep(spark.createDataFrame(part, FACT), n)
        same([tuple(r) for r in keep.rows().select("grp", "id", "note", "at").collect()], heads(spark, seen))


def test_a_runner_up_is_uncovered_without_reading_the_group(spark, tmp_path, monkeypatch):
    keep = latest(spark, tmp_path, depth=3)
    rows = [(i, "a", f"n{i}", i, "upsert", 0) for i in range(6)]
    keep(spark.createDataFrame(rows, FACT), 0)
    monkeypatch.setattr(type(keep.facts), "read_keys", lambda *a: pytest.fail("the group was read"))
    keep(spark.createDataFrame([(5, "b", "moved", 5, "upsert", 1), (4, "a", "n4", 4, "delete", 1)], FACT), 1)
    same([tuple(r) for r in keep.rows().select("grp", "id").collect()], [("a", 3), ("b", 5)])
    monkeypatch.undo()
    keep(spark.createDataFrame([(3, "a", "", 0, "delete", 2)], FACT), 2)  # the list is empty: read again
    same([tuple(r) for r in keep.rows().select("grp", "id").collect()], [("a", 2), ("b", 5)])
    keep(spark.createDataFrame([(i, "a", "", 0, "delete", 3) for i in range(3)], FACT), 3)
    same([tuple(r) for r in keep.rows().select("grp", "id").collect()], [("b", 5)])
    emitted = keep.output.read_batch(3).collect()
    assert [(r.grp, r.op) for r in emitted] == [("a", "delete")]


def test_older_versions_and_batches_without_effect_emit_nothing(spark, tmp_path):
    keep = latest(spark, tmp_path)
    keep(spark.createDataFrame([(1, "a", "x", 5, "upsert", 7), (2, "a", "y", 3, "upsert", 7)], FACT), 0)
    keep(spark.createDataFrame([(1, "b", "old", 9, "upsert", 6), (3, "a", "low", 1, "upsert", 0)], FACT), 1)
    assert keep.output.read_batch(1).count() == 0
    keep(spark.createDataFrame([], FACT), 2)
    same([tuple(r) for r in keep.rows().select("grp", "id", "note").collect()], [("a", 1, "x")])


def test_group_and_depth_are_checked(spark, tmp_path):
    schema = spark.createDataFrame([], FACT).schema
    with pytest.raises(ValueError):
        LatestPerGroup(spark, FACTS, "id", ["at"], str(tmp_path), schema)
    with pytest.raises(ValueError):
        latest(spark, tmp_path, depth=0)


# --- as of the fact's time ------------------------------------------------------------


def test_asof_equals_the_batch_lookup_after_every_batch(spark, tmp_path):
    rnd = random.Random(3)
    fact_schema, dim_schema = (spark.createDataFrame([], s).schema for s in (FACT, DIM))
    docs = AsOfDocuments(
        spark, FACTS, "grp", "at", DIMS, "at", ["name"], "was", str(tmp_path), fact_schema, dim_schema, compact_every=3, buckets=2
    )
    versions = [(rnd.choice(["a", "b", None]), f"v{i}", rnd.choice([*range(0, 20, 2), None]), i) for i in range(30)]
    rnd.shuffle(versions)
    seen_facts, seen_dims = [], []
    for n, (some, more) in enumerate(zip(batches(facts(5, 40, 30, "ab"), [12, 0, 12]), batches(versions, [4, 9, 0]))):
        seen_facts += some
        seen_dims += more
        batch = streams.tagged({"facts": spark.createDataFrame(some, FACT), "dims": spark.createDataFrame(more, DIM)})
        docs(batch, n)
        current = changelog.table(spark.createDataFrame(seen_facts, FACT), FACTS)
        want = asof.asof_lookup(
            current, spark.createDataFrame(seen_dims, DIM), "grp", "at", "grp", "at", ["version"], ["name"], "was", ["id"]
        )
        same(
            [tuple(r) for r in docs.documents().select("id", "grp", "at", "was.name").collect()],
            [tuple(r) for r in want.select("id", "grp", "at", "was.name").collect()],
        )


def test_a_late_version_touches_only_the_facts_of_its_part(spark, tmp_path):
    fact_schema, dim_schema = (spark.createDataFrame([], s).schema for s in (FACT, DIM))
    docs = AsOfDocuments(spark, FACTS, "grp", "at", DIMS, "at", ["name"], "was", str(tmp_path), fact_schema, dim_schema)

    def send(n, some=(), more=()):
        docs(streams.tagged({"facts": spark.createDataFrame(list(some), FACT), "dims": spark.createDataFrame(list(more), DIM)}), n)

    send(0, [(i, "a", "", i, "upsert", 0) for i in range(10)], [("a", "first", 0, 0), ("a", "last", 8, 1)])
    send(1, more=[("a", "late", 5, 2)])
    assert sorted(r.id for r in docs.output.read_batch(1).collect()) == [5, 6, 7]
    send(2, more=[("a", "older at the same instant", 5, 1)])
    assert docs.output.read_batch(2).count() == 0
    found = {r.id: r.was.name for r in docs.documents().collect()}
    assert found == {i: "first" if i < 5 else "late" if i < 8 else "last" for i in range(10)}
    ends = changelog.latest_by_key(docs.intervals.read(), ["grp", "start"], "batch_id")
    same([(r.start, r.until) for r in ends.collect()], [(0, 5), (5, 8), (8, None)])


# --- several hops ---------------------------------------------------------------------

PLACES = TableSpec("places", "place", ("version",))
PLACE = "place string, label string, version long"
PEOPLE = TableSpec("people", "grp", ("version",), op="op")
PERSON = "grp string, place string, op string, version long"


def hops(spark, path):
    schemas = {n: spark.createDataFrame([], s).schema for n, s in (("facts", FACT), ("people", PERSON), ("places", PLACE))}
    place = Dimension("home", PLACES, "place", ("place", "label"), "null")
    settled = Maintainer(spark, StarSpec(PEOPLE, (place,), ("grp",)), f"{path}/settled", schemas, buckets=2)
    known = TableSpec("known", "grp", (AT,), op="op")
    person = Dimension("person", known, "grp", ("grp", "home"), "null")
    made = {"facts": schemas["facts"], "known": emitted_schema(settled.output)}
    docs = Maintainer(spark, StarSpec(FACTS, (person,), ("id", "note")), f"{path}/docs", made, buckets=2, compact_every=2)
    steps = [
        Step(settled, settled.output, ("people", "places"), "known"),
        Step(docs, docs.output, ("facts", "known"), "docs"),
    ]
    return Cascade(steps), docs, place, person


def test_changes_travel_over_two_hops_in_one_batch(spark, tmp_path):
    cascade, docs, place, person = hops(spark, str(tmp_path))
    sent = {"facts": [], "people": [], "places": []}
    kinds = {"facts": FACT, "people": PERSON, "places": PLACE}
    plan = [
        {"facts": [(1, "a", "x", 0, "upsert", 0), (2, "b", "y", 0, "upsert", 0), (3, "a", "z", 0, "upsert", 0)]},
        {"people": [("a", "P", "upsert", 0), ("b", "Q", "upsert", 0)], "places": [("P", "old", 0)]},
        {"places": [("P", "new", 2), ("Q", "q", 0)]},
        {"places": [("P", "late", 1)], "facts": [(3, "b", "z", 0, "upsert", 1)]},
        {"people": [("a", None, "delete", 1), ("b", "P", "upsert", 1)], "facts": [(2, None, None, 0, "delete", 1)]},
    ]
    for n, part in enumerate(plan):
        for name, rows in part.items():
            sent[name] += rows
        cascade(streams.tagged({k: spark.createDataFrame(part.get(k, []), s) for k, s in kinds.items()}), n)
        frames = {k: spark.createDataFrame(sent[k], s) for k, s in kinds.items()}
        homes = enrich.lookup(changelog.table(frames["people"], PEOPLE), changelog.table(frames["places"], PLACES), place, ["grp"])
        want = enrich.lookup(changelog.table(frames["facts"], FACTS), homes, person, ["id"])
        columns = ("id", "note", "person.grp", "person.home.label")
        same([tuple(r) for r in docs.documents().select(*columns).collect()], [tuple(r) for r in want.select(*columns).collect()])
    # The change of a place alone reached exactly the facts behind it.
    assert sorted(r.id for r in docs.output.read_batch(2).collect()) == [1, 2, 3]


def test_a_cascade_that_stopped_between_two_steps_goes_on(spark, tmp_path):
    cascade, docs, _, _ = hops(spark, str(tmp_path))
    batch = streams.tagged(
        {
            "facts": spark.createDataFrame([(1, "a", "x", 0, "upsert", 0)], FACT),
            "people": spark.createDataFrame([("a", "P", "upsert", 0)], PERSON),
            "places": spark.createDataFrame([("P", "p", 0)], PLACE),
        }
    )
    Cascade(cascade.steps[:1])(batch, 0)
    assert not docs.output.committed(0)
    cascade(batch, 0)
    cascade(batch, 0)
    assert [(r.id, r.person.home.label) for r in docs.documents().collect()] == [(1, "p")]


def test_names_of_steps_are_checked(spark, tmp_path):
    _, docs, _, _ = hops(spark, str(tmp_path))
    with pytest.raises(ValueError):
        Cascade([Step(docs, docs.output, ("facts",), "x"), Step(docs, docs.output, ("x",), "x")])
    with pytest.raises(ValueError):
        Cascade([Step(docs, docs.output, ("facts", "people"), "x", tag=False)])


def test_a_head_that_moves_away_re_emits_the_document_it_leaves(spark, tmp_path):
    schema = spark.createDataFrame([], FACT + ", owner string").schema
    keep = LatestPerGroup(spark, FACTS, "grp", ["at", "id"], f"{tmp_path}/latest", schema, depth=2, buckets=2)
    heads_ = TableSpec("heads", "grp", (AT,), op="op")
    lead = Dimension("dim", DIMS, "owner", ("grp", "name"), "drop")
    schemas = {"heads": emitted_schema(keep.output), "dims": spark.createDataFrame([], DIM).schema}
    docs = Maintainer(spark, StarSpec(heads_, (lead,), ("grp", "id")), f"{tmp_path}/docs", schemas, buckets=2)
    cascade = Cascade(
        [
            Step(keep, keep.output, ("facts",), "heads", tag=False),
            Step(docs, docs.output, ("heads", "dims"), "documents"),
        ]
    )

    def send(n, rows, dims=()):
        made = spark.createDataFrame(rows, FACT).withColumn("owner", F.col("grp"))
        cascade(streams.tagged({"facts": made, "dims": spark.createDataFrame(list(dims), DIM)}), n)
        return sorted((r.grp, r.id, r.dim.name) for r in docs.documents().collect())

    first = [(1, "a", "", 1, "upsert", 0), (2, "a", "", 2, "upsert", 0)]
    assert send(0, first, [("a", "A", 0, 0)]) == [("a", 2, "A")]
    assert send(1, [(2, "b", "", 2, "upsert", 1)], [("b", "B", 0, 0)]) == [("a", 1, "A"), ("b", 2, "B")]
    assert send(2, [(1, "a", "", 1, "delete", 1)]) == [("b", 2, "B")]
    assert send(3, [], [("b", "BB", 0, 1)]) == [("b", 2, "BB")]
    assert send(4, [(1, "c", "", 1, "upsert", 2)]) == [("b", 2, "BB")]  # no row for c yet
    assert send(5, [], [("c", "C", 0, 0)]) == [("b", 2, "BB"), ("c", 1, "C")]


# --- contracts ------------------------------------------------------------------------


def test_a_contract_splits_a_batch_in_one_pass(spark, tmp_path):
    schema = spark.createDataFrame([], FACT).schema
    rules = {"early": F.col("at") < 10, "short": F.length("note") < 3}
    contract = Contract(spark, str(tmp_path), "id", schema, ["grp"], rules, "op", most=0.8, compact_every=2, buckets=2)
    first = [(1, "a", "x", 1, "upsert", 0), (2, None, "long", 99, "upsert", 0), (3, "a", None, 5, "upsert", 0), (4, None, None, None, "delete", 0)]
    contract(spark.createDataFrame(first, FACT), 0)
    assert sorted(r.id for r in contract.accepted.read().collect()) == [1, 4]
    assert {r.id: list(r.broken) for r in contract.rejected.read().collect()} == {2: ["grp", "early", "short"], 3: ["short"]}
    contract(spark.createDataFrame([(2, "b", "y", 2, "upsert", 1), (1, "a", "x", 50, "upsert", 1), (5, "c", "", 0, "upsert", 0)], FACT), 1)
    assert contract.accepted.base() and {r.id: list(r.broken) for r in contract.current().collect()} == {1: ["early"], 2: [], 3: ["short"], 5: []}


def test_too_many_broken_rows_stop_the_batch(spark, tmp_path):
    schema = spark.createDataFrame([], FACT).schema
    contract = Contract(spark, str(tmp_path), "id", schema, ["grp"], most=0.5)
    bad = spark.createDataFrame([(1, None, "", 0, "upsert", 0), (2, None, "", 0, "upsert", 0), (3, "a", "", 0, "upsert", 0)], FACT)
    with pytest.raises(ContractBroken, match="2 of 3"):
        contract(bad, 0)
    assert contract.accepted.commits() == contract.rejected.commits() == [] and contract.current().count() == 0
    mended = bad.withColumn("grp", F.when(F.col("id") == 1, F.lit(None)).otherwise(F.lit("a")))
    contract(mended, 0)
    contract(mended, 0)
    assert {r.id: len(r.broken) for r in contract.current().collect()} == {1: 1, 2: 0, 3: 0}
    contract(spark.createDataFrame([], FACT), 1)
    assert contract.rejected.read_batch(1).count() == 0
    with pytest.raises(ValueError):
        Contract(spark, str(tmp_path), "id", schema, most=2)


def test_a_batch_that_stopped_between_the_two_logs_goes_on(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], FACT).schema
    contract = Contract(spark, str(tmp_path), "id", schema, ["grp"])
    rows = spark.createDataFrame([(1, None, "", 0, "upsert", 0), (2, "a", "", 0, "upsert", 0)], FACT)
    write = type(contract.accepted).write

    def fails(log, frame, n):
        if log.path.endswith("accepted"):
            raise OSError("lost")
        return write(log, frame, n)

    monkeypatch.setattr(type(contract.accepted), "write", fails)
    with pytest.raises(OSError):
        contract(rows, 0)
    monkeypatch.undo()
    contract(rows, 0)
    assert {r.id: len(r.broken) for r in contract.current().collect()} == {1: 1, 2: 0}
