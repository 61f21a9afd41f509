"""The most recent fact of each group, kept as facts arrive, move to other groups and go.

Per group, a list of its newest facts is stored: the head is the answer, the others
are runners-up that a departing head uncovers. ``floor`` is the place down to which
the list is known to be whole; what arrives below it is left to the log of the
facts. Only a group whose list has run empty above its floor is read again from
that log, by the index on the group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from starweave.operators import changelog, skew
from starweave.sources.logs import BATCH, LogTable
from starweave.specs import TableSpec
from starweave.streaming.working import forget, rows_of, settle

OP = "op"


@dataclass
class LatestPerGroup:
    """``foreachBatch`` function over a fact changelog; the output log holds a row whenever a group's head changes.

    ``order`` are the columns that rank the facts of a group, the newest highest; end it with the key, so that no
    two facts tie. An older version of a fact that arrives late changes nothing. Facts without a group
    belong to none. Output rows have the columns of the facts; the row of a group that has run empty is a
    delete with nothing but the group.
    """

    spark: SparkSession
    table: TableSpec
    group: str
    order: Sequence[str]
    root: str
    schema: T.StructType
    depth: int = 8
    """Runners-up kept for a group. It bounds the state; results don't depend on it."""
    compact_every: int = 20
    buckets: int = 16
    policy: skew.SkewPolicy | None = skew.DEFAULT
    facts: LogTable = field(init=False)
    runners: LogTable = field(init=False)
    output: LogTable = field(init=False)

    def __post_init__(self) -> None:
        if self.group == self.table.key or self.depth < 1:
            raise ValueError("a group is another column than the key, and at least its head is kept")
        self.facts = LogTable(self.spark, f"{self.root}/facts", self.schema, self.table.key, self.buckets, (self.group,))
        at = self.spark.createDataFrame([], self.schema).select(self._at().alias("at")).schema["at"].dataType
        member = T.StructType([T.StructField("at", at), T.StructField("row", self.schema)])
        stored = [
            self.schema[self.group],
            T.StructField("members", T.ArrayType(member)),
            T.StructField("whole", T.BooleanType()),
            T.StructField("floor", at),
        ]
        self.runners = LogTable(self.spark, f"{self.root}/runners", T.StructType(stored), self.group, self.buckets)
        fields = [f for f in self.schema.fields if f.name != self.table.op]
        out = T.StructType([*fields, T.StructField(OP, T.StringType())])
        self.output = LogTable(self.spark, f"{self.root}/out", out, self.group, self.buckets)
        self.output.ensure()

    def _at(self) -> Column:
        opened = changelog.version_columns(self.spark.createDataFrame([], self.schema), self.order)
        return F.struct(*[c.alias(f"v{i}") for i, c in enumerate(opened)])

    def _row(self) -> Column:
        return F.struct(*self.schema.names)

    # --- one micro-batch ------------------------------------------------------------

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        if not self.output.committed(batch_id):
            spec = self.table
            self.facts.write(changelog.latest_by_key(rows, spec.key, spec.version), batch_id)
            moves = settle(self.facts, "moves", self._moves(batch_id), batch_id)
            groups = settle(self.facts, "groups", self._groups(moves, batch_id), batch_id)
            lists = settle(self.facts, "lists", self._lists(groups, moves), batch_id)
            self.runners.write(lists.unionByName(self._refilled(lists, batch_id)).where("NOT empty_above_floor"), batch_id)
            self.output.write(self._heads(groups, batch_id), batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def _alive(self) -> Column:
        return F.lit(True) if self.table.op is None else F.col(self.table.op) != changelog.DELETE

    def _moves(self, batch_id: int) -> DataFrame:
        """``enters`` or ``leaves`` a ``grp``: one or two rows for each fact that this batch changes."""
        spec = self.table
        arrived = self.facts.read_batch(batch_id)
        # Each batch holds a fact once, so none of them is heavy in the log.
        stored = rows_of(self.facts, arrived.select(spec.key), batch_id - 1)
        before = changelog.latest_by_key(stored, spec.key, [*spec.version, BATCH])
        version = F.struct(*[c.alias(f"v{i}") for i, c in enumerate(changelog.version_columns(arrived, spec.version))])
        kept = (F.col("key"), F.col("at"), F.col("row"), F.col("grp"), F.col("alive"))

        def side(df: DataFrame, name: str) -> DataFrame:
            made = df.select(
                F.col(spec.key).alias("key"), self._at().alias("at"), self._row().alias("row"), F.col(self.group).alias("grp"),
                (self._alive() & F.col(self.group).isNotNull()).alias("alive"), version.alias("version"),
            )
            return made.select("key", F.struct("version", *kept).alias(name))

        both = side(arrived, "new").join(side(before, "old"), "key", "left")
        newer = both.where(F.col("old").isNull() | (F.col("new.version") > F.col("old.version")))
        legs = F.array(
            F.struct(F.lit(True).alias("enters"), *[F.col(f"new.{c}").alias(c) for c in ("grp", "key", "at", "row", "alive")]),
            F.struct(F.lit(False).alias("enters"), *[F.col(f"old.{c}").alias(c) for c in ("grp", "key", "at", "row", "alive")]),
        )
        return newer.select(F.explode(legs).alias("leg")).select("leg.*").where("alive").drop("alive")

    def _groups(self, moves: DataFrame, batch_id: int) -> DataFrame:
        """The stored lists of the groups concerned; a group seen first has an empty and whole one."""
        touched = moves.select(F.col("grp").alias("__grp")).distinct()
        stored = rows_of(self.runners, touched, batch_id - 1)
        newest = changelog.latest_by_key(stored, self.group, BATCH).drop(BATCH)
        found = touched.join(newest, F.col("__grp") == F.col(self.group), "left")
        return found.select(
            F.col("__grp").alias(self.group), "members", F.coalesce("whole", F.lit(True)).alias("whole"), "floor"
        )

    def _lists(self, groups: DataFrame, moves: DataFrame) -> DataFrame:
        """The lists after the batch: what left is out, what entered above the floor is in."""
        held = groups.select(self.group, F.explode("members").alias("m")).select(self.group, "m.at", "m.row")
        left = moves.where("NOT enters").select(F.col("key").alias("__left"), F.col("grp").alias("__from"))
        gone = (F.col(f"row.{self.table.key}") == F.col("__left")) & (F.col(self.group) == F.col("__from"))
        staying = held.join(left, gone, "left_anti")
        entering = (
            moves.where("enters")
            .join(groups.select(F.col(self.group).alias("grp"), "whole", "floor"), "grp")
            .where(F.col("whole") | (F.col("at") >= F.col("floor")))
            .select(F.col("grp").alias(self.group), "at", "row")
        )
        made = self._ranked(staying.unionByName(entering))
        joined = groups.drop("members").join(made, self.group, "left")
        cut = F.coalesce("cut", F.lit(False))
        members = F.coalesce("members", F.array().cast(self.runners.schema["members"].dataType))
        whole = F.col("whole") & ~cut
        return joined.select(
            self.group,
            members.alias("members"),
            whole.alias("whole"),
            F.when(cut, F.element_at("members", -1)["at"]).otherwise(F.col("floor")).alias("floor"),
            (~whole & (F.size(members) == 0)).alias("empty_above_floor"),
        )

    def _ranked(self, rows: DataFrame) -> DataFrame:
        """``members`` of each group, newest first, and whether more had to be ``cut`` off.

        No task holds more than ``depth`` + 1 rows of a group: the rank filter works in every task before the shuffle.
        """
        place = Window.partitionBy(self.group).orderBy(F.col("at").desc())
        ranked = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= self.depth + 1)
        kept = F.when(F.col("place") <= self.depth, F.struct("at", "row"))
        return ranked.groupBy(self.group).agg(
            F.sort_array(F.collect_list(kept), asc=False).alias("members"), (F.max("place") > self.depth).alias("cut")
        )

    def _refilled(self, lists: DataFrame, batch_id: int) -> DataFrame:
        """Lists that have run empty above their floor, read again from the current facts."""
        spec = self.table
        wanted = lists.where("empty_above_floor").select(F.col(self.group).alias("__grp"))
        if wanted.isEmpty():
            return lists.limit(0)
        pairs = self.facts.read_keys(self.group, batch_id, wanted)
        keys = skew.lookup_join(pairs, wanted, self.group, "__grp", "left_semi", [spec.key], self.policy).select(spec.key).distinct()
        rows = rows_of(self.facts, settle(self.facts, "refill", keys, batch_id), batch_id)
        live = changelog.latest_by_key(rows, spec.key, [*spec.version, BATCH]).where(self._alive())
        members = skew.lookup_join(live, wanted, self.group, "__grp", "left_semi", [spec.key], self.policy)
        made = self._ranked(members.select(self.group, self._at().alias("at"), self._row().alias("row")))
        joined = wanted.join(made, F.col("__grp") == F.col(self.group), "left")
        cut = F.coalesce("cut", F.lit(False))
        return joined.select(
            F.col("__grp").alias(self.group),
            F.coalesce("members", F.array().cast(self.runners.schema["members"].dataType)).alias("members"),
            (~cut).alias("whole"),
            F.when(cut, F.element_at("members", -1)["at"]).alias("floor"),
            F.lit(False).alias("empty_above_floor"),
        )

    def _heads(self, groups: DataFrame, batch_id: int) -> DataFrame:
        """The new head of every group whose head is another one than before, or a delete."""
        now = self.runners.read_batch(batch_id).select(F.col(self.group).alias("__grp"), F.get("members", F.lit(0)).alias("now"))
        was = groups.select(F.col(self.group).alias("__was"), F.get("members", F.lit(0)).alias("was"))
        both = now.join(was, F.col("__grp") == F.col("__was")).where(~F.col("now.row").eqNullSafe(F.col("was.row")))
        fields = [f.name for f in self.output.schema.fields if f.name not in (OP, self.group)]
        return both.select(
            F.col("__grp").alias(self.group),
            *[F.col(f"now.row.{c}").alias(c) for c in fields],
            F.when(F.col("now").isNull(), changelog.DELETE).otherwise(changelog.UPSERT).alias(OP),
        )

    # --- reading results ------------------------------------------------------------

    def rows(self) -> DataFrame:
        """The most recent fact of every group that has one."""
        return changelog.latest_by_key(self.output.read(), self.group, BATCH, OP).drop(BATCH, OP)

    def compact(self, batch_id: int) -> None:
        spec = self.table
        self.facts.compact(batch_id, lambda rows: changelog.latest_by_key(rows, spec.key, [*spec.version, BATCH]))
        for log in (self.runners, self.output):
            log.compact(batch_id, lambda rows: changelog.latest_by_key(rows, self.group, BATCH))
        forget(self.facts, ("moves", "groups", "lists", "refill"), batch_id - 1)
