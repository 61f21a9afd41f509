"""Keep enriched documents up to date from changes on any side of the star.

A stream--stream outer join would need a watermark and gives up on late
dimension rows, so state is kept as logs instead (see ``sources.logs``). Every
micro-batch

1. appends its changes to the log of each input table,
2. finds the facts whose document may have changed,
3. recomputes those documents and no others, and
4. appends them to the output log.

Each step writes to the directory of its batch id and reads nothing newer, so a
replayed batch gives the same rows. Small intermediate results are written and
read back, so that Spark knows their size when it plans the next join and
broadcasts only what is small.

The cost of a batch follows its changes: facts are found by key, and by foreign
key through an index, in the hash directories the changes fall in, plus the
batches since the last compaction.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators import changelog, enrich, partial, skew
from starweave.sources.logs import BATCH, LogTable
from starweave.sources.streams import TABLE, untag
from starweave.specs import Dimension, StarSpec, TableSpec
from starweave.streaming.sinks import MergeSink

Tap = Callable[[DataFrame, int], None]

OP = "op"
VERSION = "__version"
REACHED = "reached"
"""Of an affected fact: whether a dimension change reaches it, so that its document may change even if its newest version is an old one."""


@dataclass
class Maintainer:
    """``foreachBatch`` function over the tagged union of a star's changelogs."""

    spark: SparkSession
    star: StarSpec
    root: str
    schemas: Mapping[str, T.StructType]
    """Row schema of each input table, by table name."""
    mode: str = "full"
    """``full`` writes whole documents, ``partial`` one row per leg."""
    refresh: str = "all"
    """Which facts a dimension change reaches: ``all`` that reference it, only the
    ``latest`` one per dimension key, or ``none`` (facts look up the dimensions
    as they are when the fact arrives; see ``sinks.UpdateMatching``)."""
    versions: bool = False
    """Add a column ``<dimension>_version`` (a struct, null on a miss) to whole documents,
    so that changes pushed into them can be ordered against what they hold."""
    compact_every: int = 20
    buckets: int = 16
    """Hash directories per compacted input. Size it so that one directory is a
    few GB: some ten thousand for 100 TB."""
    tap: Tap | None = None
    """Called with each batch's output rows; may see a batch again after a failure."""
    policy: skew.SkewPolicy | None = skew.DEFAULT
    inputs: dict[str, LogTable] = field(init=False)
    output: LogTable = field(init=False)

    def __post_init__(self) -> None:
        if self.mode not in ("full", "partial"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.refresh not in ("all", "latest", "none"):
            raise ValueError(f"unknown refresh {self.refresh!r}")
        if self.versions and self.mode != "full":
            raise ValueError("only whole documents carry versions")
        fks = tuple(dict.fromkeys(d.fk for d in self.star.dims))
        self.inputs = {
            s.name: LogTable(
                self.spark, f"{self.root}/in/{s.name}", self.schemas[s.name], s.key, self.buckets,
                fks if s is self.star.fact else (),
            )
            for s in self.star.tables()
        }
        fact = self.schemas[self.star.fact.name]
        key = T.StructType([fact[self.star.fact.key], T.StructField(REACHED, T.BooleanType())])
        self._affected = LogTable(self.spark, f"{self.root}/affected", key)
        touched = fact if self.mode == "partial" else T.StructType([fact[c] for c in self._document_columns()])
        self._touched = LogTable(self.spark, f"{self.root}/touched", touched)
        self.output = LogTable(self.spark, f"{self.root}/out", self._output_schema())
        self.output.ensure()
        #: In partial mode, the documents of all batches up to the last compaction, stamped field by field.
        self.folded = None
        if self.mode == "partial":
            self.folded = MergeSink(
                self.spark, f"{self.root}/folded", self.star.fact.key, self._fields(), self.star.fact.version,
                self.output.schema, OP, compact_every=1, buckets=self.buckets,
            )

    def _fields(self) -> list[str]:
        """Fields of a document besides its key."""
        return [*[c for c in self.star.columns if c != self.star.fact.key], *[d.name for d in self.star.dims]]

    def _document_columns(self) -> list[str]:
        """Columns of a fact that its whole document is made of: its version has done its work once the newest is known."""
        spec = self.star.fact
        op = [spec.op] if spec.op else []
        return list(dict.fromkeys([spec.key, *self.star.columns, *[d.fk for d in self.star.dims], *op]))

    def _output_schema(self) -> T.StructType:
        """Key, fact columns and sub-documents; in partial mode also the version."""
        star, fact = self.star, self.schemas[self.star.fact.name]
        fields = [fact[c] for c in star.columns]
        if self.mode == "partial":
            fields += [fact[c] for c in star.fact.version if c not in star.columns]
        for dim in star.dims:
            table = self.schemas[dim.table.name]
            columns = [
                T.StructField(dim.rename_key or c if c == dim.table.key else c, table[c].dataType)
                for c in dim.columns
            ]
            fields.append(T.StructField(dim.name, T.StructType(columns)))
            if self.versions:
                kept = T.StructType([T.StructField(c, table[c].dataType) for c in dim.table.version])
                fields.append(T.StructField(f"{dim.name}_version", kept))
        return T.StructType([*fields, T.StructField(OP, T.StringType())])

    # --- one micro-batch ------------------------------------------------------------

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if not self.output.committed(batch_id):
            changed = self._append_inputs(batch, batch_id)
            arrived = changed.get(self.star.fact.name)
            if self.mode == "partial" and set(changed) == {self.star.fact.name}:
                # No dimension changed: what was emitted for the versions before still holds.
                rows = self._partial(None, arrived, batch_id)
            else:
                facts = self._current_facts(self._find_affected(changed, batch_id), batch_id)
                rows = self._full(facts, batch_id) if self.mode == "full" else self._partial(facts, arrived, batch_id)
            self.output.write(rows, batch_id)
        if self.tap is not None:
            self.tap(self.output.read_batch(batch_id), batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def _append_inputs(self, batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        """Store the batch, table by table, and return the changes of those that have any.

        Only the newest change per key is kept, except for partial facts, whose
        older versions may set fields the newest leaves null. A batch that can hold
        one table alone is read once, so it is not kept for that.
        """
        can_hold = [s for s in self.star.tables() if s.name in batch.columns]
        rows = batch if len(can_hold) == 1 else batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if len(can_hold) == 1:
                specs = [] if rows.where(F.col(TABLE) == can_hold[0].name).isEmpty() else can_hold
            else:
                present = {r[TABLE] for r in rows.select(TABLE).distinct().collect()}
                specs = [s for s in can_hold if s.name in present]

            def append(spec: TableSpec) -> None:
                changes = untag(rows, spec.name)
                if self.mode == "full" or spec is not self.star.fact:
                    changes = changelog.latest_by_key(changes, spec.key, spec.version)
                else:
                    changes = changes.dropDuplicates([spec.key, *spec.version])
                self.inputs[spec.name].write(changes, batch_id)

            # Independent writes to different tables: let their jobs overlap.
            with ThreadPoolExecutor(max(1, len(specs))) as pool:
                list(pool.map(inheritable_thread_target(self.spark)(append), specs))
        finally:
            if len(can_hold) > 1:
                rows.unpersist()
        return {s.name: self.inputs[s.name].read_batch(batch_id) for s in specs}

    def _find_affected(self, changed: Mapping[str, DataFrame], batch_id: int) -> DataFrame:
        """Keys of the facts to recompute, and whether a dimension change reaches them.

        References in outdated fact versions are included: recomputing a
        document needlessly is harmless, and it saves compacting the log first.
        """
        fact = self.star.fact
        legs = [changed[fact.name].select(fact.key, F.lit(False).alias(REACHED))] if fact.name in changed else []
        for dim in self.star.dims:
            if dim.table.name in changed and self.refresh != "none":
                # Facts that arrived in this batch are in the first leg.
                before = batch_id - 1 if fact.name in changed and self.refresh == "all" else batch_id
                keys = self._winning(dim, changed[dim.table.name], batch_id).select(dim.table.key)
                facts = self.inputs[fact.name].read_keys(dim.fk, before, keys)
                hit = skew.lookup_join(
                    facts.where(F.col(dim.fk).isNotNull()), keys.select(F.col(dim.table.key).alias("__key")),
                    dim.fk, "__key", "left_semi", [fact.key], self.policy,
                ).select(fact.key)
                hit = hit if self.refresh == "all" else self._newest(hit.distinct(), dim, keys, batch_id)
                legs.append(hit.withColumn(REACHED, F.lit(True)))
        if len(legs) == 1 and fact.name in changed:
            return legs[0].distinct() if self.mode == "partial" else legs[0]
        found = partial.union_legs(*legs) if legs else self._nothing()
        self._affected.write(found.groupBy(fact.key).agg(F.max(REACHED).alias(REACHED)), batch_id)
        return self._affected.read_batch(batch_id).select(fact.key, REACHED)

    def _winning(self, dim: Dimension, changes: DataFrame, batch_id: int) -> DataFrame:
        """Changes of a dimension, deletes included, that are the newest of their keys: an older version that arrives
        late changes no document. Which fact is the ``latest`` one is looked up for every change."""
        spec = dim.table
        if self.refresh != "all":
            return changes
        keys = changes.select(F.col(spec.key).alias("__key"))
        log = self.inputs[spec.name].read(batch_id, near=keys).select(spec.key, *spec.version, BATCH)
        hit = skew.lookup_join(log, keys, spec.key, "__key", "left_semi", [spec.key, BATCH], self._row_policy(False))
        return changelog.latest_by_key(hit, spec.key, [*spec.version, BATCH]).where(F.col(BATCH) == batch_id)

    def _nothing(self) -> DataFrame:
        return self.spark.createDataFrame([], self._affected.schema)

    def _newest(self, hit: DataFrame, dim: Dimension, changed: DataFrame, batch_id: int) -> DataFrame:
        """Of the facts found for a dimension, the most recent per changed key."""
        fact = self.star.fact
        live, _ = self._split(self._read_facts(hit, batch_id))
        keys = changed.select(F.col(dim.table.key).alias("__key"))
        still = skew.lookup_join(live, keys, dim.fk, "__key", "left_semi", [fact.key], self.policy)
        return changelog.latest_per_group(still, dim.fk, [*fact.version, fact.key]).select(fact.key)

    def _read_facts(self, affected: DataFrame, batch_id: int, changing: bool = False) -> DataFrame:
        """Newest row of every given fact, deletes included. ``changing`` (keys are given once) leaves out facts that no
        dimension change reaches and whose newest row came in an earlier batch: their documents stand."""
        fact = self.star.fact
        keys = affected.select(F.col(fact.key).alias("__key"), *([REACHED] if changing else []))
        log = self.inputs[fact.name].read(batch_id, near=keys)
        policy = self._row_policy(self.mode == "partial")
        how = "inner" if changing else "left_semi"
        hit = skew.lookup_join(log, keys, fact.key, "__key", how, [fact.key, BATCH], policy)
        newest = changelog.latest_by_key(hit, fact.key, [*fact.version, BATCH])
        if not changing:
            return newest
        return newest.where((F.col(BATCH) == batch_id) | F.coalesce(REACHED, F.lit(True))).drop("__key", REACHED)

    def _row_policy(self, uncompacted: bool) -> skew.SkewPolicy | None:
        """A log that is compacted batch by batch has no heavy keys to look for."""
        return self.policy if uncompacted else None

    def _current_facts(self, affected: DataFrame, batch_id: int) -> DataFrame:
        changing = self.mode == "full" and self.refresh == "all"
        self._touched.write(self._read_facts(affected, batch_id, changing), batch_id)
        return self._touched.read_batch(batch_id)

    def _needed(self, dim: Dimension, facts: DataFrame, batch_id: int) -> DataFrame:
        """Current dimension rows, at least those that these facts reference."""
        spec = dim.table
        wanted = facts.select(F.col(dim.fk).alias("__fk")).where("__fk IS NOT NULL").distinct()
        log = self.inputs[spec.name].read(batch_id, near=wanted)
        narrow = log.select(*self._dimension_columns(dim), BATCH)
        size = skew.scan_bytes(facts)
        if size <= skew.broadcast_limit(facts) or size < skew.scan_bytes(log):
            policy = self._row_policy(False)
            narrow = skew.lookup_join(narrow, wanted, spec.key, "__fk", "left_semi", [spec.key, BATCH], policy)
        # Otherwise the keys of the facts would be more to shuffle than the rows they could spare.
        return changelog.latest_by_key(narrow, spec.key, [*spec.version, BATCH], spec.op)

    @staticmethod
    def _dimension_columns(dim: Dimension) -> list[str]:
        spec = dim.table
        extra = [*spec.version, *([spec.op] if spec.op else [])]
        return list(dict.fromkeys([spec.key, *dim.columns, *extra]))

    def _split(self, facts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        op = self.star.fact.op
        if op is None:
            return facts, None
        return facts.where(F.col(op) != changelog.DELETE), facts.where(F.col(op) == changelog.DELETE)

    def _conform(self, rows: DataFrame, op: str) -> DataFrame:
        """Output columns in order; what the rows do not have is null."""
        have = set(rows.columns) - {OP}
        return rows.select(
            *[
                F.lit(op).alias(OP) if f.name == OP
                else (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.output.schema.fields
            ]
        )

    def _full(self, facts: DataFrame, batch_id: int) -> DataFrame:
        star = self.star
        live, dead = self._split(facts)
        tables = {d.name: self._needed(d, facts, batch_id) for d in star.dims}
        if self.versions:
            star, tables = self._versioned(tables)
        # Heavy keys are looked for in the stored facts, not in what the joins before have made of them.
        joined = enrich.star_join(live, tables, star, policy=self.policy, samples={d.name: live for d in star.dims})
        if self.versions:
            joined = self._versions_apart(joined)
        docs = self._conform(joined, changelog.UPSERT)
        if dead is not None:
            docs = docs.unionByName(self._conform(dead.select(star.fact.key), changelog.DELETE))
        dropping = [d.name for d in star.dims if d.on_miss == "drop"]
        if dropping:
            # A document that lost a required reference must leave the output.
            lost = live.select(star.fact.key).join(docs.select(star.fact.key), star.fact.key, "left_anti")
            docs = docs.unionByName(self._conform(lost, changelog.DELETE))
        return docs

    def _versioned(self, tables: Mapping[str, DataFrame]) -> tuple[StarSpec, dict[str, DataFrame]]:
        """The star and its tables with the version of each dimension row inside its record, so that one lookup gives both."""
        dims = tuple(replace(d, columns=(*d.columns, VERSION)) for d in self.star.dims)
        held = {
            d.name: tables[d.name].withColumn(VERSION, F.struct(F.lit(True).alias("hit"), *d.table.version)) for d in dims
        }
        return replace(self.star, dims=dims), held

    def _versions_apart(self, docs: DataFrame) -> DataFrame:
        """Documents with ``<dimension>_version`` beside the record instead of inside it; null on a miss."""
        for dim in self.star.dims:
            inside = F.col(dim.name)[VERSION]
            version = F.when(inside["hit"], F.struct(*[inside[c].alias(c) for c in dim.table.version]))
            docs = docs.withColumns({f"{dim.name}_version": version, dim.name: F.col(dim.name).dropFields(VERSION)})
        return docs

    def _partial(self, current: DataFrame | None, arrived: DataFrame | None, batch_id: int) -> DataFrame:
        """One row per leg: for every fact version in the batch, and for the
        current version of facts whose dimension row changed."""
        star, fact = self.star, self.star.fact
        legs = [rows for rows in (current, arrived) if rows is not None]
        stored = partial.union_legs(*legs).drop(BATCH)
        # A batch holds a version once, and each of its facts has one current version.
        every = stored.dropDuplicates([fact.key, *fact.version]) if len(legs) > 1 else stored
        live, dead = self._split(every)
        keep = list(fact.version)
        columns = [c for c in star.columns if c not in (fact.key, *keep)]
        tables = {d.name: self._needed(d, stored, batch_id) for d in star.dims}
        # The legs of a version lie together, so a sink merges them before it shuffles.
        wide = partial.wide_rows(live, tables, star.dims, fact.key, columns, keep, self.policy, {d.name: stored for d in star.dims})
        rows = self._conform(partial.stacked_legs(wide, fact.key, [columns, *[[d.name] for d in star.dims]], keep), changelog.UPSERT)
        if dead is not None:
            rows = rows.unionByName(self._conform(dead.select(fact.key, *keep), changelog.DELETE))
        return rows

    # --- reading results ------------------------------------------------------------

    def documents(self) -> DataFrame:
        """Converged documents according to the output log."""
        key = self.star.fact.key
        if self.folded is None:
            return changelog.latest_by_key(self.output.read(), key, BATCH, OP).drop(BATCH, OP)
        return self.folded.documents(self.output.read_batches(self._unfolded()))

    def _unfolded(self, upto: int | None = None) -> list[int]:
        """Output batches that came after the last fold."""
        done = self.folded.docs.base()
        return [b for b in self.output.commits() if (done is None or b > done[0]) and (upto is None or b <= upto)]

    def register(self, view: str) -> DataFrame:
        """Make the current documents queryable under a name, also mid-stream."""
        docs = self.documents()
        docs.createOrReplaceTempView(view)
        return docs

    def compact(self, batch_id: int) -> None:
        """Fold all batches so far into a new base per log.

        Deletes are kept as rows: an older version may still arrive and must lose.
        """
        for spec in self.star.tables():
            order = [*spec.version, BATCH]
            self.inputs[spec.name].compact(
                batch_id, lambda rows, s=spec, o=order: changelog.latest_by_key(rows, s.key, o)
            )
        if self.mode == "full":
            key = self.star.fact.key
            self.output.compact(batch_id, lambda rows: changelog.latest_by_key(rows, key, BATCH))
        else:
            self.folded(self.output.read_batches(self._unfolded(batch_id)), batch_id)

    def vacuum(self, keep: int = 2) -> None:
        """Delete superseded compactions of the inputs and of what the output was folded to (see
        ``LogTable.vacuum``). The output log is left alone: sinks may still be reading it (see ``trim``)."""
        for log in (*self.inputs.values(), *([self.folded.docs] if self.folded else [])):
            log.vacuum(keep)

    def trim(self, upto: int | None = None) -> None:
        """Delete output batches that a compaction covers, up to the last one that every follower is done with
        (``upto`` sets it by hand), and bases that two newer ones supersede. Working tables of these batches go with them. In partial mode the rows were
        folded field by field before, so nothing is lost."""
        covered = (self.folded.docs if self.folded else self.output).base()
        if covered is None:
            return
        self.output.trim(upto, covered[0])
        self.output.drop_bases()
        left = min(self.output.batches(), default=covered[0] + 1)
        for log in (self._affected, self._touched):
            for b in log.batches():
                if b < min(left, covered[0] + 1):
                    log.drop(b)
