"""N-gram Jaccard join with PartEnum signatures.

Sets of word shingles link when their Jaccard similarity reaches a percentage.
Sizes are cut into bands so that linked sets lie in one band or in two next to
each other. In a band, linked sets differ in at most ``k`` shingles. The shingle
domain is hashed into ``n1`` partitions and each of them into ``n2``. If
``n1 * (k2 + 1) > k``, some partition has at most ``k2`` second-level partitions that
differ, so linked sets agree on ``n2 - k2`` of them: what a set holds in every such
subset is one of its signatures, and nothing is missed. Bands with few differing
shingles take ``k2 = 1`` of ``n2 = 3``, so a signature is two thirds of a partition twice
as large; longer texts take ``n2 = 1, k2 = 0`` with ``n1 > k``. A line or passage that very many
documents share must not become a signature by itself: a set with enough
partitions that hold something rarer needs only those, by the same count.

Equal sets are joined first, by a 128-bit key. Then each signature's sets are
compared with one pivot set, and only sets that are still in different
components meet in later rounds. In a signature of many sets they do so in
blocks, by parity sketches: the parities of hashed shingle counts differ in at
most as many places as the sets differ in shingles, so a pair that differs in too
many cannot be linked. Of the others only so many leave the task that they connect
what all of them connect, fewer than the blocks have sets, and are verified on whole
shingle sets. Where a pair fails, others may still link what it was to connect: the
last round brings the whole sets that are left to the blocks, compares all of their
pairs that sketches allow, and sends out links that connect what all connect. So a
large group of near copies sends out about as many pairs as it has copies for each
signature, and no link between components is lost.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.llm.collocations import Bloom
from starweave.llm.components import components
from starweave.llm.shingles import mix, shingle_set
from starweave.llm.tables import free_name
from starweave.session import scratch_dir, stage

#: One in so many documents is looked at to find frequent shingles, and how often one must be seen there.
#: These and ``FREQUENT`` only decide which of its signatures a set uses; links do not depend on them.
SAMPLE_ONE_IN, SEEN = 64, 4
#: Frequent shingles used at most.
FREQUENT = 100_000
FILTER_BITS = 22
#: Second-level partitions of each first-level one, and how many of them may differ, in bands of at most ``SUBSETS_UP_TO``
#: differing shingles. Beyond it a signature already holds several shingles of a long text and the second level is one
#: partition: there are as many first-level partitions as shingles may differ, and some more.
N2, K2, SUBSETS_UP_TO = 3, 1, 32
#: Classes of a signature that meet as plain pairs; more are compared in blocks of ``BLOCK``, of about so many shingles
#: where whole sets meet.
FEW, BLOCK, BLOCK_SHINGLES = 8, 256, 1 << 19
#: Rows and bytes that Spark hands to a task's Python at once; a row can be two blocks.
ROWS, BATCH_BYTES = 1024, 4 << 20
#: Bits for each document whose text is fetched again, and the least and most bits (in powers of two) of their filter.
#: Beyond the most it lets more texts pass than are wanted; the join behind it drops them.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 10, 26
#: Rounds in which every signature's sets are compared with one pivot, then rounds in which blocks send out pairs that
#: connect all that may be linked, before the round on whole sets.
PIVOT_ROUNDS, SPANNING_ROUNDS = 2, 1


@dataclass(frozen=True)
class Bands:
    """Size bands and their signatures for one similarity, in per cent."""

    percent: int

    def upto(self, size: int) -> list[int]:
        """Largest set size of each band, up to the band after the one that holds ``size``."""
        tops, low = [], 1
        while True:
            high = low * 100 // self.percent
            tops.append(high)
            if low > size:
                return tops
            low = high + 1

    def of(self, size: int) -> list[tuple[int, int]]:
        """Number and largest size of the bands in which a set of this size looks for partners."""
        tops = self.upto(size)
        own = bisect_left(tops, size)
        larger = size * 100 // self.percent > tops[own]
        return [(i, tops[i]) for i in ((own, own + 1) if larger else (own,))]

    def differ(self, top: int) -> int:
        """Shingles that may lie in only one of two linked sets of at most ``top`` shingles."""
        return 2 * top * (100 - self.percent) // (100 + self.percent)

    def signatures(self, shingles: np.ndarray, frequent: np.ndarray | None = None) -> np.ndarray:
        """64-bit signatures of a set of shingle hashes. ``frequent`` marks hashes by their lowest bits.

        Of two linked sets, one with more than ``k / (K2 + 1)`` partitions of a kind that equal content shares
        (holding something rare; holding anything) is sure to have a subset of one of them in common with the other.
        So a set uses the first kind of which it has so many: something rare, anything, or all partitions.
        """
        if not len(shingles):
            return np.empty(0, dtype=np.uint64)
        content = mix(shingles, 11)
        rare = None if frequent is None else ~frequent[shingles & np.uint64(len(frequent) - 1)]
        out = []
        for band, top in self.of(len(shingles)):
            k = self.differ(top)
            place = mix(shingles, 1000 + band) >> np.uint64(32)
            numbers, held = (_subsets if 0 < k <= SUBSETS_UP_TO else _partitions)(place, content, rare, k)
            out.append(mix(mix(held, 2) + mix(numbers, 3 + band)))
        return np.unique(np.concatenate(out))


def _subsets(place: np.ndarray, content: np.ndarray, rare: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and content of every subset of ``N2 - K2`` second-level partitions that is used.

    If 2 m > k, some of any m first-level partitions has at most one second-level partition that differs (``K2``);
    the subset without it is the same in both sets. A partition counts for a kind if all its subsets are of that
    kind, and every subset of that kind is used, so the other set has it whatever kinds it uses.
    """
    first = k // (K2 + 1) + 2 + k // 16
    cell = (place * np.uint64(first * N2) >> np.uint64(32)).astype(np.int64)
    held = np.zeros(first * N2, dtype=np.uint64)
    np.add.at(held, cell, content)
    held = held.reshape(first, N2)
    without = held.sum(1, keepdims=True, dtype=np.uint64) - held
    numbers = np.arange(first * N2, dtype=np.uint64)
    for chosen in (cell if rare is None else cell[rare], cell):
        kind = np.zeros(first * N2, dtype=bool)
        kind[chosen] = True
        kind = kind.reshape(first, N2)
        inside = kind.sum(1, keepdims=True)
        if (K2 + 1) * np.count_nonzero(inside > K2) > k:
            used = (inside > kind).ravel()
            return numbers[used], without.ravel()[used]
    return numbers, without.ravel()


def _partitions(place: np.ndarray, content: np.ndarray, rare: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and content of the partitions that are used, where the second level is one partition."""
    parts = k + 3 + k // 16
    part = place * np.uint64(parts) >> np.uint64(32)
    part = part.astype(np.uint16 if parts < 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    ordered = part[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    filled = ordered[first].astype(np.uint64)
    held = np.add.reduceat(content[order], first)
    if rare is not None and len(filled) > k:
        strong = np.logical_or.reduceat(rare[order], first)
        if np.count_nonzero(strong) > k:
            filled, held = filled[strong], held[strong]
    if len(filled) <= k:
        every = np.zeros(parts, dtype=np.uint64)
        every[filled.astype(np.int64)] = held
        filled, held = np.arange(parts, dtype=np.uint64), every
    return filled, held


def _key(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums that name a set."""
    return tuple(int(np.add.reduce(mix(shingles, s)).astype(np.int64)) if len(shingles) else 0 for s in (21, 22))


def _keyed(df: DataFrame, text: str, words: int) -> DataFrame:
    @F.arrow_udf("struct<n: long, k1: long, k2: long>")
    def keys(texts: pa.Array) -> pa.Array:
        rows = np.empty((len(texts), 3), dtype=np.int64)
        for i, t in enumerate(texts):
            s = shingle_set(t.as_py(), words)
            rows[i] = len(s), *_key(s)
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], names=["n", "k1", "k2"])

    return df.withColumn("set", keys(F.col(text)))


def _frequent(docs: DataFrame, words: int) -> np.ndarray | None:
    """Marks of the most frequent shingles of a sample of ``id, text``; at most ``FREQUENT`` reach the driver."""
    some = docs.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE_ONE_IN)) == 0)
    each = _sets(some, "text", words).select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    top = each.where(F.col("n") >= SEEN).orderBy(F.desc("n"), "s").limit(FREQUENT).select("s").toArrow()
    if not top.num_rows:
        return None
    marks = np.zeros(1 << FILTER_BITS, dtype=bool)
    marks[top.column("s").to_numpy().astype(np.uint64) & np.uint64(len(marks) - 1)] = True
    return marks


def _signed(df: DataFrame, text: str, words: int, bands: Bands, frequent: np.ndarray | None) -> DataFrame:
    """``sig, k1``: the signatures of every set, once for each task that has it."""
    shared = df.sparkSession.sparkContext.broadcast(None if frequent is None else np.packbits(frequent))  # 512 KB

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if shared.value is None else np.unpackbits(shared.value).astype(bool)
        done: set[tuple[int, int]] = set()
        for batch in batches:
            sigs, keys, waiting = [], [], 0
            for value in batch.column(0):
                s = shingle_set(value.as_py(), words)
                key = _key(s)
                if not len(s) or key in done:
                    continue
                done.add(key)
                own = bands.signatures(s, marks)
                sigs.append(own)
                keys.append(np.full(len(own), key[0], dtype=np.int64))
                waiting += len(own)
                if waiting > 1 << 16:
                    yield _batch(sigs, keys)
                    sigs, keys, waiting = [], [], 0
            if sigs:
                yield _batch(sigs, keys)

    return df.select(text).mapInArrow(rows, "sig long, k1 long")


def _batch(sigs: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
    columns = (np.concatenate(sigs).astype(np.int64), np.concatenate(keys))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["sig", "k1"])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of two or more hashed places a shingle, as 64-bit words.

    The number of words is a power of two, and halving it by exclusive or gives the smaller sketch.
    """
    words = 1
    while words * 64 < 2 * len(shingles):
        words *= 2
    counts = np.bincount((mix(shingles, 31) & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<u8")


def _folded(sketches: list[bytes], words: int) -> np.ndarray:
    rows = []
    for raw in sketches:
        one = np.frombuffer(raw, dtype="<u8")
        while len(one) > words:
            one = one[: len(one) // 2] ^ one[len(one) // 2 :]
        rows.append(one)
    return np.array(rows, dtype=np.uint64).reshape(len(rows), words)


def _sets(df: DataFrame, text: str, words: int) -> DataFrame:
    """``df`` with ``shingles``."""

    @F.arrow_udf("array<long>")
    def hashes(texts: pa.Array) -> pa.Array:
        return _lists([shingle_set(t.as_py(), words) for t in texts])

    return df.withColumn("shingles", hashes(F.col(text)))


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, sets)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets or [ends[:0]]).astype(np.int64)))


def _described(df: DataFrame, words: int) -> DataFrame:
    """``v, n, shingles, sketch`` of the rows ``v, text, k1, k2`` whose text has the set that the key names.

    The rows pass through Python as they are, so Spark can't describe texts before it knows which ones are wanted.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(v, shingle_set(t.as_py(), words), k) for v, t, *k in zip(*batch.columns, strict=True)]
            own = [(v.as_py(), s) for v, s, k in found if _key(s) == tuple(x.as_py() for x in k)]
            sets = [s for _, s in own]
            columns = [
                pa.array([v for v, _ in own], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                _lists(sets),
                pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["v", "n", "shingles", "sketch"])

    return df.select("v", "text", "k1", "k2").mapInArrow(rows, "v long, n long, shingles array<long>, sketch binary")


def _hash(ids: Column) -> Column:
    return F.xxhash64(ids, F.lit("wanted"))


def _bloom(wanted: DataFrame) -> Bloom:
    """A filter over the column ``id``. Spark combines its words; at most ``2 ** (MOST_BITS - 6)`` reach the driver."""
    bits = min(max((wanted.count() * BITS_EACH).bit_length(), LEAST_BITS), MOST_BITS)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = Bloom(np.zeros(1 << bits - 6, dtype=np.uint64))
        for batch in batches:
            for at in bloom.places(batch.column(0).to_numpy().view(np.uint64)):
                np.bitwise_or.at(bloom.words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        filled = np.flatnonzero(bloom.words)
        values = bloom.words[filled].view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(values)], names=["at", "bits"])

    filled = wanted.select(_hash(F.col("id"))).mapInArrow(fill, "at long, bits long")
    rows = filled.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << bits - 6, dtype=np.uint64)
    words[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Bloom(words)


def _may_be_wanted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``id`` may be among the wanted ones: all that are, and few others."""
    shared = docs.sparkSession.sparkContext.broadcast(_bloom(wanted).words)  # 8 MB at most

    @F.arrow_udf("boolean")
    def holds(hashes: pa.Array) -> pa.Array:
        return pa.array(Bloom(shared.value).holds(hashes.to_numpy().view(np.uint64)))

    return docs.where(holds(_hash(F.col("id"))))


def _near(percent: int):
    """Whether two sketches of sets of known sizes differ in few enough places for a link."""

    @F.arrow_udf("boolean")
    def near(one: pa.Array, two: pa.Array, n1: pa.Array, n2: pa.Array) -> pa.Array:
        sizes = n1.to_numpy() + n2.to_numpy()
        out = np.zeros(len(sizes), dtype=bool)
        for i, (x, y) in enumerate(zip(one, two, strict=True)):
            pair = [x.as_py(), y.as_py()]
            k = _folded(pair, min(map(len, pair)) // 8)
            out[i] = int(np.bitwise_count(k[0] ^ k[1]).sum()) * (100 + percent) <= (100 - percent) * sizes[i]
        return pa.array(out)

    return near


class _Met:
    """Two blocks of classes of a signature (or one with itself) and which of their pairs sketches and sizes allow."""

    def __init__(self, one: pa.Array, two: pa.Array, same: bool, percent: int) -> None:
        """``two`` is ``one`` if a block meets itself."""
        (self.v1, self.n1, l1), (self.v2, self.n2, l2) = (
            [c.field(f).to_numpy() for f in ("v", "n", "label")] for c in (one, two)
        )
        s1, s2 = (c.field("sketch").to_pylist() for c in (one, two))
        words = min(map(len, (*s1, *s2))) // 8
        self.k1, self.k2 = _folded(s1, words), _folded(s2, words)
        self.same, self.percent = same, percent
        #: Components of the labels as far as they are known here.
        numbers = np.unique(np.concatenate((l1, l2)), return_inverse=True)[1]
        self.part1, self.part2 = numbers[: len(l1)], numbers[len(l1) :]

    def near(self, i: int) -> np.ndarray:
        """Places in the second block that row ``i`` of the first may be linked with, in other components."""
        differ = np.bitwise_count(self.k2 ^ self.k1[i]).sum(1, dtype=np.int64)
        able = differ * (100 + self.percent) <= (100 - self.percent) * (self.n1[i] + self.n2)
        able &= 100 * np.minimum(self.n1[i], self.n2) >= self.percent * np.maximum(self.n1[i], self.n2)
        able &= self.part1[i] != self.part2
        at = np.flatnonzero(able)
        return at[at > i] if self.same else at

    def join(self, i: int, j: int) -> None:
        keep, gone = self.part1[i], self.part2[j]
        self.part1[self.part1 == gone] = keep
        self.part2[self.part2 == gone] = keep


def _met(one: pa.ListScalar, two: pa.ListScalar, percent: int) -> _Met:
    """A row of blocks; without a second one, the first meets itself."""
    return _Met(one.values, two.values if two.is_valid else one.values, not two.is_valid, percent)


def _pair_batch(v1: list[int], v2: list[int]) -> pa.RecordBatch:
    a, b = np.array(v1, dtype=np.int64), np.array(v2, dtype=np.int64)
    pairs = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))]
    return pa.RecordBatch.from_arrays(pairs, names=["a", "b"])


def _near_pairs(percent: int, turn: int):
    """Of the pairs of two blocks that may be linked, so many that they connect what all of them connect.

    Each row goes to one class of every component that it may join, in an order that depends on ``turn``. So two
    blocks give fewer pairs than they have rows, however many of them are alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(*batch.columns, strict=True):
                met = _met(one, two, percent)
                left, right = [], []
                for i in range(len(met.v1)):
                    at = met.near(i)
                    if not len(at):
                        continue
                    at = at[np.argsort(mix(met.v2[at].astype(np.uint64) ^ mix(met.v1[i : i + 1].astype(np.uint64)), turn))]
                    for j in at[np.unique(met.part2[at], return_index=True)[1]]:
                        left.append(met.v1[i])
                        right.append(met.v2[j])
                        met.join(i, j)
                yield _pair_batch(left, right)

    return run


def _near_classes(percent: int):
    """Classes of two blocks that may be linked with one of another component, with their signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sig, one, two in zip(*batch.columns, strict=True):
                met = _met(one, two, percent)
                first, second = np.zeros(len(met.v1), dtype=bool), np.zeros(len(met.v2), dtype=bool)
                for i in range(len(met.v1)):
                    at = met.near(i)
                    first[i] |= len(at) > 0
                    second[at] = True
                found = pa.array(np.unique(np.concatenate((met.v1[first], met.v2[second]))))
                yield pa.RecordBatch.from_arrays([pa.repeat(sig, len(found)), found], names=["sig", "v"])

    return run


def _linked_pairs(percent: int):
    """Of the pairs of two blocks that are linked, by their whole sets, so many that they connect what all connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(*batch.columns, strict=True):
                met = _met(one, two, percent)
                sets1, sets2 = (c.field("shingles") for c in (one.values, two.values if two.is_valid else one.values))
                left, right = [], []
                for i in range(len(met.v1)):
                    own = sets1[i].values.to_numpy()
                    for j in met.near(i):
                        if met.part1[i] == met.part2[j]:
                            continue
                        common = len(np.intersect1d(own, sets2[j].values.to_numpy(), assume_unique=True))
                        if 100 * common >= percent * (met.n1[i] + met.n2[j] - common):
                            left.append(met.v1[i])
                            right.append(met.v2[j])
                            met.join(i, j)
                yield _pair_batch(left, right)

    return run


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Everything that is run inside hands rows to Python in small batches; Spark's own may hold thousands of blocks."""
    wanted = {"maxRecordsPerBatch": ROWS, "maxBytesPerBatch": BATCH_BYTES}
    before = {f"spark.sql.execution.arrow.{k}": spark.conf.get(f"spark.sql.execution.arrow.{k}") for k in wanted}
    try:
        for name, value in zip(before, wanted.values(), strict=True):
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class JaccardJoin:
    """Links and components of documents by word-shingle similarity.

    * ``words``: words in a shingle; a shorter text is one shingle. ``percent``: least similarity.
    * A text without words has an empty set and is linked with nothing, not even its like.
    * Rows with equal sets are one class. A row with a null id gets its set size but no component.
    * Repeated ids keep a row each, and each row is judged by its own text.
    * An empty table gives an empty result.
    """

    def __init__(self, words: int = 5, percent: int = 80) -> None:
        if words < 1 or not 1 <= percent <= 100:
            raise ValueError("words must be positive and percent between 1 and 100")
        self.words, self.bands, self.percent = words, Bands(percent), percent

    def run(self, df: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
        """Rows ``id, n_shingles, component_id, text_hash``, and the verified links ``a, b`` that join the classes.

        ``a`` and ``b`` are the smallest ids of two classes. Links within a component that others already span are
        not among them.
        """
        with _small_batches(df.sparkSession):
            rows, links, classes = self._run(df, id, text)
        name = lambda v: classes.select(F.col("v").alias(v), F.col("id").alias(f"id_{v}"))
        named = links.join(name("a"), "a").join(name("b"), "b")
        return rows.drop("root"), named.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))

    def _run(self, df: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows with the class that names their component (``root``, null without words), links of classes, and the
        classes: ``k1, k2`` name a set, ``v`` is its number, ``id`` its smallest id."""
        docs = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
        hashed = docs.withColumn("text_hash", F.xxhash64("text"))
        keyed = stage(_keyed(hashed, "text", self.words).select("id", "text_hash", "set.*"), "shingle-keys")
        sets = keyed.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("k1", "k2")
        numbered = sets.agg(F.min("id").alias("id"), F.first("n").alias("n"))
        # Written before it is used, so every reader sees the same numbers.
        classes = stage(numbered.withColumn("v", F.monotonically_increasing_id()), "classes")
        hits = self._hits(docs, classes)
        with self._hit_sets(docs, hits, classes) as hit_sets:
            links, roots = self._links(hits, hit_sets)
        labelled = classes.join(roots, "v", "left").select("k1", "k2", "id", F.coalesce("root", "v").alias("root"))
        smallest = labelled.groupBy("root").agg(F.min("id").alias("component_id"))
        named = labelled.drop("id").join(smallest, "root")
        rows = keyed.join(named, ["k1", "k2"], "left").select(
            F.col("id").alias(id),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component_id")))
            .otherwise(F.col("id"))
            .alias("component_id"),
            "text_hash",
            F.when(F.col("id").isNotNull(), F.col("root")).alias("root"),
        )
        return rows, links, classes

    def one_of_each(self, df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """``df`` with one row of each component: the smallest id, and of its texts the one with the smallest hash.

        Rows with a null id all stay, and so do texts without words (but only one row of an id and text).
        """
        with _small_batches(df.sparkSession):
            rows, _, _ = self._run(df, id, text)
        worded = rows.where(F.col("root").isNotNull()).groupBy("root")
        best = worded.agg(F.min(F.struct(F.col(id).alias("id"), F.col("text_hash").alias("hash"))).alias("best")).select("best.*")
        wordless = rows.where((F.col("n_shingles") == 0) & F.col(id).isNotNull())
        kept = best.union(wordless.select(id, "text_hash").distinct())
        kept_id, kept_hash, copy = free_name(df, "kept_id", "kept_hash", "copy")
        best = kept.toDF(kept_id, kept_hash)
        hashed = df.where(F.col(id).isNotNull()).withColumn(kept_hash, F.xxhash64(text))
        once = hashed.withColumn(copy, F.row_number().over(Window.partitionBy(id, kept_hash).orderBy(F.lit(0))))
        first = once.where(F.col(copy) == 1).withColumn(kept_id, F.col(id))
        same = (first[kept_id] == best[kept_id]) & first[kept_hash].eqNullSafe(best[kept_hash])
        return first.join(best, same, "left_semi").select(*df.columns).union(df.where(F.col(id).isNull()))

    def _hits(self, docs: DataFrame, classes: DataFrame) -> DataFrame:
        """``sig, v, n`` of all signatures that more than one class has."""
        bucket = Window.partitionBy("sig")
        named = docs.where(F.col("id").isNotNull())
        shared = (
            _signed(named, "text", self.words, self.bands, _frequent(named, self.words))
            .withColumn("low", F.min("k1").over(bucket))
            .withColumn("high", F.max("k1").over(bucket))
            .where("low != high")
            .select("sig", "k1")
            .distinct()
        )
        return stage(shared.join(classes.select("k1", "v", "n"), "k1").select("sig", "v", "n"), "shared-signatures")

    @contextmanager
    def _hit_sets(self, docs: DataFrame, hits: DataFrame, classes: DataFrame) -> Iterator[DataFrame]:
        """``v, n, shingles, sketch`` of every class with a shared signature, in a table bucketed by class: the rounds
        join it as it lies. The table is only a name for files in the shared folder and goes at the end."""
        spark = docs.sparkSession
        wanted = stage(hits.select("v").distinct().join(classes, "v").select("v", "id", "k1", "k2"), "wanted")
        # An id may come with other texts than the one of this class.
        own = _described(_may_be_wanted(docs, wanted).join(wanted, "id"), self.words)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        copy = F.row_number().over(Window.partitionBy("v").orderBy(F.lit(0)))
        once = own.repartition(buckets, "v").withColumn("copy", copy).where("copy = 1").drop("copy")
        path = scratch_dir(spark, "shingle-sets")
        name = "shingle_sets_" + path[-32:]
        once.write.bucketBy(buckets, "v").sortBy("v").option("path", path).saveAsTable(name)
        try:
            yield spark.table(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _links(self, hits: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links that span the components, and the components of all classes that have a link."""
        links = tried = roots = None
        last = PIVOT_ROUNDS + SPANNING_ROUNDS
        for turn in range(last + 1):
            labelled = hits.withColumn("label", F.col("v"))
            if roots is not None:
                labelled = hits.join(roots, "v", "left").withColumn("label", F.coalesce("root", "v"))
            if turn < PIVOT_ROUNDS:
                pairs = self._pivoted(labelled, turn)
            elif turn < last:
                pairs = self._spanning(labelled, sets, turn, plain=turn == PIVOT_ROUNDS)
            else:
                pairs = self._exact(labelled, sets)
            if tried is not None and turn < last:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = stage(pairs, "pairs")
            if pairs.isEmpty():
                if links is None:
                    links = pairs
                continue
            tried = pairs if tried is None else tried.union(pairs)
            new = stage(self._verified(pairs, sets), "links")
            links = new if links is None else links.union(new)
            if not new.isEmpty():
                roots = components(new, roots)
        return links, components(links) if roots is None else roots

    def _may_link(self) -> Column:
        """In different components, and of sizes that allow a link."""
        sizes = 100 * F.least("n1", "n2") >= self.percent * F.greatest("n1", "n2")
        return (F.col("label1") != F.col("label2")) & sizes

    def _pivoted(self, labelled: DataFrame, turn: int) -> DataFrame:
        """Every class with one pivot: of the first classes of its signatures (by id or, later, by a hash), the one
        that it shares most signatures with."""
        first = F.col("v") if turn == 0 else F.xxhash64("sig", "v", F.lit(turn))
        order = Window.partitionBy("sig").orderBy(first, "v")
        met = labelled.withColumn("pivot", F.first(F.struct("v", "n", "label")).over(order)).selectExpr(
            "v v1", "n n1", "label label1", "pivot.v v2", "pivot.n n2", "pivot.label label2"
        )
        shared = met.where(self._may_link()).groupBy("v1", "v2").agg(F.count("*").alias("c"))
        best = shared.groupBy("v1").agg(F.max(F.struct("c", -F.col("v2"))).alias("best"))
        other = -F.col("best.col2")
        return best.select(F.least("v1", other).alias("a"), F.greatest("v1", other).alias("b")).distinct()

    def _open(self, labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``sig, v, n, label, m`` of the signatures whose classes are still in different components, those of few
        classes (``m``) and those of many."""
        bucket = Window.partitionBy("sig")
        open_ = (
            labelled.withColumn("low", F.min("label").over(bucket))
            .withColumn("high", F.max("label").over(bucket))
            .withColumn("m", F.count("*").over(bucket))
            .where("low != high")
        )
        open_ = stage(open_.select("sig", "v", "n", "label", "m"), "open-signatures")
        return open_.where(F.col("m") <= FEW), open_.where(F.col("m") > FEW)

    def _blocks(self, many: DataFrame, blocks: Column, sets: DataFrame, *columns: str) -> DataFrame:
        """Each block of a signature with itself, and every two blocks: ``sig, rows1, rows2``; the latter is null where
        a block meets itself, so a signature of one block, as most are, is not shuffled again."""
        kept = F.struct("v", "n", "label", "sketch", *columns)
        dealt = many.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")))

        def gathered(some: DataFrame) -> DataFrame:
            described = some.join(sets.select("v", "sketch", *columns), "v")
            return described.groupBy("sig", "block").agg(F.collect_list(kept).alias("rows"))

        alone = gathered(dealt)
        alone = alone.select("sig", F.col("rows").alias("rows1"), F.lit(None).cast(alone.schema["rows"].dataType).alias("rows2"))
        rows = gathered(dealt.where(F.col("blocks") > 1))
        first = rows.selectExpr("sig", "block block1", "rows rows1")
        second = rows.selectExpr("sig", "block block2", "rows rows2")
        return alone.union(first.join(second, "sig").where("block1 < block2").select("sig", "rows1", "rows2"))

    def _spanning(self, labelled: DataFrame, sets: DataFrame, turn: int, plain: bool) -> DataFrame:
        """Pairs of classes that may be linked and connect all that may be, by signature and block; of signatures of
        few classes all pairs, if they are wanted."""
        few, many = self._open(labelled)
        met = self._blocks(many, F.ceil(F.col("m") / BLOCK), sets).drop("sig")
        near = met.mapInArrow(_near_pairs(self.percent, turn), "a long, b long")
        if plain:
            one = few.selectExpr("sig", "v v1", "n n1", "label label1")
            two = few.selectExpr("sig", "v v2", "n n2", "label label2")
            met = one.join(two, "sig").where("v1 < v2").where(self._may_link())
            near = met.selectExpr("v1 a", "v2 b").union(near)
        return near.distinct()

    def _exact(self, labelled: DataFrame, sets: DataFrame) -> DataFrame:
        """Links that connect all that is linked and not yet in one component, found on whole sets.

        Signatures of few classes were compared to the end before. Of the others only classes that may be linked
        with one of another component bring their sets, in blocks of bounded size.
        """
        _, many = self._open(labelled)
        met = self._blocks(many, F.ceil(F.col("m") / BLOCK), sets)
        able = stage(met.mapInArrow(_near_classes(self.percent), "sig long, v long").distinct(), "near-classes")
        bucket = Window.partitionBy("sig")
        sized = many.join(able, ["sig", "v"]).withColumn("m", F.count("*").over(bucket)).withColumn("total", F.sum("n").over(bucket))
        sized = stage(sized, "near-sizes")
        wide = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))
        met = self._blocks(sized, wide, sets, "shingles").drop("sig")
        return met.mapInArrow(_linked_pairs(self.percent), "a long, b long").distinct()

    def _verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs that are linked. Whole sets are fetched only for pairs whose sketches, a 32nd as large, allow it."""
        near = _near(self.percent)
        part = lambda v, *columns: sets.select(F.col("v").alias(v), *(F.col(c).alias(f"{c}_{v}") for c in columns))
        sketched = pairs.join(part("a", "sketch", "n"), "a").join(part("b", "sketch", "n"), "b")
        maybe = stage(sketched.where(near("sketch_a", "sketch_b", "n_a", "n_b")).select("a", "b"), "candidates")
        both = maybe.join(part("a", "shingles"), "a").join(part("b", "shingles"), "b")
        common = F.size(F.array_intersect("shingles_a", "shingles_b"))
        union = F.size("shingles_a") + F.size("shingles_b") - common
        return both.where(100 * common >= self.percent * union).select("a", "b").distinct()
