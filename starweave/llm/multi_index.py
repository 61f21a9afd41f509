"""Nearest neighbours by largest inner product with an inverted multi-index.

The two halves of a vector are quantised separately, so ``K`` centroids a half
make ``K * K`` cells. A query walks centroid pairs from the nearest on, by the
sum of their two distances (negative inner products), with a heap, until the
cells visited hold enough vectors; these are reranked by their exact inner
products. How many are enough is measured: on a sample, the least share of the
vectors that finds ``RECALL`` of the true neighbours.

Queries and vectors of a cell meet in blocks of bounded size, so a crowded cell
is many small products. Identical vectors need only their ``k + 1`` smallest
ids, as ties go to these; identical queries are searched once. The nearest cells
are searched first; of the others only vectors that beat what was found there
leave a task, so a query sends out a number of rows that does not depend on the
size of the table or the number of tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.session import stage

#: Vectors the index is fitted on at most, picked by a hash of their id.
SAMPLE = 20_000
CENTROIDS = 16
#: Share of true neighbours that the visited cells hold on the sample; what is left is room for other data.
RECALL = 0.97
#: Sampled queries for that measurement.
TRIALS = 256
#: Share of a query's visited vectors that is searched first, and how many times ``k`` it has at least.
NEAREST_SHARE, NEAREST_TIMES = 1 / 16, 8
#: Vectors, and queries, in a block.
BLOCK = 256


@dataclass(frozen=True)
class MultiIndex:
    """Centroids of both halves, each ``K`` x half the length, and the share of vectors a query visits."""

    first: np.ndarray
    second: np.ndarray
    share: float

    @property
    def size(self) -> int:
        return len(self.first) * len(self.second)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        cut = self.first.shape[1]
        near = [_nearest(v, c) for v, c in ((vectors[:, :cut], self.first), (vectors[:, cut:], self.second))]
        return near[0] * len(self.second) + near[1]

    def visits(self, query: np.ndarray, counts: np.ndarray, enough: float, first: float = 0) -> tuple[list[int], int]:
        """Cells with vectors, nearest first, until they hold ``enough``; and how many hold ``first``."""
        cut = self.first.shape[1]
        one, two = -(self.first @ query[:cut]), -(self.second @ query[cut:])
        by_one, by_two = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        one, two = one[by_one], two[by_two]
        heap, seen, found, held, near = [(one[0] + two[0], 0, 0)], {(0, 0)}, [], 0, 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            cell = int(by_one[i]) * len(two) + int(by_two[j])
            if counts[cell]:
                near += held < first
                found.append(cell)
                held += int(counts[cell])
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(one) and b < len(two) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (one[a] + two[b], a, b))
        return found, near


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1) - 2 * vectors @ centroids.T).argmin(1)


def _centroids(vectors: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    if not vectors.shape[1]:
        return np.zeros((1, 0))
    distinct = np.unique(vectors, axis=0)
    chosen = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(steps):
        near = _nearest(vectors, chosen)
        filled = np.bincount(near, minlength=len(chosen)) > 0
        sums = np.zeros_like(chosen)
        np.add.at(sums, near, vectors)
        chosen[filled] = sums[filled] / np.bincount(near, minlength=len(chosen))[filled][:, None]
    return chosen


def fit(sample: np.ndarray, k: int, centroids: int = CENTROIDS, recall: float = RECALL) -> MultiIndex:
    """An index from a sample of vectors, one per row."""
    cut = sample.shape[1] // 2
    index = MultiIndex(_centroids(sample[:, :cut], centroids), _centroids(sample[:, cut:], centroids), 1.0)
    cells = index.cells(sample)
    counts = np.bincount(cells, minlength=index.size)
    trials = np.linspace(0, len(sample) - 1, min(TRIALS, len(sample))).astype(int)
    depths = []
    for t in trials:
        scores = sample @ sample[t]
        scores[t] = -np.inf
        best = np.argsort(-scores, kind="stable")[: min(k, len(sample) - 1)]
        order, _ = index.visits(sample[t], counts, len(sample))
        held = np.zeros(index.size, dtype=np.int64)
        held[order] = counts[order].cumsum()
        depths.append(held[cells[best]])
    wanted = np.concatenate(depths)
    share = np.quantile(wanted, recall) / len(sample) if len(wanted) else 1.0
    return MultiIndex(index.first, index.second, float(min(1.0, share)))


def usable(df: DataFrame, id: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that take part: id and vector not null, all components finite, not all zero."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def search(df: DataFrame, is_query: Column, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each query, nearest first, ties to smaller ids.

    * ``is_query`` is a condition on the column ``id`` (the cast id). A query never finds rows of its own id.
    * Null, zero and non-finite vectors take no part; neither do vectors of another length than most have.
    * Repeated ids are separate candidates. With fewer candidates than ``k``, all that the visited cells hold
      are returned; a table of at most ``BLOCK`` vectors is visited whole. An empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = usable(df, id, vector)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    width = lengths[0]["n"] if lengths else 1
    same = Window.partitionBy("v").orderBy("id")
    rows = rows.where(F.size("v") == width)
    few = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy")
    picked = rows.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    if not len(picked):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit(_matrix(picked, width), k)
    shared = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = shared.value.cells(_matrix(batch.column(1), width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], names=["id", "v", "cell"])

    placed = stage(few.mapInArrow(place, "id long, v array<double>, cell long"), "multi-index")
    counts = np.zeros(index.size, dtype=np.int64)
    for row in placed.groupBy("cell").count().collect():  # at most a row for each cell
        counts[row["cell"]] = row["count"]
    enough = float(max(index.share * counts.sum(), min(BLOCK, counts.sum())))
    first = max(enough * NEAREST_SHARE, float(NEAREST_TIMES * (k + 1)))
    filled = spark.sparkContext.broadcast(counts)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(1), width)
            for start in range(0, len(vectors), BLOCK):
                visits = [shared.value.visits(q, filled.value, enough, first) for q in vectors[start : start + BLOCK]]
                taken = pa.array(np.repeat(np.arange(len(visits)) + start, [len(v) for v, _ in visits]))
                cells = pa.array(np.concatenate([np.array(v, dtype=np.int64) for v, _ in visits]))
                near = pa.array(np.concatenate([np.arange(len(v)) < n for v, n in visits]))
                columns = [batch.column(0).take(taken), batch.column(1).take(taken), cells, near]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "cell", "near"])

    asked = rows.where(is_query)
    distinct = stage(asked.groupBy("v").agg(F.min("id").alias("id")).select("id", "v"), "queries")
    walked = distinct.repartition(F.col("id")).mapInArrow(walk, "id long, v array<double>, cell long, near boolean")
    queries = stage(walked, "visits")
    vectors = _blocks(placed, "x", "id", "v")

    def searched(rows: DataFrame) -> DataFrame:
        """The ``k + 1`` best of the vectors in the cells of ``id, v, cell, floor`` that reach the floor."""
        met = _blocks(rows, "q", "id", "v", "floor").join(vectors, "cell").select("q_id", "q_v", "q_floor", "x_id", "x_v")
        return met.mapInArrow(_products(width, k + 1), "asked long, vec_id long, score double")

    def best(rows: DataFrame) -> DataFrame:
        nearest = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
        return rows.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1)

    lowest = F.lit(float("-inf"))
    near = stage(best(searched(queries.where("near").withColumn("floor", lowest))), "nearest-cells").drop("r")
    floors = near.groupBy(F.col("asked").alias("id")).agg(
        F.when(F.count("*") > k, F.min("score")).otherwise(lowest).alias("floor")
    )
    far = searched(queries.where(~F.col("near")).join(floors, "id"))
    top = stage(best(near.union(far)), "nearest")
    named = asked.join(distinct.withColumnRenamed("id", "asked"), "v").select(F.col("id").alias("query_id"), "asked")
    own = Window.partitionBy("query_id").orderBy("r")
    return (
        named.distinct()
        .join(top, "asked")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _blocks(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """Rows of a cell packed into one row for about ``BLOCK`` of them; vectors are laid end to end."""
    sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = rows.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    packed = dealt.groupBy("cell", "block").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    field = lambda c: F.flatten("rows.v") if c == "v" else F.col(f"rows.{c}")
    return packed.select("cell", *(field(c).alias(f"{name}_{c}") for c in columns))


def _products(width: int, k: int):
    """Exact inner products of block pairs; of each query and block the ``k`` largest that reach the query's floor,
    unless the task has ``k`` better."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                q_id, floors, x_id = (batch.column(c)[i].values.to_numpy() for c in (0, 2, 3))
                q, x = (batch.column(c)[i].values.to_numpy().reshape(-1, width) for c in (1, 4))
                order = np.argsort(x_id, kind="stable")
                x_id, x = x_id[order], x[order]
                rough = q @ x.T
                # A block product's last bits depend on the block: it only chooses what is summed in one fixed order.
                slack = 1e-10 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max(initial=0.0)
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for j, (query, floor) in enumerate(zip(q_id.tolist(), floors.tolist(), strict=True)):
                    row, loose, old = rough[j], slack[j], kept.get(query)
                    least = floor if old is None or len(old) < k else max(floor, old[0])
                    at = np.flatnonzero(row >= least - loose)
                    if len(at) > k:
                        at = at[row[at] >= np.partition(row[at], -k)[-k] - 2 * loose]
                    if len(at):
                        exact = (q[j] * x[at]).sum(axis=1)
                        first = np.argsort(-exact, kind="stable")[:k]  # equal scores by id
                        first = first[exact[first] >= least]
                        at, exact = at[first], exact[first]
                    if len(at):
                        both = exact if old is None else np.concatenate((old, exact))
                        kept[query] = np.sort(both)[-k:]
                        out.append((np.full(len(at), query), x_id[at], exact))
                if len(kept) > 1 << 17:
                    kept.clear()
                if out:
                    columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["asked", "vec_id", "score"])

    return run
