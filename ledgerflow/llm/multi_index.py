"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut in halves and each half is quantised by its own k-means, so K
centroids a half make K * K cells.  A query meets the cells in the order of the
summed distance of their two centroids, which a heap walks without sorting all
pairs, until the cells met hold enough vectors; those are reranked by the exact
distance.

How many are enough is measured, not guessed: a sample of rows is searched by
brute force against all rows, and the number of vectors met before a true
neighbour's cell is read off for each; ``RECALL`` of them set the number.  Data
with structure need few, random vectors many.

The index is fitted on a bounded sample (``SAMPLE`` rows, first by hash) and
holds every row.  Entries and probes of a cell meet in one task, and a cell of
many vectors is split by hash of their ids, so no cell is one task's burden.

Defined cases: a vector that is null, zero, of another length than most, or
that holds a null or a component that is not finite takes no part; ties go to
the smaller id; rows that repeat an id count once, by their least vector; with fewer
than k candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.common import stage

#: Rows that the centroids are fitted on.
SAMPLE = 20_000
#: Vectors in a cell on average that the number of centroids aims at.
CELL_ROWS = 50
MOST_CENTROIDS = 1024
ROUNDS = 12
#: Rows searched by brute force to learn how far to probe, and the share of
#: their true neighbours that must be met.
CALIBRATION = 200
RECALL = 0.97
#: Vectors of a cell that one task compares at a time.
BUCKET_ROWS = 4096


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` (array of doubles) of the rows that take part, one per
    id: of several rows the one with the least vector."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(sound, F.lit(False)))
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    rows = rows.where(F.size("vector") == (usual[0]["d"] if usual else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmin((centres**2).sum(1) - 2 * rows[k:k + 4096] @ centres.T, axis=1) for k in range(0, len(rows), 4096)]) if len(rows) else np.zeros(0, np.int64)


def kmeans(rows: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Lloyd's rounds from k distinct rows; an empty cluster keeps its centre."""
    centres = rows[np.random.default_rng(seed).choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(rows, centres)
        counts = np.bincount(at, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, rows)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centres


@dataclass(frozen=True)
class Index:
    """Centroids of both halves, vectors per cell, and how many to meet."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    enough: int

    def cells(self, rows: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return _nearest(rows[:, :half], self.first) * len(self.second) + _nearest(rows[:, half:], self.second)

    def distances(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of a query's halves to the centroids."""
        half = self.first.shape[1]
        return ((self.first - query[:half]) ** 2).sum(1), ((self.second - query[half:]) ** 2).sum(1)

    def probe(self, query: np.ndarray) -> list[int]:
        """Cells with vectors, nearest sum first, until they hold ``enough``."""
        d1, d2 = self.distances(query)
        o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
        s1, s2, counts, width = d1[o1].tolist(), d2[o2].tolist(), self.counts, len(o2)
        heap, reach, found, held = [(s1[0] + s2[0], 0, 0)], [0] * len(o1), [], 0
        reach[0] = 1  # pairs (i, 0 .. reach[i] - 1) have been put on the heap
        while heap and held < self.enough:
            _, i, j = heapq.heappop(heap)
            cell = o1[i] * width + o2[j]
            if counts[cell]:
                found.append(cell)
                held += int(counts[cell])
            # (i, j + 1) waits for (i - 1, j + 1), (i + 1, j) for (i + 1, j - 1)
            if j + 1 < width and reach[i] == j + 1 and (i == 0 or reach[i - 1] > j + 1):
                reach[i] = j + 2
                heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
            if i + 1 < len(o1) and reach[i + 1] == j:
                reach[i + 1] = j + 1
                heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
        return found


def _with_cells(rows: DataFrame, index: Index) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = shared.value.cells(_matrix(batch.column("vector"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(cell, pa.int64())], ["vec_id", "vector", "cell"])

    return rows.mapInArrow(common.lean(task), "vec_id long, vector array<double>, cell long")


def _best(distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least distances, ties by id."""
    if len(distance) > k:
        near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    else:
        near = np.arange(len(distance))
    return near[np.lexsort((ids[near], distance[near]))[:k]]


def _all_distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((rows - q) ** 2).sum(axis=1)) for q in queries])


def build(rows: DataFrame, k: int = 10, recall: float = RECALL, cell_rows: int = CELL_ROWS) -> tuple[Index, DataFrame] | None:
    """Fit, fill and calibrate an index of usable vectors; it and the rows with
    their cells.  The driver holds the sample, the centroids and one count per
    cell, all of fixed bounds."""
    n = rows.count()
    if not n:
        return None
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sample = np.array([r["vector"] for r in drawn], np.float64)
    half = max(1, sample.shape[1] // 2)
    centroids = int(min(max(1, round((n / cell_rows) ** 0.5)), MOST_CENTROIDS, len(sample)))
    first, second = kmeans(sample[:, :half], centroids), kmeans(sample[:, half:], centroids)
    index = Index(first, second, np.zeros(centroids * centroids, np.int64), 0)
    placed = stage(_with_cells(rows, index), "multi-index")
    for r in placed.groupBy("cell").count().collect():
        index.counts[r["cell"]] = r["count"]
    asked = {r["vec_id"]: np.array(r["vector"]) for r in drawn[:CALIBRATION]}
    return Index(first, second, index.counts, _enough(placed, index, asked, k, recall)), placed


def _enough(placed: DataFrame, index: Index, asked: dict[int, np.ndarray], k: int, recall: float) -> int:
    """Vectors to meet so that ``recall`` of the asked rows' true neighbours are
    among them, by brute force over all rows (each task keeps k per asked row)."""
    names, queries = list(asked), np.stack(list(asked.values()))
    shared = placed.sparkSession.sparkContext.broadcast((names, queries))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = shared.value
        best: list[list[tuple[float, int, int]]] = [[] for _ in names]
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                ids, cells = part.column("vec_id").to_numpy(), part.column("cell").to_numpy()
                for q, distance in enumerate(_all_distances(queries, _matrix(part.column("vector")))):
                    distance = np.where(ids == names[q], np.inf, distance)
                    near = _best(distance, ids, k)
                    best[q] = sorted(best[q] + [(float(distance[j]), int(ids[j]), int(cells[j])) for j in near if np.isfinite(distance[j])])[:k]
        found = [(q, *b) for q, own in enumerate(best) for b in own]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64())], ["q", "score", "vec_id", "cell"])

    near = placed.mapInArrow(common.lean(task), "q int, score double, vec_id long, cell long")
    near = near.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id", "cell"))), 1, k).alias("near")).collect()
    needed = []
    for r in near:
        d1, d2 = index.distances(queries[r["q"]])
        sums = (d1[:, None] + d2[None, :]).reshape(-1)
        for x in r["near"]:
            needed.append(int(index.counts[sums <= sums[x["cell"]]].sum()))
    if not needed:
        return int(index.counts.sum())
    needed.sort()
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]


def search(placed: DataFrame, index: Index, queries: DataFrame, k: int = 10, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest rows found for each
    query (usable vectors as ``vec_id, vector``)."""
    shared = placed.sparkSession.sparkContext.broadcast(index)

    def buckets(counts: np.ndarray, cell: int) -> int:
        return -(-int(counts[cell]) // bucket_rows)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows = _matrix(batch.column("vector"))
            for j, name in enumerate(batch.column("vec_id").to_pylist()):
                met = [(cell, b) for cell in index.probe(rows[j]) for b in range(buckets(index.counts, cell))]
                at = pa.array(np.full(len(met), j))
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in met], pa.int64()), pa.array([b for _, b in met], pa.int32()), pa.array(np.full(len(met), 1, np.int8)), pa.array(np.full(len(met), name, np.int64)), batch.column("vector").take(at)], ["cell", "bucket", "kind", "vec_id", "vector"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value.counts
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            split = np.maximum(-(-counts[cell] // bucket_rows), 1)
            yield pa.RecordBatch.from_arrays([batch.column("cell"), pa.array((batch.column("hash").to_numpy().view(np.uint64) % split.astype(np.uint64)).astype(np.int32)), pa.array(np.zeros(len(cell), np.int8)), batch.column("vec_id"), batch.column("vector")], ["cell", "bucket", "kind", "vec_id", "vector"])

    kinds = "cell long, bucket int, kind byte, vec_id long, vector array<double>"
    both = placed.withColumn("hash", F.xxhash64("vec_id")).mapInArrow(common.lean(entries), kinds).unionByName(queries.select("vec_id", "vector").mapInArrow(common.lean(probes), kinds))

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {}
        key, held_ids, held_rows, ids, rows = None, [], [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, bucket, kind, names = (batch.column(c).to_numpy() for c in ("cell", "bucket", "kind", "vec_id"))
            matrix = _matrix(batch.column("vector"))
            cut = np.flatnonzero((cells[1:] != cells[:-1]) | (bucket[1:] != bucket[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(cells)]):
                if (cells[a], bucket[a]) != key:
                    key, held_ids, held_rows, ids = (cells[a], bucket[a]), [], [], None
                if kind[a] == 0:  # entries come first
                    held_ids.append(names[a:b])
                    held_rows.append(matrix[a:b])
                    ids = None
                    continue
                if not held_ids:
                    continue
                if ids is None:
                    ids, rows = np.concatenate(held_ids), np.concatenate(held_rows)
                for q in range(a, b):
                    distance = np.sqrt(((rows - matrix[q]) ** 2).sum(axis=1))
                    distance[ids == names[q]] = np.inf
                    near = _best(distance, ids, k)
                    own = best.get(int(names[q]), []) + [(float(distance[j]), int(ids[j])) for j in near if np.isfinite(distance[j])]
                    best[int(names[q])] = sorted(own)[:k]
        out = [(q, v, s) for q, own in best.items() for s, v in own]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.float64())], ["query_id", "vec_id", "score"])

    near = both.repartition("cell", "bucket").sortWithinPartitions("cell", "bucket", "kind").mapInArrow(common.lean(rerank), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
