"""Near-duplicate vectors by an exact metric range join.

On the unit sphere a cosine of c or more is a Euclidean distance of
``sqrt(2 - 2c)`` or less, so the join looks for all pairs within that radius r:

* pivots partition the vectors; each goes to the cell of its nearest pivot, and
  a cell is cut by distance from the pivot into rings (a ring of very many
  vectors into blocks by hash);
* the triangle inequality says which blocks a vector can have a partner in.  It
  must be within r of a ring's distances from its pivot, and within r of the
  plane that parts its own cell from the other one.  It is replicated there and
  nowhere else; of two blocks one is the place where their vectors meet;
* every block is joined by itself: its own vectors are held, the others stream
  past.  Products of single precision find candidates, double precision decides.

The innermost ring reaches to r / 2, so all its vectors are within r of each
other without a comparison.  Pivots are put into dense places first, so a large
group of near copies falls into such a ring and costs no pairs.  Equal vectors
are one class with a count from the start.  What leaves a task is a vector's
number of links and one edge of a spanning forest, never pairs.

Pivots come from a bounded sample (``SAMPLE`` vectors, first by hash); which
they are changes the time, never the result.  Where the data have no structure
at this radius (random directions), no pivot prunes and every block meets every
other: the exact join is quadratic then, in blocks.

Defined cases: a vector that is null, empty or zero, or holds a null or a
component that is not finite, links with nothing and is its own component; so
does one of another length than most.  Rows that repeat an id are vectors of
their own; ``component_id`` is the least id of a component that is not null, and
null where there is none; columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.common import stage
from ledgerflow.llm.components import components

COSINE = 0.9
#: Vectors that pivots are chosen from.
SAMPLE = 2048
#: Vectors in a cell on average that the number of pivots aims at; most pivots.
CELL_ROWS = 4096
MOST_PIVOTS = 1024
#: Vectors that one task holds at a time; larger rings are cut by hash.
BLOCK_ROWS = 8192
#: Products looked at in one numpy step.
STEP_PAIRS = 1 << 20
#: Distances may be wrong by so much: bounds are wider, and the inner ring smaller.
SLACK = 1e-6
#: Single precision may be wrong by so much.
COARSE = 1e-4


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of an Arrow list column, as doubles, one per row."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows))


def unit(rows: np.ndarray) -> np.ndarray:
    """Directions; large and small components are scaled first, so squares stay finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / norms(rows)[:, None]


def distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = 1 + (pivots**2).sum(axis=1) - 2 * units @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, wanted: int, radius: float, rounds: int = 5) -> np.ndarray:
    """Pivots from unit vectors: the middles of dense balls of half the radius,
    then centroids of the rest."""
    sample = np.unique(sample, axis=0)
    close = distances(sample, sample) <= radius / 2 - SLACK
    left, pivots = np.ones(len(sample), bool), []
    while len(pivots) < 64:
        counts = close[:, left].sum(axis=1)
        best = int(np.argmax(counts))
        if counts[best] < max(4, len(sample) // 100):
            break
        pivots.append(sample[best])
        left &= ~close[best]
    rest = sample[left]
    centres = rest[:max(wanted - len(pivots), 1)].copy()
    for _ in range(rounds if len(rest) > len(centres) else 0):
        near = distances(rest, centres).argmin(axis=1)
        for k in range(len(centres)):
            if (near == k).any():
                centres[k] = rest[near == k].mean(axis=0)
    return np.unique(np.concatenate([np.array(pivots).reshape(-1, sample.shape[1]), centres]), axis=0)


def ring_of(distance: np.ndarray, radius: float) -> np.ndarray:
    """0 within half the radius, then steps of that width."""
    half = radius / 2 - SLACK
    return np.where(distance <= half, 0, 1 + np.floor((distance - half) / half)).astype(np.int32)


@dataclass(frozen=True)
class Layout:
    """Pivots, and the rings that hold vectors: ``first`` is the number of a
    ring's first block, of which it has ``blocks``."""

    pivots: np.ndarray
    radius: float
    cell: np.ndarray
    ring: np.ndarray
    low: np.ndarray
    high: np.ndarray
    blocks: np.ndarray

    def __post_init__(self):
        object.__setattr__(self, "first", np.cumsum(self.blocks) - self.blocks)
        object.__setattr__(self, "apart", np.sqrt(((self.pivots[:, None, :] - self.pivots) ** 2).sum(axis=2)))

    def reaches(self, units: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Which rings (columns) can hold a partner of which vector of ``cell``."""
        away, reach = distances(units, self.pivots), self.radius + SLACK
        own = away[np.arange(len(away)), cell]
        beyond = away**2 - own[:, None] ** 2 <= 2 * reach * self.apart[cell] + SLACK
        to = away[:, self.cell]
        return beyond[:, self.cell] & (to >= self.low - reach) & (to <= self.high + reach)


def layout(placed: DataFrame, pivots: np.ndarray, radius: float, block_rows: int) -> Layout:
    """The blocks of every ring: at most a few rows a pivot come to the driver."""
    rings = placed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("low"), F.max("away").alias("high")).orderBy("cell", "ring").collect()
    blocks = np.array([-(-r["n"] // block_rows) for r in rings], np.int64)
    columns = {c: np.array([r[c] for r in rings]) for c in ("cell", "ring", "low", "high")}
    return Layout(pivots, radius, columns["cell"], columns["ring"], columns["low"], columns["high"], blocks)


class Forest:
    """Labels of a growing set of nodes; equal labels are connected."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Connect ``a[k]`` with ``b[k]``; a label is its set's least node."""
        while True:
            x, y = self.label[a], self.label[b]
            unlike = x != y
            if not unlike.any():
                return
            a, b, x, y = a[unlike], b[unlike], x[unlike], y[unlike]
            # one link for every label takes part in this round: a number of steps that nodes bound, not links
            picked = np.union1d(np.unique(x, return_index=True)[1], np.unique(y, return_index=True)[1])
            up = {}

            def top(k: int) -> int:
                while k in up:
                    k = up[k]
                return k

            for p, q in zip(x[picked].tolist(), y[picked].tolist()):
                p, q = top(p), top(q)
                if p != q:
                    up[max(p, q)] = min(p, q)
            to = np.arange(len(self.label))
            for k in up:
                to[k] = top(k)
            self.label = to[self.label]


def linked(a: np.ndarray, b: np.ndarray, a_unit: np.ndarray, b_unit: np.ndarray, cosine: float) -> Iterator[tuple[int, np.ndarray]]:
    """Which rows of b have a cosine of ``cosine`` or more with which rows of a:
    the first row of a step, and a boolean matrix with True in it.  Single
    precision (``*_unit``) tells most pairs apart; close ones are decided in double."""
    step = max(1, STEP_PAIRS // max(len(b), 1))
    for at in range(0, len(a), step):
        product = a_unit[at:at + step] @ b_unit.T
        hit = product >= cosine + COARSE
        i, j = np.nonzero((product >= cosine - COARSE) & ~hit)
        for low in range(0, len(i), 1 << 14):
            x, y = i[low:low + (1 << 14)], j[low:low + (1 << 14)]
            u, v = a[at + x], b[y]
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                value = np.einsum("ij,ij->i", u, v) / (norms(u) * norms(v))
            odd = ~np.isfinite(value)
            if odd.any():  # squares out of range
                value[odd] = np.einsum("ij,ij->i", unit(u[odd]), unit(v[odd]))
            hit[x, y] = value >= cosine
        if hit.any():
            yield at, hit


FOUND = "k long, links long, near long"


def block_join(rows: DataFrame, cosine: float) -> DataFrame:
    """``k, links, near`` of classes with links (``block, kind, dense, k, n,
    vector``; kind 0 is held, 1 streams past): vectors linked in this block, and
    another class of the same component (null if it is the block's least)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, own, forest, counts = None, None, None, None

        def opened(dense: bool) -> None:
            nonlocal own, forest, counts
            names, times, vectors = (np.concatenate([h[c] for h in held]) for c in range(3))
            own = (names, times, vectors, unit(vectors).astype(np.float32))
            forest, counts = Forest(len(names)), np.zeros(len(names), np.int64)
            if not dense:
                for at, hit in linked(vectors, vectors, own[3], own[3], cosine):
                    row = np.arange(len(hit))
                    hit[row, row + at] = False
                    counts[at:at + len(hit)] += (hit @ times.astype(np.float64)).astype(np.int64)
                    i, j = np.nonzero(hit)
                    forest.join(i + at, j)

        def past(names: np.ndarray, times: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch | None:
            n, seen = len(own[0]), np.zeros(len(names), np.int64)
            forest.label = np.concatenate([forest.label, np.arange(n, n + len(names))])
            for at, hit in linked(own[2], vectors, own[3], unit(vectors).astype(np.float32), cosine):
                counts[at:at + len(hit)] += (hit @ times.astype(np.float64)).astype(np.int64)
                seen += (own[1][at:at + len(hit)].astype(np.float64) @ hit).astype(np.int64)
                i, j = np.nonzero(hit)
                forest.join(i + at, j + n)
            to, forest.label = forest.label[n:], forest.label[:n]
            some = np.flatnonzero(seen)
            return out(names[some], seen[some], own[0][to[some]]) if len(some) else None

        def out(names: np.ndarray, links: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(links), pa.array(near)], ["k", "links", "near"])

        def closed() -> pa.RecordBatch | None:
            some = np.flatnonzero(counts) if counts is not None else []
            return out(own[0][some], counts[some], own[0][forest.label[some]]) if len(some) else None

        for batch in batches:
            if not batch.num_rows:
                continue
            block, kind, dense = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "kind", "dense"))
            names, times, vectors = batch.column("k").to_numpy(), batch.column("n").to_numpy(), matrix(batch.column("vector"))
            cut = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for low, high in zip([0, *cut.tolist()], [*cut.tolist(), len(block)]):
                if block[low] != key:
                    if held and own is None:
                        opened(key_dense)
                    if (last := closed()) is not None:
                        yield last
                    key, key_dense, held, own, forest, counts = block[low], False, [], None, None, None
                part = (names[low:high], times[low:high], vectors[low:high])
                if kind[low] == 0:
                    key_dense = bool(dense[low])
                    held.append(part)
                elif held:
                    if own is None:
                        opened(key_dense)
                    if (found := past(*part)) is not None:
                        yield found
        if held and own is None:
            opened(key_dense)
        if (last := closed()) is not None:
            yield last

    return rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(common.lean(task), FOUND)


def replicated(placed: DataFrame, blocks: Layout) -> DataFrame:
    """Every class in its own block (kind 0) and in all blocks that can hold a
    partner and are the meeting place of the two blocks (kind 1)."""
    shared = placed.sparkSession.sparkContext.broadcast(blocks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lay = shared.value
        index = {(c, r): k for k, (c, r) in enumerate(zip(lay.cell.tolist(), lay.ring.tolist()))}
        ring_at = np.repeat(np.arange(len(lay.cell)), lay.blocks)  # ring of every block
        inner, to = lay.ring[ring_at] == 0, np.arange(len(ring_at))
        step = max(1, (1 << 20) // len(ring_at))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                cell = piece.column("cell").to_numpy()
                mine = np.array([index[x] for x in zip(cell.tolist(), piece.column("ring").to_pylist())])
                own = lay.first[mine] + (piece.column("hash").to_numpy().view(np.uint64) % lay.blocks[mine].astype(np.uint64)).astype(np.int64)
                # of two blocks the lower one is the meeting place if the sum of their numbers is even
                meets = ((own[:, None] + to) % 2 == 0) == (to < own[:, None])
                known = inner & (ring_at == mine[:, None])  # linked without a comparison
                row, block = np.nonzero(lay.reaches(unit(matrix(piece.column("vector"))), cell)[:, ring_at] & meets & (to != own[:, None]) & ~known)
                kind = np.concatenate([np.zeros(len(piece), np.int8), np.ones(len(row), np.int8)])
                row, block = np.concatenate([np.arange(len(piece)), row]), np.concatenate([own, block])
                for low in range(0, len(row), 4096):  # batches of bounded size, however far the vectors reach
                    part = slice(low, low + 4096)
                    taken = piece.select(["k", "n", "vector"]).take(pa.array(row[part]))
                    yield pa.RecordBatch.from_arrays([pa.array(block[part]), pa.array(kind[part]), pa.array(inner[block[part]]), *taken.columns], ["block", "kind", "dense", "k", "n", "vector"])

    kinds = f"block long, kind byte, dense boolean, k long, n long, vector {placed.schema['vector'].dataType.simpleString()}"
    return placed.withColumn("hash", F.xxhash64("k")).mapInArrow(common.lean(task), kinds)


def vector_classes(rows: DataFrame) -> DataFrame:
    """``k, vector, n, least`` of the distinct vectors that can be compared:
    a number, how many rows hold it, and their least id."""
    sound = F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0), F.lit(False))
    classes = rows.where(sound).groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = stage(classes.withColumn("k", F.monotonically_increasing_id()), "metric-classes")
    usual = classes.groupBy(F.size("vector").alias("d")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return classes.where(F.size("vector") == (usual[0]["d"] if usual else 0))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE) -> DataFrame:
    """One row per vector: ``vec_id, n_links`` (other vectors linked directly),
    ``component_id`` (least id reachable by links) and ``kept``."""
    radius = float(np.sqrt(2 - 2 * cosine))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    classes = vector_classes(rows)
    sample = classes.orderBy(F.xxhash64("vector"), "k").limit(sample_rows).select("vector").collect()
    lone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not sample:
        return lone
    pivots = choose_pivots(unit(np.array([r["vector"] for r in sample], np.float64)), min(-(-classes.count() // cell_rows), MOST_PIVOTS), radius)
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def placing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                away = distances(unit(matrix(piece.column("vector"))), shared.value)
                cell = away.argmin(axis=1)
                own = away[np.arange(len(away)), cell]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("k", "n", "vector")), pa.array(cell.astype(np.int32)), pa.array(ring_of(own, radius)), pa.array(own)], ["k", "n", "vector", "cell", "ring", "away"])

    # placed once: products of another batch may round otherwise, and the ring must not change
    placed = stage(classes.select("k", "n", "vector").mapInArrow(common.lean(placing), f"k long, n long, vector {classes.schema['vector'].dataType.simpleString()}, cell int, ring int, away double"), "metric-placed")
    blocks = layout(placed, pivots, radius, block_rows)
    found = stage(block_join(replicated(placed, blocks), cosine), "metric-links")

    # all of an inner ring are linked: its size and one member stand for its pairs (one row a pivot at most)
    inner = placed.where("ring = 0")
    cores = inner.groupBy("cell").agg(F.sum("n").alias("all"), F.min("k").alias("near"))
    inner = inner.join(F.broadcast(cores), "cell").select("k", (F.col("all") - F.col("n")).alias("links"), "near")
    found = found.unionByName(inner)
    joined = components(found.where("near <> k"), "k", "near", "metric").withColumnRenamed("node", "k")
    links = found.groupBy("k").agg(F.sum("links").alias("links"))
    every = stage(classes.join(links, "k", "left").join(joined, "k", "left").select("vector", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "k").alias("component")), "metric-classes-found")
    ids = every.groupBy("component").agg(F.min("least").alias("component_id"))
    known = every.join(ids, "component").select("vector", "n_links", "component_id", F.lit(True).alias("sound"))
    out = rows.join(known, "vector", "left").withColumn("component_id", F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id")))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id", kept.alias("kept"))
