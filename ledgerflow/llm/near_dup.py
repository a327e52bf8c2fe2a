"""MinHash near-duplicates by an inverted join on signature coordinates.

A document's shingle set gets a signature of ``COORDINATES`` minima.  Each
coordinate and value is a posting list.  Two sets with a Jaccard similarity of
``JACCARD`` agree in at least ``MATCHES`` coordinates, but for a chance of about
1 in 100,000 at the very threshold, and the join looks for exactly that:

* lists with one member are skipped, and so is a document that is left with
  fewer than ``MATCHES`` postings: it cannot reach the count;
* of c postings, the c - MATCHES + 1 on the shortest lists form a document's
  prefix; documents that share ``MATCHES`` postings share one in their prefixes;
* prefixes that touch form a bundle.  A bundle's documents meet in one task
  (large bundles: in blocks), where collisions are counted on whole signatures
  and every pair above the threshold that is not connected yet is confirmed on
  the full sets.

Equal sets collapse to one class before anything is posted, so copies cost one
row each.  Of a large bundle every block first meets the bundle's most central
members; only what stays outside the main component is then compared with all
of the bundle, block by block.  No pair leaves a task but confirmed links, of
which a task emits fewer than it has documents.

Defined cases: a null, empty or blank text has no shingles and is linked with
nothing; a text of fewer words than a shingle is one shingle; rows that repeat a
document id count as one document wherever their texts are linked, and each
row keeps its own count; columns not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.common import stage
from ledgerflow.llm.components import components
from ledgerflow.llm.shingles import shingle_sets, signatures

SHINGLE = 5
#: Similarity from which documents are linked: intersection / union, in percent.
PERCENT = 75
COORDINATES = 64
MATCHES = 32
#: Documents and text bytes of a block; a bundle beyond either has several.
BLOCK_DOCS = 512
BLOCK_BYTES = 16 << 20
#: Members that every block of a large bundle meets first.
HUBS = 8


def signature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, digest`` (of the set; null if empty), ``signature``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "raw"):
            hashes, bounds = shingle_sets(piece.column("raw"), size)
            rows = signatures(hashes, bounds, COORDINATES).astype(np.int32)
            counts = np.diff(bounds)
            digests = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(bounds[:-1], bounds[1:])]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * COORDINATES, pa.int32()), pa.array(rows.reshape(-1)))
            yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), lists], ["doc_id", "n_shingles", "digest", "signature"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("raw"))
    return rows.mapInArrow(common.lean(task), "doc_id long, n_shingles long, digest binary, signature array<int>")


def _listed(postings: DataFrame, matches: int) -> DataFrame:
    """``cid, posts`` (array of list length, token) of every document that has
    ``matches`` postings or more on lists of two or more."""
    lengths = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = postings.join(lengths, "token")
    return kept.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("posts")).where(F.size("posts") >= matches)


def prefixes(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """``cid, central, prefix``: tokens of the prefix, and the sum of a
    document's list lengths, which is largest for the centre of a group."""
    tokens = classes.select("cid", F.posexplode("signature").alias("at", "value"))
    postings = tokens.select("cid", F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("token"))
    first = stage(_listed(postings, matches).select("cid", F.col("posts.token").alias("tokens")), "near-dup-listed")
    again = _listed(first.select("cid", F.explode("tokens").alias("token")), matches)
    return again.select(
        "cid",
        F.aggregate("posts", F.lit(0).cast("long"), lambda s, p: s + p["n"]).alias("central"),
        F.slice(F.col("posts.token"), F.lit(1), F.size("posts") - F.lit(matches - 1)).alias("prefix"),
    )


def bundles(prefixed: DataFrame) -> DataFrame:
    """``cid, bundle``: documents whose prefixes touch, directly or by others.
    Each list is a star around its least member, so a list of n has n - 1 edges."""
    rows = prefixed.select("cid", F.explode("prefix").alias("token"))
    heads = rows.groupBy("token").agg(F.min("cid").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = components(rows.join(heads, "token").select("cid", "head"), "cid", "head", "near-dup-bundles")
    ends = joined.select(F.col("node").alias("cid"), F.col("component").alias("bundle"))
    return ends.union(ends.select(F.col("bundle").alias("cid"), "bundle").distinct())


class _Union:
    """Union-find over the members of one block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Exact test on two full sets (distinct, ascending)."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def collisions(rows: np.ndarray, part: np.ndarray, matches: int = MATCHES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``a, b, counts``: for every member a of part 0 the members b that agree
    with it in ``matches`` coordinates or more, each pair once.

    A coordinate and its value are a posting list of the block's members.  Of
    a's c lists with others on them, the c - matches + 1 shortest are merged; a
    member on none of them cannot reach the count.  The long lists are never
    merged: each member met so far is looked up in them."""
    n, width = rows.shape
    lists = np.empty((width, n), np.int64)  # members by value, coordinate by coordinate
    begins, ends = np.empty((n, width), np.int64), np.empty((n, width), np.int64)
    for k in range(width):
        order = np.argsort(rows[:, k], kind="stable")
        value = rows[order, k]
        lists[k] = order
        begins[:, k], ends[:, k] = np.searchsorted(value, rows[:, k], "left"), np.searchsorted(value, rows[:, k], "right")
    lengths = ends - begins
    for a in np.flatnonzero(part == 0).tolist():
        shared = np.flatnonzero(lengths[a] > 1)
        if len(shared) < matches:
            continue
        shared = shared[np.argsort(lengths[a, shared], kind="stable")]
        merged, probed = shared[:len(shared) - matches + 1], shared[len(shared) - matches + 1:]
        counts = np.bincount(np.concatenate([lists[k, begins[a, k]:ends[a, k]] for k in merged]), minlength=n)
        met = np.flatnonzero(counts)
        met = met[(met > a) | (part[met] != 0)]  # of two members of part 0, the first one asks
        total = counts[met] + (rows[np.ix_(met, probed)] == rows[a, probed]).sum(axis=1)
        hit = total >= matches
        if hit.any():
            yield a, met[hit], total[hit]


def block_links(sets: list[np.ndarray], rows: np.ndarray, group: np.ndarray, part: np.ndarray, matches: int = MATCHES, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what ought to be connected among the members of a
    block.  ``group``: labels known to be connected already (equal: connected);
    ``part`` 0 meets all, 1 meets only members of part 0."""
    n, union, links = len(sets), _Union(len(sets)), []
    seen: dict[int, int] = {}
    for k, g in enumerate(group.tolist()):
        if g in seen:
            union.join(k, seen[g])
        seen.setdefault(g, k)
    sizes = np.array([len(s) for s in sets])
    found = []
    for a, b, same in collisions(rows, part, matches):
        near = 100 * np.minimum(sizes[b], sizes[a]) >= percent * np.maximum(sizes[b], sizes[a])
        if near.any():
            b = b[near]
            found.append(np.stack([same[near], np.full(len(b), a), b], axis=1))
    if not found:
        return links
    pairs = np.concatenate(found)
    # likeliest first, so that most later pairs are connected by then and need no test
    for _, a, b in pairs[np.argsort(-pairs[:, 0], kind="stable")].tolist():
        if union.find(a) != union.find(b) and similar(sets[a], sets[b], percent):
            union.join(a, b)
            links.append((a, b))
    return links


def confirmed_links(members: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``a, b`` of the links found in each block of ``members`` (columns
    ``bundle, block, cid, known, part, raw``).  Blocks are streamed: a task
    holds one block's sets at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def links() -> pa.RecordBatch:
            names = [h[0] for h in held]
            found = block_links([h[3] for h in held], np.stack([h[4] for h in held]), np.array([h[1] for h in held]), np.array([h[2] for h in held]))
            return pa.RecordBatch.from_arrays([pa.array([names[a] for a, _ in found], pa.int64()), pa.array([names[b] for _, b in found], pa.int64())], ["a", "b"])

        for piece in common.slices(batches, "raw"):
            hashes, bounds = shingle_sets(piece.column("raw"), size)
            rows = signatures(hashes, bounds, COORDINATES)
            columns = [piece.column(c).to_pylist() for c in ("bundle", "block", "cid", "known", "part")]
            for k, (bundle, block, cid, known, part) in enumerate(zip(*columns)):
                if (bundle, block) != key:
                    if len(held) > 1:
                        yield links()
                    held, key = [], (bundle, block)
                held.append((cid, known, part, hashes[bounds[k]:bounds[k + 1]].copy(), rows[k]))
        if len(held) > 1:
            yield links()

    rows = members.select("bundle", "block", "cid", "known", "part", "raw")
    return rows.repartition("bundle", "block").sortWithinPartitions("bundle", "block").mapInArrow(common.lean(task), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest
    id reachable over links) and ``kept`` (it is its own component's)."""
    signed = stage(signature_table(docs, id_col, text_col), "near-dup-signatures")
    real = signed.where(F.col("digest").isNotNull())
    classes = stage(real.groupBy("digest").agg(F.min("doc_id").alias("cid"), F.first("signature").alias("signature")), "near-dup-classes")
    prefixed = stage(prefixes(classes.where(F.col("cid").isNotNull())), "near-dup-prefixes")
    place = stage(bundles(prefixed), "near-dup-places").join(prefixed.select("cid", F.col("central")), "cid")
    place = place.groupBy("cid", "bundle").agg(F.max("central").alias("central"))

    texts = docs.select(F.col(id_col).cast("long").alias("cid"), F.col(text_col).cast("binary").alias("raw")).where(F.col("raw").isNotNull())
    members = stage(texts.join(place, "cid"), "near-dup-members")
    sizes = members.groupBy("bundle").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("raw")).alias("bytes"))
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("n") / block_docs), F.ceil(F.col("bytes") / block_bytes)).cast("int"))
    sized = members.join(sizes.select("bundle", "blocks"), "bundle").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    sized = stage(sized.withColumn("known", F.col("cid")).withColumn("part", F.lit(0)), "near-dup-blocks")

    # first: all pairs within a block, and every block of a large bundle with the bundle's centre
    large = sized.where("blocks > 1")
    rank = large.select("bundle", "cid", "central").distinct()
    tops = _tops(rank)
    centre = large.join(tops, ["bundle", "cid"], "left_semi")
    spread = centre.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where(F.col("to") != F.col("block"))
    first = sized.select("bundle", "block", "cid", "known", "part", "raw").unionByName(spread.select("bundle", F.col("to").alias("block"), "cid", "known", "part", "raw"))
    links = stage(confirmed_links(first), "near-dup-links")

    if not large.isEmpty():
        links = stage(links.unionByName(_leftover_links(large, links, block_docs)), "near-dup-all-links")
    joined = components(links, "a", "b", "near-dup-components")

    where = classes.select("digest", "cid").join(joined.withColumnRenamed("node", "cid"), "cid", "left")
    where = where.select("digest", F.coalesce("component", "cid").alias("component"))
    out = signed.select("doc_id", "n_shingles", "digest").join(where, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _tops(rank: DataFrame) -> DataFrame:
    """The HUBS most central members of each bundle.  Spark limits each task's
    rows of a bundle to HUBS before the shuffle, so a large one is not gathered."""
    place = F.row_number().over(Window.partitionBy("bundle").orderBy(F.desc("central"), "cid"))
    return rank.withColumn("_place", place).where(F.col("_place") <= HUBS).select("bundle", "cid")


def _leftover_links(large: DataFrame, links: DataFrame, block_docs: int) -> DataFrame:
    """Links between members of a large bundle that the first pass left
    unconnected: those outside the bundle's main component, in blocks, against
    every block of the bundle."""
    joined = components(links, "a", "b", "near-dup-first").withColumnRenamed("node", "cid")
    known = large.drop("known").join(joined, "cid", "left").withColumn("known", F.coalesce("component", "cid")).drop("component")
    narrow = known.groupBy("bundle", "known").agg(F.count(F.lit(1)).alias("n"))
    main = narrow.groupBy("bundle").agg(F.max(F.struct("n", "known")).alias("m")).select("bundle", F.col("m.known").alias("main"))
    known = stage(known.join(main, "bundle").withColumn("left", F.col("known") != F.col("main")), "near-dup-known")
    left = known.where("left")
    blocks = left.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / block_docs).cast("int").alias("left_blocks"))
    left = left.join(blocks, "bundle").withColumn("mine", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("left_blocks")).cast("int"))
    # a task: one block of leftovers (part 0) and one block of the bundle (part 1)
    pair = (F.col("mine") * F.col("blocks") + F.col("other")).cast("int").alias("block")
    a = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("bundle", pair, "cid", "known", F.lit(0).alias("part"), "raw")
    b = known.join(blocks, "bundle").withColumn("mine", F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1))).withColumn("other", F.col("block")).select("bundle", pair, "cid", "known", F.lit(1).alias("part"), "raw")
    return confirmed_links(a.unionByName(b))
