"""Substring dedup with a logarithmic family of sparse suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere goes.

A suffix array holds the suffixes that start at anchors: of every LENGTH-byte
window, the ``GRAM``-byte string of least hash, the leftmost of equals.  Equal
windows have their anchor at the same place, so no repeat of LENGTH bytes is
missed, and there are about 2 / (LENGTH - GRAM) anchors a byte.  An array is a
table sorted by suffix: first bytes, hash of the gram, hash of the context (all
windows that hold the anchor); equal neighbours are what a merge scan finds.

New batches get an array of their own.  It is merged with the newest level as
long as that has the same size, so levels grow geometrically and a suffix is
rewritten a logarithmic number of times.  The pass that merges is the scan that
matches: it counts equal contexts and unlike contexts of equal grams.

Equal contexts repeat as a whole.  Where contexts of one gram differ, their
windows are compared at equal distance from the anchor; classes of very many
contexts do so by a shuffle on window hashes, after a first round that keeps
only contexts sharing GRAM bytes and half the rest on either side.

Defined cases: a null text is empty; texts shorter than LENGTH keep all bytes;
repeated rows are repeats of each other; columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.common import stage
from ledgerflow.session import scratch_path

LENGTH = 400
GRAM = 64
#: Batches that a whole table is added in.
BATCHES = 2
#: Contexts of one gram that one task compares; classes beyond go by window hashes.
HOT_CONTEXTS = 4096
#: Contexts compared at once inside a task (a class of more is one step).
CHUNK_CONTEXTS = 1024
#: Text bytes of one step: every byte takes about a hundred bytes of arrays.
STEP_BYTES = 512 << 10


@contextmanager
def settings(spark: SparkSession):
    """Let Spark filter a scan by a bloom filter of the join's other side,
    whose size it bounds itself, whatever the scan's size; and hand texts to
    Python in batches of fewer rows."""
    wanted = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, crc, raw``: a row's key is its id and its text's checksum."""
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 62))).alias("doc_id"), F.crc32(raw).alias("crc"), raw.alias("raw"))


def anchors(raw: np.ndarray, at: np.ndarray, hashes: common.SpanHash, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of texts joined in ``raw`` (bounds ``at``): their positions,
    ascending, and the hash of the gram at each."""
    n = len(raw)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.arange(n - gram + 1, dtype=np.int64)
    grams = hashes.spans(starts, starts + gram)
    # upper half of the hash, then the position: the least key is the leftmost least hash
    best = (grams & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
    span, window = 1, length - gram + 1
    while span < window:
        step = min(span, window - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    ends = np.repeat(at[1:], np.diff(at))[:len(best)]  # end of the text that a window starts in
    inside = np.arange(len(best)) + length <= ends
    found = np.unique(best[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return found, grams[found]


def entries(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Anchored suffixes of keyed rows: ``head, gram, context, doc_id, crc,
    place, low, high`` (the context's bounds in the text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "raw", STEP_BYTES):
            at = common.offsets(piece.column("raw"))
            raw = common.data(piece.column("raw"), at)
            at = at - at[0]
            hashes = common.SpanHash(raw)
            found, grams = anchors(raw, at, hashes, length, gram)
            if not len(found):
                continue
            row = np.searchsorted(at, found, "right") - 1
            low, high = np.maximum(at[row], found + gram - length), np.minimum(at[row + 1], found + length)
            context = hashes.spans(low, high) ^ common.mix64((found - low).astype(np.uint64) * np.uint64(1 << 20) + (high - found).astype(np.uint64))
            head = np.zeros(len(found), np.uint64)
            for k in range(8):
                head = (head << np.uint64(8)) | raw[found + k].astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((head ^ np.uint64(1 << 63)).view(np.int64)), pa.array(grams.view(np.int64)), pa.array(context.view(np.int64)), piece.column("doc_id").take(pa.array(row)), piece.column("crc").take(pa.array(row)), pa.array((found - at[row]).astype(np.int32)), pa.array((low - at[row]).astype(np.int32)), pa.array((high - at[row]).astype(np.int32))],
                ["head", "gram", "context", "doc_id", "crc", "place", "low", "high"])

    return rows.where(F.octet_length("raw") >= length).mapInArrow(common.lean(task), "head long, gram long, context long, doc_id long, crc long, place int, low int, high int")


ENTRY = ["head", "gram", "context", "doc_id", "crc", "place", "low", "high"]


def merge_scan(rows: DataFrame, path: str) -> DataFrame:
    """Sort entries by suffix, scan neighbours, write the array at ``path``.

    Written with every entry: ``mates`` (entries of the same gram and context),
    ``contexts`` (unlike contexts of its gram), ``first`` (it stands for its
    context) and ``edge``: it is the first entry of the first or the last run of
    equal contexts in its task's range, so run and class may go on in the next
    task and its counts are partial.  All other entries' counts tell enough:
    a longer run has mates in its own task, and a class of several runs contexts.
    ``open`` holds for all entries of a class that touches an end of the range:
    a class of several tasks touches one in each, so all its entries have it.
    ``own`` is the task's count of contexts, on one edge entry of each open class.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        opened = False

        def flagged(part: pa.Table, first_edge: bool, last_edge: bool) -> pa.RecordBatch:
            gram, context = part["gram"].to_numpy(), part["context"].to_numpy()
            new_gram = np.append(True, gram[1:] != gram[:-1])
            new_context = np.append(True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1]))
            run, cls = np.cumsum(new_context) - 1, np.cumsum(new_gram) - 1
            mates, contexts = np.bincount(run)[run], np.bincount(cls[new_context])[cls]
            edge = new_context & ((first_edge & (run == 0)) | (last_edge & (run == run[-1])))
            outer = np.flatnonzero(edge)
            outer = outer[np.unique(cls[outer], return_index=True)[1]]
            own = np.zeros(len(gram), np.int64)
            own[outer] = contexts[outer]
            open_class = (first_edge & (cls == 0)) | (last_edge & (cls == cls[-1]))
            out = part.append_column("mates", pa.array(mates, pa.int64())).append_column("contexts", pa.array(contexts, pa.int64()))
            out = out.append_column("first", pa.array(new_context)).append_column("edge", pa.array(edge)).append_column("open", pa.array(open_class)).append_column("own", pa.array(own))
            return out.combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            gram = held["gram"].to_numpy()
            cut = int(np.flatnonzero(gram != gram[-1])[-1]) + 1 if (gram != gram[-1]).any() else 0
            if cut:  # all but the last class is complete
                yield flagged(held.slice(0, cut).combine_chunks(), not opened, False)
                held, opened = held.slice(cut).combine_chunks(), True
        if held is not None and held.num_rows:
            yield flagged(held, not opened, True)

    kinds = "head long, gram long, context long, doc_id long, crc long, place int, low int, high int, mates long, contexts long, first boolean, edge boolean, open boolean, own long"
    # the range goes down to single entries, so a class of any size spreads over tasks
    rows = rows.select(*ENTRY).repartitionByRange("head", "gram", "context", "doc_id", "place").sortWithinPartitions("head", "gram", "context", "doc_id", "place")
    return stage(rows.mapInArrow(common.lean(task), kinds), "suffix-level", path)


@dataclass(frozen=True)
class Level:
    size: int
    rows: DataFrame


class SuffixFamily:
    """Levels of sizes 2**k, in batches, newest last."""

    def __init__(self, spark: SparkSession, length: int = LENGTH, gram: int = GRAM):
        self.spark, self.length, self.gram = spark, length, gram
        self.levels: list[Level] = []

    def add(self, docs: DataFrame) -> DataFrame:
        """Index keyed rows; the level that now holds them, scanned."""
        rows, size = entries(docs, self.length, self.gram), 1
        while self.levels and self.levels[-1].size == size:
            rows = rows.unionByName(self.levels.pop().rows.select(*ENTRY))
            size *= 2
        level = Level(size, merge_scan(rows, scratch_path(self.spark, f"suffix-level-{size}")))
        self.levels.append(level)
        return level.rows

    def matches(self) -> DataFrame:
        """Entries with equal grams elsewhere, over all levels: ENTRY, ``mates``,
        ``contexts`` (right where ``first`` holds), ``first``."""
        if len(self.levels) == 1:
            scanned = self.levels[0].rows
        else:
            rows = None
            for level in self.levels:
                rows = level.rows.select(*ENTRY) if rows is None else rows.unionByName(level.rows.select(*ENTRY))
            scanned = merge_scan(rows, scratch_path(self.spark, "suffix-all"))
        cut = scanned.where("edge")  # two entries a task at most
        runs = cut.groupBy("gram", "context").agg(F.sum("mates").alias("mates"), F.sum("own").alias("own"), F.count(F.lit(1)).alias("tasks"))
        # a run of several tasks is a context of each of them
        classes = runs.groupBy("gram").agg(F.sum(F.col("own") - F.col("tasks") + 1).alias("contexts"))
        firsts = scanned.where("open and first and not edge").select(*ENTRY, "first", "mates")
        firsts = firsts.unionByName(cut.select(*ENTRY, "first").join(runs.select("gram", "context", "mates"), ["gram", "context"]))
        mended = stage(firsts.join(classes, "gram"), "suffix-border")
        both = scanned.where("not (open and first)").select(*ENTRY, "first", "mates", "contexts").unionByName(mended)
        return both.where("mates > 1 or contexts > 1")


def _with_text(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """Keyed rows of the documents in ``grouped`` (one row per key).  The scan
    is filtered by a bloom filter of the ids before its text is shuffled."""
    return docs.join(grouped.where("doc_id > -9223372036854775808"), ["doc_id", "crc"])


CONTEXT = "doc_id long, crc long, gram long, place int, low int, raw binary"


def contexts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The text around each entry of ``found``."""
    places = stage(found.groupBy("doc_id", "crc").agg(F.collect_set(F.struct("place", "gram", "low", "high")).alias("places")), "suffix-places")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "raw", STEP_BYTES):
            at = common.offsets(piece.column("raw"))
            raw = common.data(piece.column("raw"), at)
            at = at - at[0]
            lists = piece.column("places")
            count = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(piece)), count)
            flat = lists.flatten()
            low, high = (flat.field(k).to_numpy().astype(np.int64) for k in ("low", "high"))
            lengths = high - low
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(pa.array(row)), piece.column("crc").take(pa.array(row)), flat.field("gram"), flat.field("place"), flat.field("low"), common.binary_array(raw[common.ragged(at[row] + low, lengths)], np.concatenate([[0], np.cumsum(lengths)]))],
                ["doc_id", "crc", "gram", "place", "low", "raw"])

    return _with_text(docs, places).select("doc_id", "crc", "raw", "places").mapInArrow(common.lean(task), CONTEXT)


def _window_keys(piece: pa.RecordBatch, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window that holds an anchor: a key that equal windows of one
    gram share at equal distance from the anchor, its context (row of the
    batch), and its start in the text."""
    at = common.offsets(piece.column("raw"))
    raw = common.data(piece.column("raw"), at)
    at = at - at[0]
    place, low = (piece.column(c).to_numpy().astype(np.int64) for c in ("place", "low"))
    anchor = at[:-1] + place - low
    first = np.maximum(at[:-1], anchor + gram - length)
    last = np.minimum(anchor, at[1:] - length)
    counts = np.maximum(last - first + 1, 0)
    row, starts = np.repeat(np.arange(len(piece)), counts), common.ragged(first, counts)
    same = common.SpanHash(raw).spans(starts, starts + length)
    grams = piece.column("gram").to_numpy().view(np.uint64)
    keys = same ^ common.mix64(grams[row] + (anchor[row] - starts).astype(np.uint64))
    return keys, row, starts - at[row] + low[row]


def _covers(piece: pa.RecordBatch, row: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Merged ranges covered by the given windows (by row, then start)."""
    new = np.append(True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + length)) if len(row) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(row)) - 1 if len(heads) else heads
    owner = pa.array(row[heads])
    return pa.RecordBatch.from_arrays([piece.column("doc_id").take(owner), piece.column("crc").take(owner), pa.array(start[heads].astype(np.int32)), pa.array((start[tails] + length).astype(np.int32))], ["doc_id", "crc", "start", "end"])


COVER = "doc_id long, crc long, start int, end int"


def compared(found: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, crc, start, end``: what contexts of equal grams have in common,
    each class in one task (classes are bounded by HOT_CONTEXTS)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def resolve(table: pa.Table) -> Iterator[pa.RecordBatch]:
            piece = table.combine_chunks().to_batches()[0]
            keys, row, start = _window_keys(piece, length, gram)
            if not len(keys):
                return
            order = np.argsort(keys, kind="stable")
            same = keys[order][1:] == keys[order][:-1]
            twice = np.zeros(len(keys), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            yield _covers(piece, row[twice], start[twice], length)

        for piece in common.slices(batches, "raw", STEP_BYTES):
            held.append(piece)
            rows += piece.num_rows
            if rows >= CHUNK_CONTEXTS:
                table = pa.Table.from_batches(held).combine_chunks()
                grams = table["gram"].to_numpy()
                other = np.flatnonzero(grams != grams[-1])
                if len(other):  # all but the last class is complete
                    cut = int(other[-1]) + 1
                    yield from resolve(table.slice(0, cut))
                    held, rows = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
        if rows:
            yield from resolve(pa.Table.from_batches(held))

    return found.repartition("gram").sortWithinPartitions("gram").mapInArrow(common.lean(task), COVER)


def repeated_windows(rows: DataFrame) -> DataFrame:
    """``doc_id, crc, start`` of the rows (``key, doc_id, crc, start``) whose key
    another row has: sorted over all tasks, equal neighbours are found by a scan,
    so a key of any number of rows spreads over tasks and nothing is joined to
    them.  Of its first and its last key a task also says, in one row each
    (``edge``), whether it holds that row alone: those meet across tasks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        first: int | None = None

        def flagged(part: pa.Table, last_edge: bool) -> pa.RecordBatch:
            nonlocal first
            key = part["key"].to_numpy()
            same = key[1:] == key[:-1]
            mates = np.append(False, same) | np.append(same, False)
            edges = [0] if first is None else []
            if last_edge and key[-1] != (key[0] if first is None else first):
                edges.append(len(key) - 1)
            first = int(key[0]) if first is None else first
            take = np.concatenate([np.flatnonzero(mates), np.array(edges, np.int64)])
            edge = np.zeros(len(take), bool)
            edge[len(take) - len(edges):] = True
            out = part.take(pa.array(take)).append_column("edge", pa.array(edge)).append_column("alone", pa.array(edge & ~mates[take]))
            return out.combine_chunks().to_batches()[0] if len(take) else None

        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            key = held["key"].to_numpy()
            if key[0] != key[-1]:  # all but the last key is complete
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1
                done, held = held.slice(0, cut).combine_chunks(), held.slice(cut).combine_chunks()
                if (out := flagged(done, False)) is not None:
                    yield out
        if held is not None and (out := flagged(held, True)) is not None:
            yield out

    rows = rows.select("key", "doc_id", "crc", "start").repartitionByRange("key", "doc_id", "start").sortWithinPartitions("key", "doc_id", "start")
    scanned = stage(rows.mapInArrow(common.lean(task), "key long, doc_id long, crc long, start int, edge boolean, alone boolean"), "suffix-repeated")
    edges = scanned.where("edge")  # two rows a task at most
    across = edges.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    mended = edges.where("alone").join(F.broadcast(across), "key").select("doc_id", "crc", "start")
    return scanned.where("not edge").select("doc_id", "crc", "start").unionByName(mended)


def compared_by_windows(docs: DataFrame, found: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The same for classes of any size: window hashes are sorted, not gathered."""
    half = (length - gram) // 2

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a window reaches half of what it has besides the gram on one side at least
        for piece in common.slices(batches, "raw", STEP_BYTES):
            at = common.offsets(piece.column("raw"))
            raw = common.data(piece.column("raw"), at)
            at = at - at[0]
            anchor = at[:-1] + (piece.column("place").to_numpy() - piece.column("low").to_numpy())
            hashes = common.SpanHash(raw)
            for side, low, high in ((1, anchor - half, anchor + gram), (2, anchor, anchor + gram + half)):
                fits = np.flatnonzero((low >= at[:-1]) & (high <= at[1:]))
                own = piece.take(pa.array(fits))
                key = hashes.spans(low[fits], high[fits]) ^ common.mix64(own.column("gram").to_numpy().view(np.uint64) + np.uint64(side))
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("crc"), own.column("gram"), own.column("place"), pa.array(key.view(np.int64))], ["doc_id", "crc", "gram", "place", "key"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "raw", STEP_BYTES // 2):
            keys, row, start = _window_keys(piece, length, gram)
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), piece.column("doc_id").take(owner), piece.column("crc").take(owner), pa.array(start.astype(np.int32))], ["key", "doc_id", "crc", "start"])

    around = stage(contexts(docs, found), "suffix-hot")
    sides = around.mapInArrow(common.lean(halves), "doc_id long, crc long, gram long, place int, key long")
    shared = sides.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    left = sides.join(shared, "key").select("doc_id", "crc", "gram", "place").distinct()
    rows = stage(around.join(left, ["doc_id", "crc", "gram", "place"], "left_semi").mapInArrow(common.lean(windows), "key long, doc_id long, crc long, start int"), "suffix-windows")
    return repeated_windows(rows).select("doc_id", "crc", "start", (F.col("start") + length).alias("end"))


def repeats(docs: DataFrame, batches: int = BATCHES, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_CONTEXTS) -> DataFrame:
    """``doc_id, crc, covers`` of every keyed row with bytes to remove: ranges
    (start, end) in any order, which may overlap."""
    spark = docs.sparkSession
    family = SuffixFamily(spark, length, gram)
    with settings(spark):
        for k in range(batches):
            family.add(docs.where(F.pmod(F.xxhash64("doc_id", "crc"), F.lit(batches)) == k))
        found = family.matches()
    if len(family.levels) > 1:
        found = stage(found, "suffix-matches")
    whole = found.where((F.col("mates") > 1) & (F.col("high") - F.col("low") >= length)).select("doc_id", "crc", F.col("low").alias("start"), F.col("high").alias("end"))
    unlike = found.where("contexts > 1 and first")
    with settings(spark):
        covers = whole.unionByName(stage(compared(contexts(docs, unlike.where(F.col("contexts") <= hot)), length, gram), "suffix-compared"))
        many = unlike.where(F.col("contexts") > hot)
        if not many.isEmpty():
            covers = covers.unionByName(stage(compared_by_windows(docs, many, length, gram), "suffix-hot-covers"))
    return covers.groupBy("doc_id", "crc").agg(F.collect_set(F.struct("start", "end")).alias("covers"))


def kept_bytes(docs: DataFrame, covered: DataFrame) -> DataFrame:
    """``doc_id, crc, ranges, kept`` of the rows that lose bytes: maximal removed
    runs (start, end), ascending, and what is left."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "raw", STEP_BYTES):
            at = common.offsets(piece.column("raw"))
            raw = common.data(piece.column("raw"), at)
            at = at - at[0]
            lists = piece.column("covers")
            row = np.repeat(np.arange(len(piece)), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            step = np.zeros(len(raw) + 1, np.int64)
            np.add.at(step, at[row] + flat.field("start").to_numpy(), 1)
            np.add.at(step, at[row] + flat.field("end").to_numpy(), -1)
            gone = np.cumsum(step)[:-1] > 0
            first, last = gone.copy(), gone.copy()
            first[1:] &= ~gone[:-1]
            last[:-1] &= ~gone[1:]
            inner = at[1:-1]  # every text has bytes: it has ranges
            first[inner] |= gone[inner]
            last[inner - 1] |= gone[inner - 1]
            starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
            owner = np.searchsorted(at, starts, "right") - 1
            spans = pa.StructArray.from_arrays([pa.array((starts - at[owner]).astype(np.int32)), pa.array((ends - at[owner]).astype(np.int32))], ["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(piece) + 1)).astype(np.int32)), spans)
            before = np.concatenate([[0], np.cumsum(~gone)])
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("crc"), spans, common.binary_array(raw[~gone], before[at])], ["doc_id", "crc", "ranges", "kept"])

    rows = _with_text(docs, covered).select("doc_id", "crc", "raw", "covers")
    return rows.mapInArrow(common.lean(task), "doc_id long, crc long, ranges array<struct<start:int,end:int>>, kept binary")
