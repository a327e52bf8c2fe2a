"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are normalised to lower-cased words with one space around each, so a
window of benchmark words is a string that begins and ends with a space.  The
windows of all items are the patterns.  A table of block shifts says how far
the search may jump when it reads a block of text that ends no pattern prefix;
where the shift is zero, the block's bucket holds the patterns to compare.
Patterns are split into classes by length, because the shortest pattern of a
search bounds its jumps.

Documents pass in one scan without a shuffle.  The benchmark must be small to
be broadcast; its bytes are counted first, and beyond ``BLOCK_BYTES`` its
items are searched block by block, each block with tables of its own, in
passes that carry the hits along, so the bound on a broadcast always holds.

Defined cases: a null text has no words; an item without words has no window;
equal items and windows count once per item id; repeated documents give
repeated results; columns not named are not read.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common

WINDOW_WORDS = 10
#: Benchmark text in one broadcast; more is searched in several blocks.
BLOCK_BYTES = 16 << 20
#: Lower ends of the length classes of patterns, and the block size of each.
CLASSES = ((32, 6), (16, 4), (8, 3), (0, 2))

#: Every byte that is no part of a word becomes a space; A-Z become a-z.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(NORMAL).split()


def windows(words: list[bytes], size: int = WINDOW_WORDS) -> list[bytes]:
    """Distinct windows of an item, each as `` w1 w2 ... ``."""
    if not words:
        return []
    return list(dict.fromkeys(b" " + b" ".join(words[k:k + size]) + b" " for k in range(max(1, len(words) - size + 1))))


class WuManber:
    """Search for many byte patterns; all have ``least`` bytes or more."""

    def __init__(self, patterns: list[bytes], block: int):
        self.patterns, self.least = patterns, min(map(len, patterns))
        self.block = block = min(block, self.least)
        self.default = self.least - block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, list[int]] = defaultdict(list)
        for k, pattern in enumerate(patterns):
            for end in range(block, self.least + 1):
                piece, jump = pattern[end - block:end], self.least - end
                if jump < self.shift.get(piece, self.default):
                    self.shift[piece] = jump
            self.buckets[pattern[self.least - block:self.least]].append(k)

    def search(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(start, pattern) of every occurrence, by ascending start."""
        least, block, default, jumps, end, n = self.least, self.block, self.default, self.shift.get, self.least, len(text)
        buckets, patterns = self.buckets, self.patterns
        while end <= n:
            piece = text[end - block:end]
            jump = jumps(piece, default)
            if jump:
                end += jump
                continue
            start = end - least
            for k in buckets[piece]:
                if text.startswith(patterns[k], start):
                    yield start, k
            end += 1


class Matcher:
    """Windows of a set of items, with one search per length class."""

    def __init__(self, items: list[tuple[str, bytes]], size: int = WINDOW_WORDS):
        owners: dict[bytes, set[str]] = defaultdict(set)
        for name, raw in items:
            for window in windows(normal_words(raw or b""), size):
                owners[window].add(name)
        classes: dict[int, list[bytes]] = defaultdict(list)
        for window in owners:
            classes[next(block for low, block in CLASSES if len(window) >= low)].append(window)
        self.searches = [(WuManber(found, block), [tuple(owners[w]) for w in found]) for block, found in classes.items()]

    def hits(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words of a text, the word ranges that lie in occurrences of windows
        (merged, ascending, end exclusive), and the items they belong to."""
        words = normal_words(raw)
        text, spans, items = b" " + b" ".join(words) + b" ", [], set()
        for search, owners in self.searches:
            for start, k in search.search(text):
                spans.append((start, start + len(search.patterns[k])))
                items.update(owners[k])
        if not spans:
            return len(words), [], items
        spans.sort()
        ranges, at, word, low, high = [], 0, 0, *spans[0]
        for a, b in [*spans[1:], (len(text) + 1, 0)]:
            if a < high - 1:  # the space that ends one may begin the next
                high = max(high, b)
                continue
            word, at = word + text.count(b" ", at, low), low
            last = word + text.count(b" ", at, high) - 1
            if ranges and ranges[-1][1] >= word:
                ranges[-1] = (ranges[-1][0], last)
            else:
                ranges.append((word, last))
            low, high = a, b
        return len(words), ranges, items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@functools.lru_cache(maxsize=2)
def _matcher(items: tuple[tuple[str, bytes], ...], size: int) -> Matcher:
    return Matcher(list(items), size)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> list[tuple[tuple[str, bytes], ...]]:
    """The benchmark's items in blocks of at most ``limit`` bytes (a longer item
    is a block of its own); one block is on the driver at a time while it is
    handed to Spark."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("raw"))
    total = items.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    if total <= limit:
        return [tuple((r["id"], r["raw"]) for r in items.collect())]
    sized = items.withColumn("size", F.coalesce(F.octet_length("raw"), F.lit(0)))
    n = -(-int(total) // (limit // 2))
    parts = sized.withColumn("part", F.pmod(F.xxhash64("id", "raw"), F.lit(n)))
    place = Window.partitionBy("part").orderBy("id", "raw")
    parts = parts.withColumn("sub", F.floor((F.sum("size").over(place) - F.col("size")) / F.lit(limit))).persist()
    keys = [(r["part"], r["sub"]) for r in parts.select("part", "sub").distinct().collect()]
    blocks = [tuple((r["id"], r["raw"]) for r in parts.where((F.col("part") == p) & (F.col("sub") == s)).select("id", "raw").collect()) for p, s in sorted(keys)]
    parts.unpersist()
    return blocks


CARRIED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def contaminated_words(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: ``id_col``, the columns in ``keep``, ``n_words``,
    ``hits`` (merged word ranges inside occurrences, end exclusive) and
    ``items`` (ids, as sorted strings, of the items that occur)."""
    spark = docs.sparkSession
    names = [f"c{k}" for k in range(len(keep) + 1)]
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, *keep)]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    state = "n_words long, hits array<struct<start:int,end:int>>, items array<string>"
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip((id_col, *keep), names)], F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("raw"))
    rows = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items"))
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    for number, block in enumerate(blocks, 1):
        shared = spark.sparkContext.broadcast(block)
        last = number == len(blocks)

        def task(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value, size)
            for batch in batches:
                counts, ranges, owners = [], [], []
                for raw, hits, items in zip(batch.column("raw").to_pylist(), batch.column("hits").to_pylist(), batch.column("items").to_pylist()):
                    n, found, more = matcher.hits(raw)
                    if hits:
                        found = merge([*found, *((h["start"], h["end"]) for h in hits)])
                    counts.append(n)
                    ranges.append([{"start": a, "end": b} for a, b in found])
                    owners.append(sorted(more.union(items)))
                own = [batch.column(n) for n in names] + ([] if last else [batch.column("raw")])
                yield pa.RecordBatch.from_arrays([*own, pa.array(counts, pa.int64()), pa.array(ranges, CARRIED), pa.array(owners, pa.list_(pa.string()))], [*names, *([] if last else ["raw"]), "n_words", "hits", "items"])

        rows = rows.mapInArrow(common.lean(task), f"{schema}, {'' if last else 'raw binary, '}{state}")
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, (id_col, *keep))], "n_words", "hits", "items")


def hit_count(hits: str = "hits"):
    """Words in all hit ranges."""
    return F.expr(f"aggregate({hits}, 0L, (n, x) -> n + x.end - x.start)")
