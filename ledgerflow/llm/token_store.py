"""Token ids in files: Simple-8b word-aligned blocks in ascending document order.

Format.  A store is a Parquet dataset; each row is one block of consecutive
documents: ``part`` and ``seq`` (its place in the order), ``doc_ids``,
``n_tokens`` (ids per document) and ``payload``.  A payload is, little-endian:

    uint32 number of ids, words, escapes
    uint32 word offset of every group of 1,024 ids, and the end
    uint64 words
    uint64 escapes

A word's upper four bits select how many values of how many bits share its
lower sixty.  Values that need more than sixty bits are escapes: the word
holds their place in the escape list.  No word spans two groups, so a reader
can decode any group alone, and all words of one selector at once.

An added token of the tokenizer that stands in a text is one id, as in the
library.

Defined cases: a null text is read as an empty one, which leaves the end id
alone; rows that repeat a document id stand next to each other; an empty
table gives a store without blocks.
"""

from __future__ import annotations

import functools
import json
import os
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.pieces import PieceEncoder

#: Values in a word and bits of each, by selector; selector 15 marks an escape.
SELECTORS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
COUNTS = np.array([c for c, _ in SELECTORS] + [0, 1], np.int64)
GROUP = 1024
WIDEST = SELECTORS[0][0]
#: A block is closed once it holds this many ids.
BLOCK_IDS = 1 << 16
HEADER = struct.Struct("<III")
#: Pieces that the library encodes as one text, and the end of the Latin letters.
PIECES_AT_ONCE = 100
LATIN_END = "\u0250"
#: Fixed value: how byte-level vocabularies write a space.
SPACE = "\u0120"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of every value, at least 1 (zero takes one bit)."""
    high = values >> np.uint64(32)
    bits = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    if high.any():
        bits = np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, bits)
    return np.maximum(bits, 1).astype(np.uint8)


def pack(values: np.ndarray) -> bytes:
    """A block's payload: each word takes as many of the next values as any
    selector can hold."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    groups = -(-n // GROUP)
    rows = np.zeros((groups, GROUP + WIDEST), np.uint64)
    padded = np.zeros(groups * GROUP, np.uint64)
    padded[:n] = values
    rows[:, :GROUP] = padded.reshape(groups, GROUP)
    need = _bits(rows.reshape(-1)).reshape(rows.shape)
    chosen = np.full((groups, GROUP), ESCAPE, np.uint8)
    window, span = need, 1  # need[i] over the next ``span`` values
    for selector in range(len(SELECTORS) - 1, -1, -1):
        count, bits = SELECTORS[selector]
        while span < count:
            step = min(span, count - span)
            wider = window.copy()
            np.maximum(window[:, :-step], window[:, step:], out=wider[:, :-step])
            window, span = wider, span + step
        chosen[window[:, :GROUP] <= bits] = selector
    steps, starts, bounds = COUNTS[chosen].tolist(), [], [0]
    for g in range(groups):
        row, at, end = steps[g], 0, min(GROUP, n - g * GROUP)
        base = g * (GROUP + WIDEST)
        while at < end:
            starts.append(base + at)
            at += row[at]
        bounds.append(len(starts))
    first = np.array(starts, np.int64)
    kind = chosen[first // (GROUP + WIDEST), first % (GROUP + WIDEST)] if len(first) else np.zeros(0, np.uint8)
    words, flat = kind.astype(np.uint64) << np.uint64(60), rows.reshape(-1)
    for selector, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(kind == selector)
        if len(mine):
            parts = flat[first[mine][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
            words[mine] |= np.bitwise_or.reduce(parts, axis=1)
    large = np.flatnonzero(kind == ESCAPE)
    words[large] |= np.arange(len(large), dtype=np.uint64)
    return HEADER.pack(n, len(words), len(large)) + np.array(bounds, "<u4").tobytes() + words.astype("<u8").tobytes() + flat[first[large]].astype("<u8").tobytes()


def unpack(payload: bytes) -> np.ndarray:
    """All values of a block, as uint64."""
    n, n_words, n_large = HEADER.unpack_from(payload)
    groups = -(-n // GROUP)
    bounds = np.frombuffer(payload, "<u4", groups + 1, HEADER.size).astype(np.int64)
    at = HEADER.size + 4 * (groups + 1)
    words = np.frombuffer(payload, "<u8", n_words, at)
    large = np.frombuffer(payload, "<u8", n_large, at + 8 * n_words)
    kind = (words >> np.uint64(60)).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(COUNTS[kind])])
    group = np.repeat(np.arange(groups), np.diff(bounds))
    place = before[:-1] - before[bounds[:-1]][group] + group * (GROUP + WIDEST)
    out = np.zeros(groups * (GROUP + WIDEST), np.uint64)
    for selector, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(kind == selector)
        if len(mine):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            out[place[mine][:, None] + np.arange(count)] = (words[mine][:, None] >> shifts) & np.uint64((1 << bits) - 1)
    mine = np.flatnonzero(kind == ESCAPE)
    out[place[mine]] = large[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out.reshape(groups, GROUP + WIDEST)[:, :GROUP].reshape(-1)[:n]


@functools.lru_cache(maxsize=2)
def _encoder(source: str) -> PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(source)
    added = json.loads(source)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens that look at what stands beside them are not cut out")
    tokens = {t["content"].encode(): t["id"] for t in added}
    opening = {i for t, i in tokenizer.get_vocab().items() if t.startswith(SPACE)}

    def encode(pieces: list[bytes]) -> list[Sequence[int]]:
        texts = [p.decode() for p in pieces]
        out: list[Sequence[int]] = [()] * len(texts)
        # a space and Latin letters: such pieces are split again as they were, so many go in one text
        plain = [k for k, t in enumerate(texts) if t[0] == " " and t[1:].isalpha() and max(t) < LATIN_END]
        runs = [plain[k:k + PIECES_AT_ONCE] for k in range(0, len(plain), PIECES_AT_ONCE)]
        for run, e in zip(runs, tokenizer.encode_batch_fast(["".join([texts[k] for k in run]) for run in runs], add_special_tokens=False)):
            ids = e.ids
            bounds = [k for k, i in enumerate(ids) if i in opening]  # only a piece's first token holds its space
            if len(bounds) != len(run):
                raise ValueError("the tokenizer splits pieces otherwise")
            for k, low, high in zip(run, bounds, [*bounds[1:], len(ids)]):
                out[k] = ids[low:high]
        rest = sorted(set(range(len(texts))) - set(plain))
        for k, e in zip(rest, tokenizer.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out

    return PieceEncoder(encode, tokens)


BLOCK_SCHEMA = "part int, seq int, doc_ids array<bigint>, n_tokens array<int>, n_ids bigint, payload binary"


def write_store(docs: DataFrame, path: str, tokenizer_file: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and write the store at ``path``; its blocks.

    One range shuffle puts the documents in ascending order; each task then
    encodes, packs and writes its range.  The tokenizer file (a vocabulary of
    a few megabytes) is read on the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        source = spark.sparkContext.broadcast(f.read())
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _encoder(source.value), TaskContext.get().partitionId(), 0
        names, counts, parts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "doc_ids": names, "n_tokens": counts, "n_ids": len(ids), "payload": pack(ids)}],
                pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("payload", pa.binary())]))

        for piece in common.slices(batches, "raw"):
            ids, bounds = encoder.ids(piece.column("raw"))
            for k, name in enumerate(piece.column("id").to_pylist()):
                own = np.concatenate([ids[bounds[k]:bounds[k + 1]], tail])
                names.append(name)
                counts.append(len(own))
                parts.append(own)
                held += len(own)
                if held >= BLOCK_IDS:
                    yield block()
                    seq, names, counts, parts, held = seq + 1, [], [], [], 0
        if names:
            yield block()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("raw"))
    rows = rows.repartitionByRange("id", F.crc32("raw")).sortWithinPartitions("id", F.crc32("raw"))
    rows.mapInArrow(common.lean(blocks), BLOCK_SCHEMA).write.mode("overwrite").option("compression", "uncompressed").parquet(path)
    return read_blocks(spark, path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """``part, seq, start``: ids of all blocks before.  Sums run within a part
    first, so the only single-task step sees one row per part."""
    size = blocks.select("part", "seq", "n_ids")
    parts = size.groupBy("part").agg(F.sum("n_ids").alias("total"))
    parts = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    inside = size.withColumn("inner", F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids"))
    return inside.join(parts, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("start"))


def read_documents(blocks: DataFrame) -> DataFrame:
    """Documents of a store: ``part, seq, doc_id``, ``before`` (ids before it
    in its block) and ``ids`` (little-endian unsigned 32-bit integers)."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"]).astype("<u4")
                bounds = np.concatenate([[0], np.cumsum(row["n_tokens"])]).astype(np.int64)
                n = len(bounds) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(bounds[:-1]), common.binary_array(ids.view(np.uint8), bounds * 4)],
                    ["part", "seq", "doc_id", "before", "ids"])

    return blocks.mapInArrow(common.lean(documents), "part int, seq int, doc_id bigint, before bigint, ids binary")
