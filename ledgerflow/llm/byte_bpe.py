"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece exactly one token can end its BPE encoding; the
table of those last tokens is the whole state (``PrefixTable``).  A prefix's
last token is the one that stands at the prefix's end and may follow the last
token of the prefix before it, and whether two tokens may stand side by side
depends on those two alone (``Vocabulary.adjacent``).  So appending bytes adds
entries and changes none, and after an edit the table agrees with the old one
again as soon as ``longest token`` consecutive entries do.

On Spark ``encode`` is one pass over the documents without a shuffle: Arrow
batches in, packed ids and decoded bytes out.

Defined cases: a null text is read as an empty one and has no ids; repeated
rows give repeated results; columns not named are not read.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import common, pretoken
from ledgerflow.llm.pieces import PieceEncoder


#: Token pairs whose adjacency one process remembers before it starts anew.
PAIRS_KNOWN = 500_000


def read_ranks(source: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, from the text of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in source.splitlines() if line)}


class Vocabulary:
    """Ranks, the two halves each token was merged from, and adjacency."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        size = max(ranks.values()) + 1
        self.text = [b""] * size
        for token, rank in ranks.items():
            self.text[rank] = token
        self.left, self.right = [-1] * size, [-1] * size
        self.merged: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                self._halve(token, rank)
        self.tails: dict[bytes, int] = {token[k:]: -1 for token in ranks for k in range(len(token))}
        self.tails.update(ranks)  # every end of a token: its rank, or -1 where it is none itself
        self.known: dict[int, bool] = {}
        lengths = np.array([len(t) for t in self.text], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.flat = np.frombuffer(b"".join(self.text), np.uint8)

    def _halve(self, token: bytes, rank: int) -> None:
        """The one pair of earlier tokens that BPE merges into ``token``: the
        halves that may stand side by side before this merge is known."""
        for k in range(1, len(token)):
            a, b = self.ranks.get(token[:k], rank), self.ranks.get(token[k:], rank)
            if a < rank and b < rank and self.adjacent(a, b):
                self.left[rank], self.right[rank] = a, b
                self.merged[a, b] = rank
                return

    def adjacent(self, a: int, b: int) -> bool:
        """Whether BPE can leave ``a`` directly before ``b``.

        The tokens on either side of the border are unmade again, latest merge
        first.  At every stage a merge across the border must not come before
        the merge that next took one of the two sides further; of equal ranks
        the one further left comes first.
        """
        left, right, merged = self.left, self.right, self.merged
        until_a = until_b = len(left)
        while True:
            across = merged.get((a, b))
            if across is not None and across < until_a and across <= until_b:
                return False
            made_a, made_b = left[a] >= 0, left[b] >= 0
            if made_a and (not made_b or a > b):
                until_a, a = a, right[a]
            elif made_b:
                until_b, b = b, left[b]
            else:
                return True

    def extend(self, raw: bytes, last: list[int], until: int) -> None:
        """Append to ``last`` the last token of every prefix of ``raw`` up to
        ``until`` bytes; ``last[i]`` belongs to ``raw[:i]``."""
        tails, known, adjacent = self.tails.get, self.known, self.adjacent
        for end in range(len(last), until + 1):
            at, found = end - 1, []
            while at >= 0 and (token := tails(raw[at:end])) is not None:
                if token >= 0:
                    found.append((at, token))
                at -= 1
            for at, token in reversed(found):  # exactly one fits; the longest is the likeliest
                if not at:
                    break
                pair = last[at] << 32 | token
                fits = known.get(pair)
                if fits is None:
                    if len(known) > PAIRS_KNOWN:
                        known.clear()
                    fits = known[pair] = adjacent(last[at], token)
                if fits:
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
            last.append(token)

    def encode(self, raw: bytes) -> list[int]:
        """Ids of one piece."""
        return self.encode_all([raw])[0]

    def encode_all(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of many pieces.  They are taken in byte order, and each one
        takes over the table entries of the prefix it shares with the one before."""
        out: list[list[int]] = [[]] * len(pieces)
        ranks, text, raw, last = self.ranks, self.text, b"", [-1]
        for k in sorted(range(len(pieces)), key=pieces.__getitem__):
            piece = pieces[k]
            whole = ranks.get(piece)
            if whole is not None:
                out[k] = [whole]
                continue
            shared = 0
            for x, y in zip(raw, piece):
                if x != y:
                    break
                shared += 1
            raw, end = piece, len(piece)
            del last[shared + 1:]
            self.extend(raw, last, end)
            ids = []
            while end:
                token = last[end]
                ids.append(token)
                end -= len(text[token])
            out[k] = ids[::-1]
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, joined, and where each id's bytes start."""
        lengths = self.lengths[ids]
        return self.flat[common.ragged(self.starts[ids], lengths)], np.concatenate([[0], np.cumsum(lengths)])


class PrefixTable:
    """Last token of every prefix of a byte string, kept under edits."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.raw, self.last = vocabulary, b"", [-1]

    def append(self, more: bytes) -> None:
        """Exact: no entry for a shorter prefix changes."""
        self.raw += more
        self.vocabulary.extend(self.raw, self.last, len(self.raw))

    def replace(self, start: int, stop: int, by: bytes) -> int:
        """Put ``by`` in place of ``raw[start:stop]``; the number of entries
        computed anew.  Entries up to ``start`` stay; those behind the edit are
        taken over once ``longest`` neighbours in a row agree with the old ones."""
        old, moved = self.last, len(by) - (stop - start)
        self.raw = self.raw[:start] + by + self.raw[stop:]
        last, same = old[:start + 1], 0
        for end in range(start + 1, len(self.raw) + 1):
            self.vocabulary.extend(self.raw, last, end)
            behind = end > start + len(by)
            same = same + 1 if behind and last[end] == old[end - moved] else 0
            if same >= self.vocabulary.longest:
                last += old[end - moved + 1:]
                self.last = last
                return end - start
        self.last = last
        return len(self.raw) - start

    def ids(self) -> list[int]:
        """The encoding, read back from the end."""
        out, end = [], len(self.raw)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.text[out[-1]])
        return out[::-1]


class EncodedText:
    """A text with the prefix table of each of its pieces, kept under edits."""

    #: Characters after a piece that its match can depend on.
    AHEAD = 3

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, text
        self.starts = pretoken.split(text).tolist()[:-1] if text else []
        self.tables = [self._table(p) for p in self._cut(text, self.starts)]

    @staticmethod
    def _cut(text: str, starts: list[int]) -> list[str]:
        return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]

    def _table(self, piece: str) -> PrefixTable:
        table = PrefixTable(self.vocabulary)
        table.append(piece.encode())
        return table

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, by: str) -> int:
        """Edit the text; the number of pieces encoded anew.  Pieces that end
        well before the edit stay, as do all from the first old piece border
        behind it that the new split meets again."""
        ends = [*self.starts[1:], len(self.text)]
        keep = 0
        while keep < len(ends) and ends[keep] + self.AHEAD <= start:
            keep += 1
        first = self.starts[keep] if keep < len(self.starts) else 0
        moved = len(by) - (stop - start)
        text = self.text[:start] + by + self.text[stop:]
        old = {s + moved: k for k, s in enumerate(self.starts) if s >= stop}
        new = [first + s for s in pretoken.split(text[first:]).tolist()[:-1]] if first < len(text) else []
        meet = next((k for k, s in enumerate(new) if s in old and s >= start + len(by)), len(new))
        tail = old[new[meet]] if meet < len(new) else len(self.starts)
        fresh = [self._table(p) for p in self._cut(text, new)[:meet]]
        self.tables = self.tables[:keep] + fresh + self.tables[tail:]
        self.starts = self.starts[:keep] + new[:meet] + [s + moved for s in self.starts[tail:]]
        self.text = text
        return len(fresh)

    def ids(self) -> list[int]:
        return [i for table in self.tables for i in table.ids()]


@functools.lru_cache(maxsize=2)
def vocabulary(source: bytes) -> Vocabulary:
    """Built once per Python process."""
    return Vocabulary(read_ranks(source))


@functools.lru_cache(maxsize=2)
def _encoder(source: bytes) -> PieceEncoder:
    return PieceEncoder(vocabulary(source).encode_all)


def encode(docs: DataFrame, rank_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded bytes of every whole text.

    Returns ``id_col``, ``ids`` (little-endian unsigned 32-bit integers) and
    ``decoded`` (the bytes the ids stand for).  The rank file (a vocabulary,
    about a megabyte) is read on the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(rank_file, "rb") as f:
        source = spark.sparkContext.broadcast(f.read())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, encoder = vocabulary(source.value), _encoder(source.value)
        for piece in common.slices(batches, "raw"):
            ids, bounds = encoder.ids(piece.column("raw"))
            flat, at = words.decode(ids)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), common.binary_array(ids.astype("<u4").view(np.uint8), bounds * 4), common.binary_array(flat, at[bounds])],
                ["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("raw"))
    return rows.mapInArrow(common.lean(task), f"id {kind}, ids binary, decoded binary").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, rank_file: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with column ``decoded``: the bytes of its packed ids (null: none)."""
    spark = rows.sparkSession
    with open(rank_file, "rb") as f:
        source = spark.sparkContext.broadcast(f.read())

    @F.pandas_udf("binary")
    def decoded(ids):
        flat = vocabulary(source.value).decode
        return ids.map(lambda x: flat(np.frombuffer(x or b"", "<u4"))[0].tobytes())

    return rows.withColumn("decoded", decoded(F.col(ids_col)))
