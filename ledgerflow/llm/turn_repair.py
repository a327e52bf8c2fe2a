"""Repair of conversation structure by a shortest path over big-integer weights.

A conversation's rows, by turn, are edited until its roles read
``(system? (user assistant)+)?``: rows are kept, given another role or deleted,
and empty turns inserted, at the least cost; among cheapest edits the letters
(D, I, K, R, in order) that are least in ASCII decide.

Both are one number.  An edge of the path (one row and what is done to it, with
inserts before it) weighs ``cost`` in the high digits; low digits of fixed
width, one slot a row, spell its letters, padded with zeros at the slot's end.
No slot's letters begin another's, since a row's own letter ends them, so
numbers compare as the letters do, and the ordinary minimum over the states
(nothing yet, system, user, assistant) decides cost and letters at once.
Deletions that are forced (blank rows, duplicates) are the same on all paths and
stay outside; an insert stands behind deletions, which spell less.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation
of any size spreads over tasks.  A task turns each conversation into segments of
bounded size.  A conversation that lies in one segment is done.  Otherwise each
segment gives the least number between any two states, the segments' costs and
letter ranks are composed backwards, and the chosen letters and texts are read
again in order; only the digest of one conversation has to be taken in one task,
as a stream.

Defined cases: a null role or text is one space, a null turn comes first and
does not count as a gap, rows of a null conversation are one conversation; an
empty role has no initial and is never kept; ties within a turn are ordered by
role, then text; a conversation without rows has zeros, no letters and the
digest of an empty text; columns not named are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import common
from ledgerflow.llm.common import stage

#: Costs of edits; an undeleted truncated row costs more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows and text bytes of a segment.
SEGMENT_ROWS = 256
SEGMENT_BYTES = 4 << 20

BLANK = r"\A[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the user or assistant turn that may come next.
FOLLOWING = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LETTERS = "DIKR"
SLOT_LETTERS, LETTER_BITS = 3, 3
SLOT_BITS = SLOT_LETTERS * LETTER_BITS


def slot(letters: str) -> int:
    """A row's letters as digits, padded with zeros at the end."""
    value = 0
    for k in range(SLOT_LETTERS):
        value = value << LETTER_BITS | (LETTERS.index(letters[k]) + 1 if k < len(letters) else 0)
    return value


def spelled(value: int) -> str:
    digits = [value >> LETTER_BITS * k & (1 << LETTER_BITS) - 1 for k in reversed(range(SLOT_LETTERS))]
    return "".join(LETTERS[d - 1] for d in digits if d)


def kept_state(state: int, initial: str) -> int | None:
    """Where a row of this role leads, or None if it may not stand there."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


@functools.lru_cache(maxsize=None)
def edges(initial: str, truncated: bool) -> tuple[tuple[int, int, int, int], ...]:
    """What can be done to a row: from, to, cost, slot."""
    out, more = [], TRUNCATED if truncated else 0
    for state in range(4):
        out.append((state, state, DELETE, slot("D")))
        at, cost, letters = state, more, ""
        for _ in range(SLOT_LETTERS):
            to = kept_state(at, initial)
            if to is not None:
                out.append((state, to, cost, slot(letters + "K")))
            out.append((state, FOLLOWING[at], cost + REROLE, slot(letters + "R")))
            at, cost, letters = FOLLOWING[at], cost + INSERT, letters + "I"
    return tuple(out)


def ending(state: int) -> int:
    """Inserts at the end of a conversation."""
    return {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]


def shortest(items: Sequence[tuple[str, bool]], start: int) -> list[int | None]:
    """The least number from ``start`` to each state over all items (initial,
    truncated): cost above ``SLOT_BITS`` a row, letters below."""
    low = SLOT_BITS * len(items)
    best: list[int | None] = [None] * 4
    best[start] = 0
    for t, item in enumerate(items):
        shift, after = low - SLOT_BITS * (t + 1), [None] * 4
        for a, b, cost, letters in edges(*item):
            if best[a] is not None:
                value = best[a] + (cost << low) + (letters << shift)
                if after[b] is None or value < after[b]:
                    after[b] = value
        best = after
    return best


class Segment:
    """Rows of one conversation that follow each other."""

    def __init__(self):
        self.n = self.size = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.first = self.last = None
        self.items: list[tuple[str, bool]] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.forced = [0]

    def add(self, turn: int | None, role: str, text: str, copies: int, again: bool, blank: bool, truncated: bool) -> None:
        if not copies:  # a row that was dropped; its conversation is still there
            return
        initial = role[:1]
        if self.n:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last = initial
        self.n += copies
        self.illegal += copies - 1  # a role next to itself
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if blank or again:
            self.blank += copies * blank
            self.duplicate += copies * (not blank)
            self.forced[-1] += copies
            return
        self.duplicate += copies - 1
        self.truncated += truncated
        self.items.append((initial if initial in ("s", "u", "a") else "", truncated))
        self.roles.append(role)
        self.texts.append(text)
        self.forced.append(copies - 1)
        self.size += len(text)

    def table(self, starts: Sequence[int] = range(4)) -> tuple[list[list[int]], list[list[int]], list[list[bytes]]]:
        """From each start: costs to each state (-1: no way), ranks and digits of the letters."""
        low = SLOT_BITS * len(self.items)
        costs, ranks, codes = [], [], []
        for start in range(4):
            best = shortest(self.items, start) if start in starts else [None] * 4
            digits = [None if b is None else b & (1 << low) - 1 for b in best]
            order = sorted(d for d in digits if d is not None)
            costs.append([-1 if b is None else b >> low for b in best])
            ranks.append([-1 if d is None else order.index(d) for d in digits])
            codes.append([b"" if d is None else d.to_bytes(low // 8 + 1, "big") for d in digits])
        return costs, ranks, codes


def path_of(tables: Sequence[tuple[Sequence[Sequence[int]], Sequence[Sequence[int]]]]) -> tuple[int, list[int]]:
    """Least cost of a conversation and the states between its segments, from
    their costs and ranks, last segment first."""
    onward = [INSERT * ending(s) for s in range(4)]
    chosen = []
    for costs, ranks in tables:
        # cost above, letter rank below: letters of unlike ends differ within the segment
        best = [min((costs[a][b] + onward[b] << 2 | ranks[a][b], b) for b in range(4) if costs[a][b] >= 0) if any(c >= 0 for c in costs[a]) else (0, 0) for a in range(4)]
        onward = [value >> 2 for value, _ in best]
        chosen.append([b for _, b in best])
    states = [START]
    for own in reversed(chosen):
        states.append(own[states[-1]])
    return onward[START], states


def edited(code: bytes, forced: Sequence[int], roles: Sequence[str], texts: Sequence[str], start: int) -> tuple[str, list[str]]:
    """A segment's letters, with forced deletions, and its repaired rows."""
    digits, n, state = int.from_bytes(code, "big"), len(roles), start
    letters, rows = ["D" * forced[0]], []
    for t in range(n):
        own = spelled(digits >> SLOT_BITS * (n - 1 - t) & (1 << SLOT_BITS) - 1)
        for letter in own:
            if letter == "K":
                state = kept_state(state, roles[t][:1])
                rows.append(f"{roles[t]}:{texts[t]}")
            elif letter != "D":
                state = FOLLOWING[state]
                rows.append(f"{NAMES[state]}:{texts[t] if letter == 'R' else ''}")
        letters += [own, "D" * forced[t + 1]]
    return "".join(letters), rows


def closing(state: int) -> tuple[str, list[str]]:
    """Letters and rows of the inserts at the end."""
    rows = []
    for _ in range(ending(state)):
        state = FOLLOWING[state]
        rows.append(f"{NAMES[state]}:")
    return "I" * len(rows), rows


NAMED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "repaired")
FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, repaired string"
SEGMENT = "conv_id long, part int, seq int, closed boolean, " + FOUND + ", n long, first string, last string, low long, high long, turns long, forced array<long>, costs array<array<long>>, ranks array<array<int>>, codes array<array<binary>>, roles array<string>, texts array<string>"
KINDS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("closed", pa.bool_()),
    *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], *[(c, pa.string()) for c in ("audit", "repaired_sha256", "repaired")], ("n", pa.int64()), ("first", pa.string()), ("last", pa.string()),
    *[(c, pa.int64()) for c in ("low", "high", "turns")], ("forced", pa.list_(pa.int64())), ("costs", pa.list_(pa.list_(pa.int64()))), ("ranks", pa.list_(pa.list_(pa.int32()))),
    ("codes", pa.list_(pa.list_(pa.binary()))), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])


def segments(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Segments of flagged rows (``conv_id, turn, role, text, copies, again,
    blank, truncated``); ``closed`` ones are whole conversations, repaired."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, key, own = TaskContext.get().partitionId(), 0, None, Segment()
        # the first and the last conversation of a task may go on in the tasks beside
        open_, held = True, 0
        out: list[dict] = []

        def row(s: Segment, whole: bool) -> dict:
            nonlocal seq
            seq += 1
            found = {"conv_id": key[0], "part": part, "seq": seq, "closed": whole, "blank": s.blank, "duplicate": s.duplicate, "truncated": s.truncated, "illegal": s.illegal}
            costs, ranks, codes = s.table([START] if whole else range(4))
            if not whole:
                return found | {"n": s.n, "first": s.first, "last": s.last, "low": s.low, "high": s.high, "turns": s.turns, "forced": s.forced, "costs": costs, "ranks": ranks, "codes": codes, "roles": s.roles, "texts": s.texts}
            cost, states = path_of([(costs, ranks)])
            letters, lines = edited(codes[START][states[1]], s.forced, s.roles, s.texts, START)
            more, last = closing(states[1])
            text = "\n".join(lines + last)
            return found | {"gaps": s.high - s.low + 1 - s.turns if s.turns else 0, "cost": cost + DELETE * sum(s.forced), "audit": letters + more, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(), "repaired": text}

        for piece in common.slices(batches, "raw"):
            columns = [piece.column(c).to_pylist() for c in ("conv_id", "turn", "role", "raw", "copies", "again", "blank", "truncated")]
            for conv, turn, role, raw, *flags in zip(*columns):
                if key != (conv,):
                    if key is not None:
                        held += own.size
                        out.append(row(own, not open_))
                        open_ = False
                    key, own = (conv,), Segment()
                elif len(own.items) >= segment_rows or own.size >= SEGMENT_BYTES:
                    held += own.size
                    out.append(row(own, False))
                    open_, own = True, Segment()
                own.add(turn, role, raw.decode(), *flags)
                if len(out) >= 256 or held >= SEGMENT_BYTES:
                    yield pa.RecordBatch.from_pylist(out, KINDS)
                    out, held = [], 0
        if key is not None:
            out.append(row(own, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, KINDS)

    order = ["conv_id", "turn", "role", "raw"]
    rows = rows.select("conv_id", "turn", "role", F.col("text").cast("binary").alias("raw"), "copies", "again", "blank", "truncated")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(common.lean(task), SEGMENT)


def states_between(open_segments: DataFrame) -> DataFrame:
    """``part, seq, start, end, cost``: the states around every segment of
    conversations that lie in several tasks or segments, and the cost of the
    conversation.  A conversation's segments stream past backwards; what stays
    of each is one state for every state it may start in."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def composed() -> pa.RecordBatch:
            cost, states = path_of([(costs, ranks) for _, _, costs, ranks in held])
            names = held[::-1]
            return pa.RecordBatch.from_arrays([pa.array([h[0] for h in names], pa.int32()), pa.array([h[1] for h in names], pa.int32()), pa.array(states[:-1], pa.int32()), pa.array(states[1:], pa.int32()), pa.array([cost] * len(names), pa.int64())], ["part", "seq", "start", "end", "cost"])

        for batch in batches:
            for conv, part, seq, costs, ranks in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (conv,):
                    if held:
                        yield composed()
                    key, held = (conv,), []
                held.append((part, seq, costs, ranks))
        if held:
            yield composed()

    rows = open_segments.select("conv_id", "part", "seq", "costs", "ranks").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    return rows.mapInArrow(common.lean(task), "part int, seq int, start int, end int, cost long")


def joined_segments(open_segments: DataFrame) -> DataFrame:
    """``conv_id`` and FOUND of conversations that lie in several segments."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        done: dict = {}
        kinds = pa.schema([KINDS.field(c) for c in ("conv_id", *NAMED)])

        def whole() -> dict:
            more, last = closing(done["state"])
            for line in last:
                done["lines"].append(line)
            text = "\n".join(done["lines"])
            return done["row"] | {"conv_id": key[0], "gaps": done["high"] - done["low"] + 1 - done["turns"] if done["turns"] else 0, "audit": "".join(done["letters"]) + more, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(), "repaired": text}

        for batch in batches:
            for r in batch.to_pylist():
                if key != (r["conv_id"],):
                    if key is not None:
                        yield pa.RecordBatch.from_pylist([whole()], kinds)
                    key = (r["conv_id"],)
                    done = {"row": {c: 0 for c in ("blank", "duplicate", "truncated", "illegal")} | {"cost": r["cost"]}, "low": None, "high": None, "turns": 0, "last": None, "letters": [], "lines": [], "state": START}
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    done["row"][c] += r[c]
                if r["n"]:
                    if done["last"] is not None:
                        done["row"]["illegal"] += done["last"] + r["first"] not in ("su", "ua", "au")
                    done["last"] = r["last"]
                if r["turns"]:
                    done["turns"] += r["turns"] - (r["low"] == done["high"])
                    done["low"], done["high"] = r["low"] if done["low"] is None else done["low"], r["high"]
                done["row"]["cost"] += DELETE * sum(r["forced"])
                letters, lines = edited(r["codes"][r["start"]][r["end"]], r["forced"], r["roles"], r["texts"], r["start"])
                done["letters"].append(letters)
                done["lines"] += lines
                done["state"] = r["end"]
        if key is not None:
            yield pa.RecordBatch.from_pylist([whole()], kinds)

    rows = open_segments.join(states_between(open_segments).drop("conv_id").withColumnRenamed("cost", "total"), ["part", "seq"]).drop("cost").withColumnRenamed("total", "cost")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(common.lean(task), f"conv_id long, {FOUND}")


def flagged(rows: DataFrame) -> DataFrame:
    """Rows with faults: equal rows of a turn once, with their number, and
    whether role and text stand in an earlier turn (``again``), the text is
    ``blank`` or ``truncated``.  A row of no copies is a dropped one."""
    same = ["conv_id", "turn", "role", "text"]
    rows = stage(rows.groupBy(*same).agg(F.sum("copies").cast("long").alias("copies")), "turn-rows")
    # only what stands in several turns is looked up again
    several = rows.where("copies > 0").groupBy("conv_id", "role", "text").agg(F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    several = several.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text").alias("_text"), F.when(~F.col("unnumbered"), F.col("least")).alias("_first"), F.lit(True).alias("_several"))
    found = rows.join(several, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text")), "left")
    again = F.coalesce("_several", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("_first"))
    blank = F.col("text").rlike(BLANK)
    return found.select(*same, "copies", again.alias("again"), blank.alias("blank"), (~blank & ~F.col("text").rlike(ENDED)).alias("truncated"))


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text,
    copies``; none of them null but ids and turns): FOUND, where ``repaired``
    is the repaired ``role:text`` lines."""
    cut = stage(segments(stage(flagged(rows), "turn-flagged"), segment_rows), "turn-segments")
    return cut.where("closed").select("conv_id", *NAMED).unionByName(joined_segments(cut.where("not closed")))
