"""Conversation repair against an exhaustive search, and the query against its definition."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import queries, turn_repair as T

SOLID = re.compile(r"[^\x20\x09-\x0D]")
RAW = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def faults(rows):
    """Each row's first fault, in order."""
    seen, out = set(), []
    for _, role, text in rows:
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def search(rows, marks):
    """Least (cost, letters) by uniform-cost search over (rows done, initials' state)."""
    todo, done = [(0, "", 0, "", ())], set()
    while todo:
        cost, audit, k, state, kept = heapq.heappop(todo)
        if (k, state) in done:
            continue
        done.add((k, state))
        if k == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(kept)
        go = []
        for role in ("user", "assistant"):
            if {"": "u", "s": "u", "u": "a", "a": "u"}[state] == role[0]:
                go.append((5, "I", k, role[0], (f"{role}:",)))
                if k < len(rows) and marks[k] not in ("blank", "duplicate"):
                    go.append((1 + 5 * (marks[k] == "truncated"), "R", k + 1, role[0], (f"{role}:{rows[k][2]}",)))
        if k < len(rows):
            go.append((2, "D", k + 1, state, ()))
            if marks[k] not in ("blank", "duplicate") and state + rows[k][1][:1] in ("s", "u", "su", "ua", "au") and rows[k][1]:
                go.append((5 * (marks[k] == "truncated"), "K", k + 1, rows[k][1][:1], (f"{rows[k][1]}:{rows[k][2]}",)))
        for c, letter, at, to, line in go:
            heapq.heappush(todo, (cost + c, audit + letter, at, to, kept + line))
    raise AssertionError


def expected(conv, rows):
    """A conversation's result from its rows after damage (turn, role, text), in order."""
    marks, turns = faults(rows), {t for t, _, _ in rows if t is not None}
    cost, audit, text = search(rows, marks)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    """Rows after damage of raw rows (conv_id, turn, role, text), by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        own += [(turn, "user" if drawn == 4 else role, text)] * (0 if drawn == 0 else 2 if drawn == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "user", "assistant"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLES, st.sampled_from(["a.", "b!", "c", "d? ", " ", "a."])), max_size=9))
def test_numbers_decide_as_a_search_does(turns):
    rows = [(k, role, text) for k, (role, text) in enumerate(turns)]
    marks = faults(rows)
    own = T.Segment()
    for (turn, role, text), mark in zip(rows, marks):
        own.add(turn, role, text, 1, mark == "duplicate", mark == "blank", mark == "truncated")
    costs, ranks, codes = own.table()
    cost, states = T.path_of([(costs, ranks)])
    letters, lines = T.edited(codes[0][states[1]], own.forced, own.roles, own.texts, 0)
    more, last = T.closing(states[1])
    assert (cost + T.DELETE * sum(own.forced), letters + more, "\n".join(lines + last)) == search(rows, marks)


def test_other_costs_make_inserts_cheap(monkeypatch):
    monkeypatch.setattr(T, "INSERT", 1)
    monkeypatch.setattr(T, "DELETE", 4)
    monkeypatch.setattr(T, "REROLE", 3)
    T.edges.cache_clear()
    own = T.Segment()
    for k, role in enumerate(["system", "user", "user", "assistant", "assistant"]):
        own.add(k, role, f"{k}.", 1, False, False, False)
    costs, ranks, codes = own.table()
    cost, states = T.path_of([(costs, ranks)])
    assert (cost, T.edited(codes[0][states[1]], own.forced, own.roles, own.texts, 0)[0]) == (2, "KKIKKIK")
    T.edges.cache_clear()


def conversations(rng, n):
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]), rng.choice(["Hi.", "Yes!", "no", " ", None, "", "Why?\n", "é…", f"t{turn}."])))
    return rows


def check(spark, save, rows, **more):
    folder = save(conversations=spark.createDataFrame([(*r, 1, "x") for r in rows], RAW + ", copies int, blank string").repartition(4))
    got = [tuple(r) for r in queries.op11_scalar_dag_repair(spark, folder).select(*NAMES).collect()]
    assert sorted(got, key=repr) == sorted((expected(c, r) for c, r in damaged(rows).items()), key=repr)
    return got


def test_query_against_its_definition(spark, save):
    rows = conversations(random.Random(3), 150) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (7, 1, "user", "x" * 200_000 + ".")]
    got = check(spark, save, rows + rows[:40])
    assert sum(bool(r[7]) for r in got) > 100


def test_dropped_conversations_and_empty_table(spark, save):
    drop = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = check(spark, save, [(*drop, "user", "Hi."), (1000, 1, "user", "Hi.")])
    assert (drop[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    folder = save(conversations=spark.createDataFrame([], RAW))
    assert not queries.op11_scalar_dag_repair(spark, folder).count()


def test_one_conversation_over_many_segments_and_tasks(spark, save, monkeypatch):
    rng = random.Random(11)
    texts = ["Hi.", "Yes!", "no", " ", "Why?"]
    rows = [(1, t // 2 if rng.random() < .2 else t, rng.choice(["user", "assistant", "assistant", "user", "system"]), rng.choice(texts) if rng.random() < .1 else f"w{rng.randrange(400)}{rng.choice('.!?,')}") for t in range(500)]
    rows += [(2, 5, "user", "again.")] * 300 + [(2, 6, "assistant", "yes.")]
    monkeypatch.setattr(T, "SEGMENT_ROWS", 7)
    monkeypatch.setattr(T.repair, "__defaults__", (7,))
    got = {r[0]: r for r in check(spark, save, rows)}
    assert len(got[1][7]) > 400
