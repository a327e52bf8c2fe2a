"""Periodic runs against a quadratic search, and the query against its definition."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import periodic_runs, queries


def brute(words, least=periodic_runs.MIN_LENGTH):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q):
                own = words[i:i + length]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=4))
def test_runs_of_short_alphabets(texts):
    assert periodic_runs.runs_of(texts) == [brute(w) for w in texts]
    assert periodic_runs.runs_of(texts, 5) == [brute(w, 5) for w in texts]


def test_runs_of_repeated_stretches():
    rng = random.Random(3)
    for _ in range(60):
        base = [b"%d" % rng.randrange(9) for _ in range(rng.randint(1, 40))]
        words = (base * 12)[:rng.randint(0, 200)]
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = b"other"
        assert periodic_runs.runs_of([words, words[::-1]]) == [brute(words), brute(words[::-1])]


def test_fibonacci_words_and_long_ones():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 400:
        a, b = b, b + a
    assert periodic_runs.runs_of([b]) == [brute(b)]
    assert periodic_runs.runs_of([[b"w"] * 50_000]) == [[(0, 50_000, 1)]]
    long = [b"%d" % k for k in range(7_000)] * 5
    assert periodic_runs.runs_of([long]) == [[(0, 35_000, 7_000)]]


def test_words_that_collide_under_a_hash_are_told_apart():
    def thue(one, two, n=1024):
        return bytes(two if bin(k).count("1") % 2 else one for k in range(n))

    x, y = thue(97, 98), thue(98, 97)
    assert periodic_runs.runs_of([[x, y, x, x, y, y] * 4]) == [brute([x, y, x, x, y, y] * 4)]
    assert periodic_runs.runs_of([[x, y] * 6])[0] == [(0, 12, 2)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_its_definition(spark, save):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(("ab", "cd", "x", "y")) for _ in range(rng.randint(1, 90))) for _ in range(120)]
    texts += [None, "", " \n\t", "one", "a " * 300, "é x y " * 20, "a\x0bb\x0ca\x0db\ta\nb " * 5, "word\x1cword " * 12, ("lorem ipsum dolor " * 40).strip()]
    rows = [(k, t, "s", k) for k, t in enumerate(texts)] + [(5, texts[5], "s", 1), (5, "other words here", "s", 1), (None, "a b " * 10, None, None)]
    folder = save(documents=spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3))
    got = [tuple(r) for r in queries.op13_lcp_kruskal_runs(spark, folder).select(*COLUMNS).collect()]
    want = [expected(d, t) for d, t, *_ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] for r in want) > 10


def test_empty_table_and_kept_columns(spark, docs_of):
    none = periodic_runs.periodic_runs(docs_of(["x"]).where("false"))
    assert none.columns == ["doc_id", "n_words", "runs", "collapsed"] and not none.count()
    out = periodic_runs.periodic_runs(docs_of(["go on " * 8 + "end"], [4]), keep=("source",)).first()
    assert (out.doc_id, out.source, out.n_words) == (4, "src", 17)
    assert [tuple(r) for r in out.runs] == [(0, 16, 2)] and bytes(out.collapsed) == b"go on end"


def test_a_text_longer_than_a_step(spark, docs_of):
    text = "alpha beta gamma " * 60_000  # about a megabyte
    out = periodic_runs.periodic_runs(docs_of([text, "a b"])).where(F.size("runs") > 0).collect()
    assert [tuple(r) for r in out[0].runs] == [(0, 180_000, 3)] and len(out) == 1
