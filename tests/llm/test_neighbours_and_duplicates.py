"""Vector search, substring dedup, near duplicates, language, pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import components, language_id, multi_index, near_dup, queries, shingles, stages, suffix_levels

VECTORS = "vec_id long, embedding array<float>, label int"


# ---- inverted multi-index ---------------------------------------------------------

def nearest(rows, query, k=10):
    found = sorted((float(np.sqrt(((np.array(v, np.float32).astype(float) - np.array(query, np.float32).astype(float)) ** 2).sum())), i) for i, v in rows)
    return found[:k]


def test_probe_meets_cells_in_order():
    rng = np.random.default_rng(1)
    index = multi_index.Index(rng.normal(size=(7, 3)), rng.normal(size=(7, 3)), rng.integers(0, 4, 49), 10**9)
    for query in rng.normal(size=(20, 6)):
        d1, d2 = index.distances(query)
        sums = (d1[:, None] + d2[None, :]).reshape(-1)
        met = index.probe(query)
        assert sorted(met) == np.flatnonzero(index.counts).tolist()
        assert (np.diff(sums[met]) >= 0).all()


def test_op7_recall_and_scores(spark, save):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[100][1]) for i in range(40)]  # copies of a query's vector
    odd = [(9000, None), (9100, [0.0] * 16), (9200, [1.0, None] * 8), (9300, [float("nan")] * 16), (9400, [float("inf")] + [0.0] * 15), (9500, [1.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], VECTORS).withColumn("cell", F.lit("clash")).repartition(5)
    got = defaultdict(list)
    for r in queries.op7_inverted_multi_index(spark, save(embeddings=df)).collect():
        got[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    assert sorted(got) == [i for i, _ in rows if i % 100 == 0]
    hits = 0
    vectors = dict(rows)
    for q, found in got.items():
        want = nearest([x for x in rows if x[0] != q], vectors[q])
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        found = [(s, v) for _, s, v in sorted(found)]
        assert found == sorted(found)
        for s, v in found:
            assert abs(s - nearest([(v, vectors[v])], vectors[q])[0][0]) < 1e-12
        hits += len({v for _, v in found} & {v for _, v in want})
    assert hits >= 0.9 * 10 * len(got)
    assert [v for _, _, v in sorted(got[100])] == list(range(3000, 3010))  # ties go to the smaller id


def test_op7_few_and_none(spark, save):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 1.0], 0)], VECTORS)
    got = queries.op7_inverted_multi_index(spark, save(embeddings=few)).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 2), (0, 2, 1)]
    assert queries.op7_inverted_multi_index(spark, save(embeddings=few.limit(0))).count() == 0


def test_split_cells_find_the_same(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(400)], "vec_id long, vector array<double>")
    index, placed = multi_index.build(multi_index.usable(df, "vec_id", "vector"), cell_rows=200)
    asked = df.where("vec_id % 100 = 0")
    one = multi_index.search(placed, index, asked).collect()
    assert sorted(one) == sorted(multi_index.search(placed, index, asked, bucket_rows=7).collect())


# ---- suffix levels -----------------------------------------------------------------

def brute_kept(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    where = defaultdict(list)
    for k, raw in enumerate(raws):
        for i in range(len(raw) - length + 1):
            where[raw[i:i + length]].append((k, i))
    gone = [bytearray(len(r)) for r in raws]
    for places in where.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i:i + length] = b"\x01" * length
    return [(len(r), sum(g), len(re.findall(rb"\x01+", bytes(g))), hashlib.sha256(bytes(b for b, x in zip(r, g) if not x)).hexdigest()) for r, g in zip(raws, gone)]


def passages(seed, n):
    """Texts that share passages, copies and periodic stretches."""
    rng = random.Random(seed)

    def prose(k):
        return "".join(rng.choice("abcdefgé \n") for _ in range(k))

    shared = [prose(rng.randint(300, 900)) for _ in range(5)]
    out = [None, "", "x" * 399, "x" * 400, "y" * 1200, "ab" * 500, prose(2000)]
    for _ in range(n):
        text = prose(rng.randint(0, 700)) + rng.choice(shared) + prose(rng.randint(0, 500))
        if rng.random() < 0.3:
            a = rng.randint(0, 300)
            text += shared[0][a:] + prose(50)
        out.append(text)
    for text in out[-6:]:
        edited = list(text)
        edited[len(edited) // 2] = "#"
        out += [text, "".join(edited)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_op8_against_brute_force(spark, docs_of, save, seed):
    texts = passages(seed, 30)
    path = save(documents=docs_of(texts).withColumn("gram", F.lit("clash")))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op8_log_suffix_dedup(spark, path).collect()}
    assert got == dict(enumerate(brute_kept(texts)))


@pytest.mark.parametrize("batches,hot", [(1, 8192), (3, 8192), (4, 8192), (2, 1)])
def test_levels_batches_and_hot_classes_agree(spark, docs_of, batches, hot):
    texts = passages(3, 20)
    docs = suffix_levels.keyed(docs_of(texts))
    covered = suffix_levels.repeats(docs, batches=batches, hot=hot)
    got = {r["doc_id"]: len(r["kept"]) for r in suffix_levels.kept_bytes(docs, covered).collect()}
    want = {k: n - gone for k, (n, gone, _, _) in enumerate(brute_kept(texts)) if gone}
    assert got == want


@pytest.mark.parametrize("hot", [12, 119, 120])
def test_a_class_over_several_tasks_is_compared_as_one(spark, docs_of, hot):
    """One line in 120 unlike contexts, sorted over several tasks with unlike
    shares of it; two documents each have 400 bytes around it in common."""
    rng = random.Random(11)

    def prose(k):
        return "".join(rng.choice("abcdefgh ") for _ in range(k))

    pool = prose(60000)
    at = np.arange(len(pool) - suffix_levels.GRAM + 1)
    hashes = suffix_levels.common.SpanHash(np.frombuffer(pool.encode(), np.uint8).copy()).spans(at, at + suffix_levels.GRAM)
    least = int(np.argmin(hashes))  # the anchor of nearly every window that holds it
    line = pool[least:least + suffix_levels.GRAM]
    texts = []
    for _ in range(60):
        shared = prose(170) + line + prose(170)
        texts += [prose(250) + shared + prose(250) for _ in range(2)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = suffix_levels.keyed(docs_of(texts))
        family = suffix_levels.SuffixFamily(spark)
        family.add(docs)
        gram = int(hashes[least].astype(np.int64))
        assert {r["contexts"] for r in family.matches().where((F.col("gram") == gram) & F.col("first")).collect()} == {len(texts)}
        covered = suffix_levels.repeats(docs, hot=hot)
        got = {r["doc_id"]: len(r["kept"]) for r in suffix_levels.kept_bytes(docs, covered).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = {k: n - gone for k, (n, gone, _, _) in enumerate(brute_kept(texts)) if gone}
    assert len(want) == len(texts) and got == want


def test_levels_grow_geometrically(spark, docs_of):
    docs = suffix_levels.keyed(docs_of(passages(4, 12)))
    family, sizes = suffix_levels.SuffixFamily(spark), []
    for k in range(5):
        family.add(docs.where(F.pmod("doc_id", F.lit(5)) == k))
        sizes.append([level.size for level in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]


def test_op8_empty_and_repeated_rows(spark, docs_of, save):
    assert queries.op8_log_suffix_dedup(spark, save(documents=docs_of(["a"]).limit(0))).count() == 0
    long = "".join(random.Random(8).choices("abcdef", k=500))
    rows = queries.op8_log_suffix_dedup(spark, save(documents=docs_of([long, long], ids=[3, 3]))).collect()
    assert [(r["doc_id"], r["n_removed"]) for r in rows] == [(3, 500), (3, 500)]


# ---- near duplicates ------------------------------------------------------------------

def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def brute_components(texts):
    sets, up = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def near_texts(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    bases = [rng.choices(vocab, k=rng.choice([6, 30, 120, 400])) for _ in range(6)]
    out = ["", None, "  \n", "one two", "One  TWO", "one two three", "a b c d e", "A b c d E a b c d e"]
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, len(words) // 20])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        out.append(" ".join(words))
    return out + [" ".join(rng.choices(vocab, k=80)) for _ in range(20)]


@pytest.mark.parametrize("seed", [1, 2])
def test_op10_against_brute_force(spark, docs_of, save, seed):
    texts = near_texts(seed)
    path = save(documents=docs_of(texts).withColumns({"cid": F.lit("clash"), "digest": F.lit(0)}))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in queries.op10_coordinate_join_near_dup(spark, path).collect()}
    assert got == {k: (n, c, c == k) for k, (n, c) in enumerate(brute_components(texts))}


def test_large_bundles_in_blocks(spark, docs_of):
    texts = near_texts(5, n=110)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs_of(texts), block_docs=7).collect()}
    assert got == {k: c for k, (_, c) in enumerate(brute_components(texts))}


def test_op10_empty_repeated_and_null_ids(spark, docs_of, save):
    assert queries.op10_coordinate_join_near_dup(spark, save(documents=docs_of(["a"]).limit(0))).count() == 0
    rows = queries.op10_coordinate_join_near_dup(spark, save(documents=docs_of(["a b", "a b", "a b", "c"], ids=[5, 5, 9, None]))).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in rows) == [(-1, -1, True), (5, 5, True), (5, 5, True), (9, 5, False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aBé \n\tx", max_size=30), min_size=1, max_size=5), st.integers(1, 5))
def test_shingle_counts(texts, size):
    def want(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return len({tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))}) if words else 0

    _, bounds = shingles.shingle_sets(pa.array([t.encode() for t in texts], pa.binary()), size)
    assert np.diff(bounds).tolist() == [want(t) for t in texts]


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (301, 300)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {k: 0 for k in range(1, 61)} | {k: 100 for k in range(101, 140)} | {301: 300}


# ---- language --------------------------------------------------------------------------

TONGUES = {"en": "the and this that with from have what when were which their would there", "de": "der die das und nicht ist ein eine werden zwischen schön über für auch", "fr": "le la les et est une dans pour qui que vous nous être très où"}


def sentences(seed, n):
    rng = random.Random(seed)
    made = []
    for k in range(n):
        lang = rng.choice(sorted(TONGUES))
        made.append((" ".join(rng.choices(TONGUES[lang].split(), k=rng.randint(3, 60))).capitalize() + ".", lang))
    return made


def test_op9_held_out_accuracy(spark, docs_of, save):
    rows = sentences(9, 900)
    texts, langs = [t for t, _ in rows] + [None, "", "123 -- !!", "。—"], [lang for _, lang in rows] + ["en", None, "de", "fr"]
    found = queries.op9_hashed_subword_langid(spark, save(documents=docs_of(texts, langs=langs).withColumn("language", F.lit("clash")))).collect()
    assert len(found) == len(texts)
    right = total = 0
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        if not regex.search(r"\p{L}", texts[r["doc_id"]] or ""):
            assert r["lang_pred"] == language_id.UNKNOWN and r["rejected"]
        elif r["held_out"]:
            total, right = total + 1, right + (r["lang_pred"] == langs[r["doc_id"]])
    assert total > 100 and right >= 0.97 * total


def test_labels_of_held_out_rows_are_never_seen(spark, docs_of):
    rows = sentences(10, 200)
    held = [zlib.crc32(str(k).encode()) % 5 == 0 for k in range(len(rows))]
    spoiled = docs_of([t for t, _ in rows], langs=["xx" if h else lang for h, (_, lang) in zip(held, rows)])
    plain = docs_of([t for t, _ in rows], langs=[None if h else lang for h, (_, lang) in zip(held, rows)])
    a, b = language_id.fit(spoiled), language_id.fit(plain)
    assert a.labels == b.labels and (a.scores == b.scores).all()


def test_nothing_to_learn_from(spark, docs_of):
    model = language_id.fit(docs_of(["some text"]))
    assert [tuple(r) for r in language_id.predict(docs_of(["some text"]), model).select("language.lang", "language.score").collect()] == [("und", 0.0)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aBé 1.x\n", max_size=12), min_size=1, max_size=4))
def test_subwords_are_those_of_words(texts):
    def count(text):
        return sum(max(0, len(w) + 2 - n + 1) for w in regex.findall(r"\p{L}+", text) for n in language_id.ORDERS)

    column = pa.array([t.encode() for t in texts], pa.binary())
    _, bounds = language_id.subwords(column)
    assert np.diff(bounds).tolist() == [count(t) for t in texts]
    for k, t in enumerate(texts):  # a text's subwords do not depend on its neighbours
        alone, _ = language_id.subwords(pa.array([t.encode()], pa.binary()))
        joined, at = language_id.subwords(column)
        assert sorted(alone.tolist()) == sorted(joined[at[k]:at[k + 1]].tolist())


# ---- pipeline ----------------------------------------------------------------------------

def test_pipeline_stage_by_stage(spark, docs_of, save):
    import corpus_pipeline

    rows = sentences(12, 300)
    texts, langs = [t + f" {k}" for k, (t, _) in enumerate(rows)], [lang for _, lang in rows]
    bench = "one benchmark question that nobody should have seen before the test"
    base = " ".join(random.Random(1).choices(TONGUES["en"].split(), k=200))
    texts += [None, "12345", base, base, base + " from", f"There is {bench} here", 'this is the token = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e" and that']
    langs += ["en"] * 7
    n = len(rows)
    path = save(documents=docs_of(texts, langs=langs), benchmark=spark.createDataFrame([(1, bench)], "item_id long, text string"))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "secret_scan", "byte_bpe"]
    kept = {r["doc_id"] for r in stages.language_id(spark, docs, path).collect()}
    assert not kept & {n, n + 1} and len(kept) == len(texts) - 2
    out = corpus_pipeline.run(spark, path)
    got = {r["doc_id"]: r for r in out.collect()}
    assert not got.keys() & {n, n + 1, n + 3, n + 4, n + 5} and {n + 2, n + 6} <= got.keys()
    want = {k for k, (_, c) in enumerate(brute_components(texts)) if c == k} - {n, n + 1, n + 5}
    assert got.keys() == want
    ids = stages.encode(spark, docs_of(['this is the [secret]" and that']), path).first()["ids"]
    assert got[n + 6]["ids"] == ids
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns


def test_pipeline_on_an_empty_table(spark, docs_of, save):
    import corpus_pipeline

    path = save(documents=docs_of(["a"]).limit(0), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, path).count() == 0


def test_op7_repeated_ids_count_once(spark, save):
    rng = np.random.default_rng(12)
    rows = [(k, [float(x) for x in rng.normal(size=6).astype(np.float32)], 0) for k in range(40)]
    again = [rows[0], rows[0], rows[7], (7, [float("inf")] * 6, 0)]
    once, twice = (save_and_search(spark, save, r) for r in (rows, rows + again))
    assert once == twice and len(once) == 10


def save_and_search(spark, save, rows):
    folder = save(embeddings=spark.createDataFrame(rows, VECTORS).repartition(2))
    return sorted(tuple(r) for r in queries.op7_inverted_multi_index(spark, folder).collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 40), st.integers(1, 4), st.integers(1, 12), st.booleans())
def test_collisions_from_posting_lists(seed, n, values, matches, two_parts):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, values * 3, (n, 12)) // values
    part = rng.integers(0, 2, n) if two_parts else np.zeros(n, int)
    got = [(min(a, b), max(a, b), c) for a, bs, cs in near_dup.collisions(rows, part, matches) for b, c in zip(bs.tolist(), cs.tolist())]
    same = {(a, b): int((rows[a] == rows[b]).sum()) for a in range(n) for b in range(a + 1, n) if part[a] == 0 or part[b] == 0}
    assert len(got) == len(set(got))
    assert set(got) == {(a, b, c) for (a, b), c in same.items() if c >= matches}


def test_near_dedup_keeps_one_row_of_a_group(spark):
    copy, other, blank = " ".join(f"word{k}" for k in range(40)), " ".join(f"else{k}" for k in range(30)), " "
    rows = [(1, copy), (1, copy), (2, copy), (None, copy), (1, other), (None, other + " x"), (5, blank), (5, blank), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("clash")).withColumn("component_id", F.lit(0)).repartition(3)
    out = stages.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, copy), (1, other), (5, blank), (5, blank), (None, None)], key=str)


def test_language_sample_counts_copies_once_and_is_bounded(spark):
    words = {"en": "alpha beta gamma delta", "fr": "epsilon zeta theta kappa"}
    once = [(k, f"{words[lang]} {'xyzw'[k % 4] * 3}", lang) for k, lang in enumerate(["en", "fr"] * 30)]
    kind = "doc_id long, text string, lang string"
    label = [r for r in once if zlib.crc32(str(r[0]).encode()) % 5][0]
    a, b, c = (language_id.fit(spark.createDataFrame(rows, kind), per_language=10, per_text=size) for rows, size in ((once, 1000), (once + [label] * 200, 1000), (once, 4)))
    assert a.labels == b.labels == c.labels == ("en", "fr")
    assert np.array_equal(a.scores, b.scores) and not np.array_equal(a.scores, c.scores)


def test_repeated_windows_meet_across_tasks_and_are_joined_to_nothing(spark):
    """Every row whose key another row has, wherever a key's rows are cut between tasks; no join of the rows."""
    keys = [1] * 500 + [2] + [3, 3] + list(range(10, 200)) + [7] * 60
    data = [(k, d, d % 5, d) for d, k in enumerate(keys)]
    data += [(k, 10_000 + k, 0, 1) for k in range(190, 195)]
    found = spark.createDataFrame(data, "key long, doc_id long, crc long, start int").repartition(7)
    count = {k: sum(r[0] == k for r in data) for k in {r[0] for r in data}}
    want = sorted((d, c, s) for k, d, c, s in data if count[k] > 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 3, 40, 400):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got = suffix_levels.repeated_windows(found)
            assert sorted(tuple(r) for r in got.collect()) == want
        # only rows at the ends of tasks are joined, and the other side has one row a key
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
