"""The metric range join against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import components, metric_join, queries

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.9):
    """vec_id, n_links, component_id, kept of every row, by comparing all pairs."""
    ids = [r[0] for r in rows]
    usual = [len(v) for _, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    usual = max(set(usual), key=lambda d: (usual.count(d), -d)) if usual else 0
    sound = [v is not None and len(v) == usual > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    vectors = [np.array(v, np.float32).astype(float) if ok else None for (_, v), ok in zip(rows, sound)]
    n = len(rows)
    near = [[j for j in range(n) if i != j and sound[i] and sound[j] and (vectors[i] @ vectors[j]) / (np.linalg.norm(vectors[i]) * np.linalg.norm(vectors[j])) >= cosine] for i in range(n)]
    part = [-1] * n
    for i in range(n):
        todo = [i] if part[i] < 0 else []
        while todo:
            k = todo.pop()
            if part[k] < 0:
                part[k] = i
                todo += near[k]
    out = []
    for i in range(n):
        least = min((ids[j] for j in range(n) if part[j] == part[i] and ids[j] is not None), default=None)
        out.append((ids[i], len(near[i]), least, ids[i] == least))
    return sorted(out, key=repr)


def run(spark, rows, **sizes):
    df = spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS).repartition(3)
    return sorted((tuple(r) for r in metric_join.near_vectors(df, **sizes).collect()), key=repr)


def clustered(rng, n, dim, groups, spread):
    centres = rng.normal(size=(groups, dim))
    return centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * spread


@pytest.mark.parametrize(("dim", "groups", "spread"), [(4, 6, 0.4), (16, 12, 0.25), (3, 400, 0.0)])
def test_links_of_clusters_in_many_small_blocks(spark, dim, groups, spread):
    rng = np.random.default_rng(dim)
    rows = list(enumerate(clustered(rng, 400, dim, groups, spread)))
    got = run(spark, rows, cell_rows=40, block_rows=16, sample_rows=150)
    assert got == brute(rows)
    assert sum(r[1] for r in got) > 100


def test_copies_near_copies_and_defined_cases(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=8)
    rows = [(k, centre) for k in range(60)]  # equal vectors
    rows += [(100 + k, centre + rng.normal(size=8) * 0.02) for k in range(60)]  # an inner ring
    rows += [(200 + k, centre * (k + 1)) for k in range(20)]  # one direction
    rows += [(300 + k, centre + rng.normal(size=8) * 0.35) for k in range(80)]
    rows += [(400 + k, rng.normal(size=8)) for k in range(60)]
    rows += [(500, None), (501, []), (502, np.zeros(8)), (503, [float("nan")] * 8), (504, [None, *centre[:7]]), (505, [float("inf")] * 8), (506, [1.0, 2.0]), (507, [1.0, 2.0]), (100, -centre), (None, -centre), (None, rng.normal(size=8)), (None, None), (None, centre)]
    assert run(spark, rows, cell_rows=30, block_rows=8, sample_rows=64) == brute(rows)
    assert run(spark, rows) == brute(rows)


def test_a_cosine_of_exactly_the_threshold_links(spark):
    rows = [(1, [1, 0, 0, 0]), (2, [9, 1, 3, 3]), (3, [0, 0, 0, -1]), (4, [9, 1, 3, 3.001])]
    got = {r[0]: r for r in run(spark, rows)}
    assert got[1] == (1, 1, 1, True) and got[2] == (2, 2, 1, False) and got[4][1:3] == (1, 1)
    assert got[3] == (3, 0, 3, True)


def test_empty_table_and_clashing_columns(spark, save):
    none = metric_join.near_vectors(spark.createDataFrame([], VECTORS))
    assert none.columns == ["vec_id", "n_links", "component_id", "kept"] and not none.count()
    only = run(spark, [(1, None), (None, [0.0])])
    assert only == [(1, 0, 1, True), (None, 0, None, True)]
    folder = save(embeddings=spark.createDataFrame([(2, [1.0, 0.0], 5, 6, "x"), (1, [1.0, 0.1], 5, 6, "y")], "vec_id long, embedding array<float>, k int, n int, vector string"))
    assert sorted(map(tuple, queries.op12_metric_range_join(spark, folder).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_a_large_near_copy_group_is_joined_without_its_pairs(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=16)
    group = centre + rng.normal(size=(3000, 16)) * 0.01
    sample = metric_join.unit(group[:500])
    radius = float(np.sqrt(0.2))
    pivots = metric_join.choose_pivots(sample, 4, radius)
    away = metric_join.distances(metric_join.unit(group), pivots).min(axis=1)
    assert (metric_join.ring_of(away, radius) == 0).all()
    got = run(spark, list(enumerate(group)), block_rows=256)
    assert {r[1:3] for r in got} == {(2999, 0)}


def test_mixed_ids_are_told_apart(spark):
    ids = [*range(2000), -1, 2**63 - 1, -(2**63), 12345678901, 1 << 32, 2 << 32]
    mixed = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").select(components.mixed(F.col("i"))).collect()]
    assert len(set(mixed)) == len(ids)
    assert 800 < sum(a < b for a, b in zip(mixed[:2000], mixed[1:2000])) < 1200  # no order is left
