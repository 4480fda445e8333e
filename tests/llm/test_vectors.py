"""Searches against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import neighbours, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def slow_topk(rows, every, k):
    out = {}
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v) and i is not None]
    for q, a in use:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in use if i != q and len(a) == len(b))[:k]
            if scored:
                out[q] = [(i, max(min(-s, 2**63 - 1), -(2**63))) for s, i in scored]
    return out


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.3 * rng.normal(size=12)], i % 6) for i in range(1500)]
    rows += [(1500 + i, rows[i][1], 0) for i in range(60)]  # repeated vectors
    rows += [(2000, None, 0), (2001, [None] * 12, 0), (2002, [float("nan")] * 12, 0), (2003, [float("inf")] + [1.0] * 11, 0), (2004, [0.0] * 12, 0), (2005, [1.0, 2.0], 0), (2050, [1.0, 3.0], 0), (2006, [], 0)]
    return rows


@pytest.mark.parametrize("block", [topk.BLOCK, 64])
def test_topk(spark, table, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    df = spark.createDataFrame(table, SCHEMA).withColumn("score", F.lit(1)).withColumn("v", F.lit(2)).withColumn("part", F.lit(3))
    assert rows_of(topk.search(df)) == slow_topk(table, 50, 5)


def test_topk_in_many_cells(spark, table, monkeypatch):
    monkeypatch.setattr(vectors, "PART_ROWS", 200)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 7)
    assert rows_of(topk.search(spark.createDataFrame(table, SCHEMA), every=20)) == slow_topk(table, 20, 5)


def test_threshold_stops_early(monkeypatch):
    """On a skewed table few rows are scored."""
    rng = np.random.default_rng(4)
    x = np.floor(rng.pareto(1.1, size=(4000, 4)) * 100).astype(np.int64)
    scored, merge = [], vectors.merge
    monkeypatch.setattr(vectors, "merge", lambda *a: scored.append(len(a[2])) or merge(*a))
    q = np.array([[3, 1, 2, 1]])
    at, ids, scores = topk.threshold_search(3)(np.array([-1]), q, np.arange(4000), x)
    want = sorted((-int(s), i) for i, s in enumerate(x @ q[0]))[:3]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want and sum(scored) < 1000


def test_large_components(spark):
    """No row is dropped: sums beyond 2^53 are exact, and what a long can't hold is the nearest long."""
    rows = [(0, [1e5, -1e5], 0), (1, [1e5, 1e5], 0), (2, [2e6, -2.5e6], 0), (3, [1e30, 0.0], 0), (4, [-1e30, 1.0], 0), (5, [0.25, -7.0], 0), (50, [3e6, 3e6], 0), (51, [3000001.0, 3e6], 0), (100, [0.5, 0.5], 0)]
    got = rows_of(topk.search(spark.createDataFrame(rows, SCHEMA)))
    assert got == slow_topk(rows, 50, 5) and len(got) == 3


def test_large_components_in_blocks(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(8)
    rows = np.floor(rng.normal(size=(300, 6)) * 10.0 ** rng.integers(0, 9, (300, 1)))
    ids = rng.permutation(300)
    at, found, scores = topk.threshold_search(7)(ids[:40], rows[:40], ids, rows)
    for i in range(40):
        q = [int(x) for x in rows[i]]
        want = sorted((-sum(a * int(b) for a, b in zip(q, r)), int(j)) for j, r in zip(ids, rows) if j != ids[i])[:7]
        assert [(-s, j) for s, j in zip(scores[at == i].tolist(), found[at == i].tolist())] == want


def test_repeated_and_null_ids(spark):
    """Rows that share an id are each a candidate and each a query; null ids take no part."""
    rows = [(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (1, [1.0, 1.0], 0), (1, [2.0, 1.0], 0), (None, [9.0, 9.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.search(df, k=2).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 1, 131072), (0, 2, 1, 65536)]
    assert {r["vec_id"] for r in neighbours.search(df, k=2).collect()} == {1}


def slow_nearest(rows, every, k):
    use = [(i, np.array(v, float)) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    return {q: sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in use if i != q and len(a) == len(b))[:k] for q, a in use if q % every == 0}


def test_neighbours(spark, table):
    got = rows_of(neighbours.search(spark.createDataFrame(table, SCHEMA), every=20))
    want = {q: x for q, x in slow_nearest(table, 20, 10).items() if x}
    hits = sum(len({i for i, _ in got[q]} & {i for _, i in x}) for q, x in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {(q, i): d for q, a in slow_nearest(table, 20, 10**6).items() for d, i in a}
    assert all(math.isclose(d, exact[q, i], rel_tol=1e-12) for q, x in got.items() for i, d in x)
    assert all(x == sorted(x, key=lambda y: (y[1], y[0])) for x in got.values())


def test_recall(spark, sf):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"]), 0) for r in df.collect()]
    want = slow_nearest(rows, 100, 10)
    got = rows_of(neighbours.search(df))
    assert sum(len({i for i, _ in got[q]} & {i for _, i in x}) for q, x in want.items()) >= 0.9 * 10 * len(want)


def test_recall_in_groups_of_copies(spark):
    """Hundreds of copies of a vector, with ids in no order: ties go to the smallest ids."""
    rng = np.random.default_rng(12)
    kinds = rng.normal(size=(8, 16)).astype(np.float32)
    ids = rng.permutation(6000)
    rows = [(int(i), [float(x) for x in (kinds[n % 8] if n < 4000 else rng.normal(size=16).astype(np.float32))], 0) for n, i in enumerate(ids)]
    got = rows_of(neighbours.search(spark.createDataFrame(rows, SCHEMA), every=50))
    want = slow_nearest(rows, 50, 10)
    copies = {i for i, _, _ in rows[:4000]}
    assert all([i for i, _ in got[q]] == [i for _, i in x] for q, x in want.items() if q in copies)
    assert sum(len({i for i, _ in got[q]} & {i for _, i in x}) for q, x in want.items()) >= 0.9 * 10 * len(want)


def test_surplus_copies():
    """A repeated id, and the query's own, don't take the places of others."""
    ids = np.array([5] * 30 + [7, 3, 9, 8, 6] + [1])
    rows = np.array([[1.0, 0.0]] * 35 + [[1.0, -0.0]])
    held = neighbours.without_surplus(ids, rows, 2)
    assert sorted(ids[held].tolist()) == [1, 3, 5, 5]
    at, found, _ = neighbours.projected_search(2, 8, 0.97, 17)(np.array([5, 1]), rows[[0, 35]], ids, rows)
    assert at.tolist() == [0, 0, 1, 1] and found.tolist() == [1, 3, 3, 5]


def test_chi_square():
    assert math.isclose(neighbours.chi_square(2.0, 2), 1 - math.exp(-1))
    assert math.isclose(neighbours.chi_square(neighbours.chi_square_quantile(0.97, 8), 8), 0.97, rel_tol=1e-9)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert topk.search(none).count() == neighbours.search(none).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], 0)], SCHEMA)
    assert topk.search(alone).count() == neighbours.search(alone).count() == 0
