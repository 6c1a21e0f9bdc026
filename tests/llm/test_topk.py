from __future__ import annotations

import math

import numpy as np
import pytest

from strata.llm import topk
from strata.llm.topk import BallTree, Best, look_into, needed, search, top_k, without_surplus

SCHEMA = "vec_id long, embedding array<float>, label int, score string, size string"


def brute_force(rows, queries, k=5):
    def usable(v):
        return v[0] is not None and v[1] and all(x is not None and math.isfinite(x) for x in v[1])

    def floors(v):
        return [math.floor(256 * float(np.float32(x))) for x in v]

    rows = [(i, floors(v)) for i, v, *_ in rows if usable((i, v))]
    asked = {}
    for i, v, *_ in queries:
        if usable((i, v)):
            asked[i] = min(asked.get(i, floors(v)), floors(v), key=lambda x: np.array(x, float).tobytes())
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.fixture
def odd_vectors():
    random = np.random.default_rng(2)
    rows = [(int(i), random.normal(0, 0.3, 4).tolist()) for i in range(100, 700)]
    rows += [(i, [0.5, 0.5, 0.25, 0.0]) for i in range(700, 1100)]  # a very common vector
    rows += [(50, [0.5, 0.5, 0.25, 0.0])] * 9 + [(1100, [0.0, 0.0, 0.0, 0.0]), (1150, [-0.5, -0.5, -0.5, -0.5])]
    rows += [(1, None), (None, [1.0, 1.0, 1.0, 1.0]), (2, []), (3, [1.0, None, 1.0, 1.0])]
    rows += [(4, [float("nan"), 1.0, 1.0, 1.0]), (0, [float("inf"), 1.0, 1.0, 1.0]), (1200, [1.0, 2.0]), (1201, [1.0, 1.0])]
    return [(i, v, None, "x", "y") for i, v in rows]


@pytest.mark.parametrize("sizes", [(8192, 128, 512), (64, 8, 5)])
def test_result_equals_brute_force(spark, odd_vectors, monkeypatch, sizes):
    for name, value in zip(("SHARD", "LEAF", "BLOCK"), sizes):
        monkeypatch.setattr(topk, name, value)
    vectors = spark.createDataFrame(odd_vectors, SCHEMA).repartition(4)
    queries = [r for r in odd_vectors if r[0] is not None and r[0] % 50 == 0]
    assert sorted(map(tuple, top_k(vectors, vectors.where("vec_id % 50 = 0")).collect())) == brute_force(odd_vectors, queries)


@pytest.mark.parametrize("scale", [2.0**12, 2.0**19, 2.0**20])
def test_scores_beyond_doubles_are_exact(spark, scale):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(0, scale, 8).astype(np.float32).astype(float).tolist(), None, "", "") for i in range(400)]
    rows += [(400 + i, [*rows[50][1][:7], rows[50][1][7] + i / 256], None, "", "") for i in range(20)]  # apart by little
    vectors = spark.createDataFrame(rows, SCHEMA.replace("array<float>", "array<double>"))
    queries = [r for r in rows if r[0] % 50 == 0]
    floors = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows]
    want = []
    for q, v in floors:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in floors if i != q)
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    assert len(want) == 5 * len(queries)
    assert sorted(map(tuple, top_k(vectors, vectors.where("vec_id % 50 = 0")).collect())) == sorted(want)


def test_large_products_that_cancel():
    random = np.random.default_rng(3)
    queries = np.floor(random.normal(0, 1, (7, 6)) * 2.0 ** random.integers(0, 60, (7, 6)))
    vectors = np.floor(random.normal(0, 1, (9, 6)) * 2.0 ** random.integers(0, 60, (9, 6)))
    queries, vectors = np.hstack([queries, queries]), np.hstack([vectors, -vectors])
    vectors[:, 0] += np.arange(9)
    want = [[sum(int(a) * int(b) for a, b in zip(q, v)) for v in vectors] for q in queries]
    got = topk.inner(queries, vectors)
    assert got.tolist() == [[max(-topk.LARGEST, min(s, topk.LARGEST)) for s in row] for row in want]


def test_a_score_that_no_long_holds_is_refused(spark):
    rows = [(0, [1e18, 0.0], None, "", ""), (50, [1e18, 1.0], None, "", ""), (51, [-1e18, 0.0], None, "", "")]
    vectors = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(Exception, match="a long cannot hold the score of vectors"):
        top_k(vectors, vectors.where("vec_id = 0")).collect()


def test_no_query_is_lost_between_blocks(spark):
    rows = [(50 * i, [float(i % 7), 1.0, i / 256], None, "", "") for i in range(2 * topk.BLOCK + 3)]
    vectors = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert sorted(map(tuple, top_k(vectors, vectors).collect())) == brute_force(rows, rows)


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0], None, "", ""), (50, [2.0], None, "", ""), (7, [3.0], None, "", "")]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, top_k(vectors, vectors.where("vec_id % 50 = 0")).collect())) == brute_force(rows, rows[:2])


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(0, [1.0], None, "", "")], SCHEMA)
    assert top_k(nothing, nothing).collect() == []
    assert top_k(one, nothing).collect() == []
    assert top_k(one, one).collect() == []


def test_bounds_hold_and_prune(monkeypatch):
    """Clustered vectors: no score exceeds its bound, and most leaves are never looked into."""
    monkeypatch.setattr(topk, "LEAF", 16)
    random = np.random.default_rng(4)
    centres = random.normal(0, 100, (40, 16))
    vectors = np.floor(np.repeat(centres, 50, 0) + random.normal(0, 5, (2000, 16)))
    ids, tree = np.arange(2000), BallTree(vectors)
    queries = vectors[::100]
    for leaf in tree.leaves:
        bound = tree.bounds(queries, np.array([leaf]))[:, 0]
        assert ((queries @ vectors[tree.rows[leaf]].T).max(1) <= bound).all()
    looked = []

    def counted(tree, vectors, ids, best, queries, own, leaf, which):
        looked.append(len(which))
        look_into(tree, vectors, ids, best, queries, own, leaf, which)

    monkeypatch.setattr(topk, "look_into", counted)
    own = ids[::100]
    best = search(tree, vectors, ids, queries, own, np.full(20, -np.inf), 5)
    scores = queries @ vectors.T
    scores[np.arange(20), own] = -np.inf
    assert (best.scores == -np.sort(-scores, axis=1)[:, :5]).all()
    alone = sum(looked)
    assert alone < 0.4 * 20 * len(tree.leaves)
    looked.clear()
    search(tree, vectors, ids, queries, own, best.scores[:, -1], 5)  # with the shared kth score
    assert sum(looked) <= alone


def test_surplus_of_equal_vectors_cannot_be_asked_for():
    assert needed([1, 2, 3, 4, 5, 6, 7, 8], 5) == 6
    assert needed([1] * 20 + [2, 3], 5) == 22
    assert needed([1, 1, 2, 2, 3, 3, 4, 4, 5], 5) == 7
    vectors = np.array([[1.0, 2.0]] * 30 + [[2.0, 1.0]] * 3)
    ids = np.r_[np.arange(30)[::-1], [50, 51, 52]]
    assert sorted(ids[without_surplus(ids, vectors, 5)]) == [0, 1, 2, 3, 4, 5, 50, 51, 52]


def test_ties_go_to_smaller_ids():
    best = Best(1, 2, np.array([-np.inf]))
    best.add(np.array([0]), np.array([[5.0, 5.0, 4.0]]), np.array([9, 3, 1]))
    best.add(np.array([0]), np.array([[5.0]]), np.array([4]))
    assert best.ids.tolist() == [[3, 4]]


def test_a_leaf_is_scored_once_for_all_queries(monkeypatch):
    """Vectors without clusters: nothing can be pruned, and a leaf meets all queries in one product."""
    monkeypatch.setattr(topk, "LEAF", 16)
    random = np.random.default_rng(5)
    vectors = np.floor(random.normal(0, 32, (600, 64)))
    ids, own, tree = np.arange(600), np.arange(0, 600, 10), BallTree(vectors)
    calls = []

    def counted(*args):
        calls.append(args[-2])
        look_into(*args)

    monkeypatch.setattr(topk, "look_into", counted)
    scores = vectors[own] @ vectors.T
    scores[np.arange(60), own] = -np.inf
    want = -np.sort(-scores, axis=1)[:, :5]
    floor = (want[:, -1] - 20_000).astype(np.int64)
    for kind in (np.float64, np.float32):
        calls.clear()
        best = search(tree, vectors.astype(kind), ids, vectors[own].astype(kind), own, floor, 5)
        assert (best.scores == want).all()
        assert len(calls) <= len(tree.leaves)


@pytest.mark.parametrize("held", [64 << 20, 4000])
def test_many_cells_find_what_one_finds(spark, odd_vectors, monkeypatch, held):
    """Rows of few queries, small shards and small cells: a grid of several rows and columns."""
    for name, value in (("SHARD", 50), ("BLOCK", 3), ("TOGETHER", 1), ("HELD_BYTES", held)):
        monkeypatch.setattr(topk, name, value)
    huge = [(2000 + i, [3000.0 * x for x in odd_vectors[i][1]], None, "x", "y") for i in range(150)]
    rows = odd_vectors + huge
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    assert sorted(map(tuple, top_k(vectors, vectors.where("vec_id % 50 = 0")).collect())) == brute_force(rows, queries)


def test_the_grid_shuffles_little_and_has_no_large_cell():
    assert topk.grid(2_000_000_000, 40_000_000, 600) == (52, 1)
    assert topk.grid(0, 0, 1) == (1, 1)
    for shards, blocks in ((10**9, 10**9), (10**7, 10**10), (10**11, 10**9), (1000, 1000)):
        rows, columns = topk.grid(shards, blocks, 600)
        assert shards <= rows * topk.HELD_BYTES and blocks <= columns * topk.HELD_BYTES


def test_surplus_keeps_what_is_seldom():
    random = np.random.default_rng(6)
    vectors = random.integers(-3, 3, (400, 3)).astype(np.int16)
    ids = random.permutation(400)
    kept = without_surplus(ids, vectors, 5)
    groups = {}
    for i, v in zip(ids.tolist(), vectors.tolist()):
        groups.setdefault(tuple(v), []).append(i)
    assert sorted(ids[kept]) == sorted(i for same in groups.values() for i in sorted(same)[:6])
