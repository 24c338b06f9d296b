import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import neighbours, topk

SCHEMA = "vec_id long, embedding array<float>, label int, cell int, rows string"


def table(spark, n=900, d=16, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d)).astype(np.float32)
    v[5] = v[4]  # ties
    rows = [(i, [float(x) for x in v[i]], i % 3, 1, "r") for i in range(n)]
    odd = [(n, None, None, None, None), (None, [1.0] * d, 1, 1, "r"), (n + 100, [float("nan")] * d, 1, 1, "r"), (n + 200, [float("inf")] + [0.0] * (d - 1), 1, 1, "r"), (n + 300, [None] * d, 1, 1, "r"), (n + 400, [0.0] * d, 1, 1, "r"), (n + 500, [1.0], 1, 1, "r"), rows[3], rows[3]]
    return spark.createDataFrame(rows + odd, SCHEMA), v


def test_topk_equals_brute_force(spark):
    frame, v = table(spark)
    ids = np.append(np.arange(900), 1300)  # the zero vector takes part
    w = np.floor(64 * np.vstack([v, np.zeros((1, 16))]).astype(float))
    got = {}
    for r in topk.top_inner_products(frame).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    for q, found in got.items():
        k = int(np.flatnonzero(ids == q)[0])
        score = w @ w[k]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        assert sorted(found) == [(j + 1, int(ids[i]), int(score[i])) for j, i in enumerate(order)]


def test_blocks_are_pruned():
    rng = np.random.default_rng(0)
    v = rng.integers(-5, 6, (2048, 8)).astype(float)
    v[:256] *= 50
    who, best, scored = topk.search_blocks(v[:4], np.arange(4), v, np.arange(2048), 5)
    assert scored < 4 * 8
    for q in range(4):
        score = v @ v[q]
        score[q] = -np.inf
        assert best[q].tolist() == sorted(score, reverse=True)[:5]


def test_neighbours_recall(spark):
    """At the shipped settings, against all rows, on vectors without any structure."""
    frame, v = table(spark, 3000, 16)
    hits = total = 0
    for r in neighbours.nearest_neighbours(frame).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("f")).collect():
        d = np.sqrt(((v.astype(float) - v[r.query_id].astype(float)) ** 2).sum(1))
        d[r.query_id] = np.inf
        want = np.lexsort((np.arange(3000), d))[:10]
        hits += len({x.vec_id for x in r.f} & set(want.tolist()))
        total += 10
        assert all(abs(x.score - d[x.vec_id]) < 1e-12 for x in r.f)
        assert [x.rank for x in r.f] == list(range(1, 11))
        assert [x.score for x in r.f] == sorted(x.score for x in r.f)
    assert total == 300 and hits / total >= 0.9


def test_traversal_is_in_order():
    rng = np.random.default_rng(2)
    a, b, counts = rng.random(6), rng.random(5), rng.integers(0, 4, 30)
    cells = neighbours.traverse(a, b, counts, 10**9)
    sums = [a[c // 5] + b[c % 5] for c in cells]
    assert sums == sorted(sums) and set(cells) == set(np.flatnonzero(counts))


def test_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [1.0, 2.5], 1), (2, [9.0, 2.5], 1)], "vec_id long, embedding array<float>, label int")
    assert [(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest_neighbours(few).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert [(r.query_id, r.vec_id) for r in topk.top_inner_products(few).orderBy("rank").collect()] == [(0, 2), (0, 1)]
    one = few.where("vec_id = 0")
    assert neighbours.nearest_neighbours(one).count() == 0 and topk.top_inner_products(one).count() == 0
    none = few.where("vec_id > 9")
    assert neighbours.nearest_neighbours(none).count() == 0 and topk.top_inner_products(none).count() == 0


def test_sparse_ids(spark):
    """Ids far apart and negative: no span of them is ever spelled out."""
    rng = np.random.default_rng(4)
    ids = [int(x) * 20 for x in rng.integers(-(10**17), 10**17, 60)] + [10**18, 7, -3]
    v = rng.normal(size=(len(ids), 8)).astype(np.float32)
    frame = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in zip(ids, v, strict=True)], "vec_id long, embedding array<float>")
    w = np.floor(64 * v.astype(float))
    got = {}
    for r in topk.top_inner_products(frame).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q, found in got.items():
        k = ids.index(q)
        order = [ids[i] for i in np.lexsort((ids, -(w @ w[k]))) if i != k][:20]
        assert [x for _, x in sorted(found)] == order
    assert set(got) == {i for i in ids if i % 20 == 0}
    assert neighbours.nearest_neighbours(frame).select("query_id").distinct().count() == sum(i % 100 == 0 for i in ids)


def test_neighbours_in_rounds(spark):
    """However few queries are sent at once, and with one vector in many rows, the answers are the same."""
    frame, v = table(spark, 1200, 12)
    many = spark.createDataFrame([(5000 + i, [float(x) for x in v[100]], 0, 1, "r") for i in range(300)], SCHEMA)
    frame = frame.unionByName(many)
    whole = sorted(map(tuple, neighbours.nearest_neighbours(frame, every=10, visit=1.0).collect()))
    assert whole == sorted(map(tuple, neighbours.nearest_neighbours(frame, every=10, visit=1.0, round_size=7).collect()))
    ids = np.append(np.arange(1200), np.arange(5000, 5300))
    w = np.vstack([v, np.repeat(v[100:101], 300, axis=0)]).astype(float)
    want = []
    for q in np.flatnonzero(ids % 10 == 0):
        d = np.sqrt(((w - w[q]) ** 2).sum(1))
        want += [(int(ids[q]), n + 1, int(ids[i]), float(d[i])) for n, i in enumerate([i for i in np.lexsort((ids, d)) if i != q][:10])]
    assert [r[:3] for r in whole] == [r[:3] for r in sorted(want)]
