import math
import random

from pyspark.sql import functions as F

from quern.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=20, k=20):
    good = [(n, i, [math.floor(64 * x) for x in v]) for n, (i, v, _) in enumerate(rows) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, q, v in good:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, i, w in good if m != n and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def made(rng, n, d, scale=1.0):
    centers = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.4) * scale for c in rng.choice(centers)], 0) for i in range(n)]


def exact(rows):  # as the float column holds them
    import numpy as np

    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = exact(made(rng, 700, 8))
    rows += [(1000 + i, rows[3][1], 0) for i in range(90)] + [(2000, None, 0), (2020, [1.0, None] * 4, 0), (2040, [math.nan] * 8, 0), (2060, [math.inf] * 8, 0), (2080, [], 0), (3001, rows[3][1], 1), (3001, rows[3][1], 1), (None, rows[3][1], 0), (4000, [1.0, 2.0], 0), (4001, [0.5, -2.0], 0), (4020, [1.0, 2.5], 0)]
    rows += [(40, r[1], 0) for r in rows[:130]]  # one id on many rows, which are queries each
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("v", F.lit(1))
    for limits in ({}, {"shard_rows": 40, "block_rows": 7}, {"shard_rows": 100, "sample_rows": 20}):
        got = topk.embedding_top_k(frame, **limits)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows)


def test_few_rows_and_none(spark):
    rows = exact([(0, [1.0, -2.5], 0), (1, [3.0, 0.01], 0), (20, [-0.01, 4.0], 0)])
    assert sorted(map(tuple, topk.embedding_top_k(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)
    assert topk.embedding_top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**20 + 7 * i), float(-(2**21) + i), 1.0], 0) for i in range(60)]
    assert sorted(map(tuple, topk.embedding_top_k(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_tree_bounds_prune():
    import numpy as np

    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(4000, 2)) * 100).astype(np.int64)
    tree = topk.BallTree(rows.astype(float))
    for node, (low, high) in enumerate(tree.range):
        off = np.sqrt(((rows[tree.order[low:high]] - tree.center[node]) ** 2).sum(axis=1))
        assert off.max() <= tree.radius[node] + 1e-9
    seen = []
    full = topk._scores
    try:
        topk._scores = lambda a, b: seen.append(a.shape[0] * b.shape[0]) or full(a, b)
        topk.search(np.arange(4000), rows, np.arange(4000), np.arange(5), rows[:5], np.full(5, topk._LEAST), 20)
    finally:
        topk._scores = full
    assert sum(seen) < 0.3 * 5 * 4000


def test_queries_skip_regions():
    """Every row has a region; bounds hold; most regions are out of reach of a query with a good k-th score."""
    import numpy as np

    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(30, 4))[rng.integers(0, 30, 5000)] * 300 + rng.normal(size=(5000, 4)) * 10).round()
    regions = topk.Regions(rows[::7], 32)
    own = regions.of(rows)
    assert own.min() >= 0 and own.max() < len(regions.center) == 32
    radius = np.array([np.sqrt(((rows[own == r] - regions.center[r]) ** 2).sum(axis=1)).max(initial=0) for r in range(32)])
    reached = 0
    for q in rows[:50]:
        score = rows @ q
        bound = regions.center @ q + np.sqrt(q @ q) * radius
        assert all(score[own == r].max(initial=-1e18) <= bound[r] + 1e-6 for r in range(32))
        reached += (bound >= np.sort(score)[-20]).sum()
    assert reached < 0.4 * 50 * 32
