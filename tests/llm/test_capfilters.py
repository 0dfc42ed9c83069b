import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import capfilters as cap


def brute(rows, cosine=0.98):
    """All pairs of a label, one by one."""
    unit = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(cap.unit_rows(np.array([v], np.float32).astype(float))[0] if ok else None)
    near = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(len(rows))]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, work = {i}, [i]
        while work:
            new = [j for j in near[work.pop()] if j not in seen]
            seen.update(new), work.extend(new)
        component = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(near[i]), component, vec_id == component))
    return sorted(out, key=str)


def cluster(rng, center, n, spread):
    return center + spread * rng.standard_normal((n, len(center)))


@pytest.mark.parametrize("chunk", [1024, 7])
def test_against_brute_force(spark, chunk):
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1):
        for n, spread in ((40, 0.05), (30, 0.12), (3, 0.01), (25, 0.14)):
            rows += [(len(rows) + i, x.tolist(), label) for i, x in enumerate(cluster(rng, rng.standard_normal(24), n, spread))]
        rows += [(len(rows) + i, x.tolist(), label) for i, x in enumerate(rng.standard_normal((60, 24)))]
    one = rows[5][1]
    rows += [(900 + i, one, 0) for i in range(20)] + [(900, one, 0), (950, one, 1), (951, one, None), (None, one, 0), (3, [3e30 * x for x in one], 0)]
    rows += [(960, None, 0), (961, [0.0] * 24, 0), (962, [-0.0] * 24, 0), (963, [], 0), (964, [float("nan")] + one[1:], 0), (965, [None] + one[1:], 0), (966, [float("inf")] + one[1:], 0), (967, one[:23], 0), (None, None, None)]
    rows += [(970, [1.0], 5), (971, [2.0], 5), (972, [-2.0], 5), (973, [1.0, 0.1], 5), (974, [1.0, 0.2], 5), (975, [1.0, 0.3, 0.5], 5), (976, [1.0, 0.32, 0.5], 5), (977, [0.0, -0.0, 1.0], 5), (978, [-0.0, 0.0, 2.0], 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    frame = frame.withColumns({"no": F.lit("x"), "filter": F.lit(None), "component_id": F.lit(9), "v": F.lit(1)})
    got = cap.near_vectors(frame, recall=0.9999, chunk_rows=chunk)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_recall_at_the_threshold():
    """Of pairs at exactly the cosine, in dimensions of all sizes, and with lists far shorter than the codes."""
    for dims in (2, 3, 8, 33, 64, 256):
        rng = np.random.default_rng(dims)
        a = cap.unit_rows(rng.standard_normal((600, dims)))
        b = rng.standard_normal((600, dims))
        b = cap.unit_rows(b - (a * b).sum(axis=1)[:, None] * a)
        b = 0.98 * a + np.sqrt(1 - 0.98**2) * b
        made, height = cap.codes_of(dims, cap.COSINE, cap.RECALL, cap.CODES, cap.BLOCKS, cap.SEED)
        met, listed = np.zeros(600, bool), 0
        for code in made:
            (ra, fa), (rb, fb) = code.decode(a, height), code.decode(b, height)
            met[np.intersect1d(ra * 10**9 + fa, rb * 10**9 + fb) // 10**9] = True
            listed += len(ra)
        assert met.mean() >= 0.985, dims
        assert listed / 600 <= 120


def test_lists_hold_every_filter_above_the_height():
    rng = np.random.default_rng(2)
    code = cap.ProductCode(10, 16, 2)
    x = cap.unit_rows(rng.standard_normal((50, 10)))
    rows, filters = code.decode(x, 0.3)
    every = np.zeros((256, 10))
    for i in range(16):
        for j in range(16):
            every[i * 16 + j, code.parts[0]], every[i * 16 + j, code.parts[1]] = code.books[0][i], code.books[1][j]
    want = np.argwhere(x @ code.turn @ every.T / np.sqrt(2) >= 0.3)
    assert np.array_equal(np.column_stack([rows, filters]), want)


def test_forest_connects_what_is_linked():
    rng = np.random.default_rng(3)
    for n, m, share in ((40, 30, 0.02), (60, 60, 0.5), (1, 9, 1.0), (30, 40, 0.08), (200, 3, 0.4)):
        found = rng.random((n, m)) < share

        def classes(i, j):
            root = np.arange(n + m)
            for _ in range(n + m):
                low = np.minimum(root[i], root[n + j])
                old = root.copy()
                np.minimum.at(root, i, low), np.minimum.at(root, n + j, low)
                if np.array_equal(root, old):
                    return root

        i, j = cap._forest(found)
        assert found[i, j].all() and np.array_equal(classes(i, j), classes(*np.nonzero(found)))


def test_empty_table(spark):
    assert cap.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
