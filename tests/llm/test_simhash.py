import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quern.llm import simhash


def brute(rows):
    """Fingerprints bit by bit and links by all pairs."""
    fps = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = max(1, len(words) - 2) if words else 0
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(zip((r[0] for r in rows), fps))), key=str)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def test_against_brute_force(spark):
    rng = random.Random(5)
    base = words(rng, 300)
    rows = [(i, words(rng, rng.randrange(0, 9))) for i in range(40)]
    rows += [(100 + i, base.replace(base[10 * i : 10 * i + 4], "zzzz", 1)) for i in range(25)]
    rows += [(900, base), (901, base.upper()), (902, base + " "), (50, base), (50, base)]
    rows += [(903, None), (904, ""), (905, " \t\x0b "), (906, "one"), (907, "ONE"), (908, "é two"), (None, "one"), (None, "alone here now"), (909, " x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash")).withColumn("fp", F.lit(None).cast("int"))
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_links_connect_what_is_near_also_in_hot_buckets(spark):
    rng = np.random.default_rng(3)
    center = int(rng.integers(1 << 62))
    fps = {center}
    for _ in range(700):
        x = center
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            x ^= 1 << int(b)
        fps.add(x - (1 << 64) if x >= 1 << 63 else x)
    fps |= {int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 300)}
    fps = sorted(fps)
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    a = np.array(fps)
    near = np.bitwise_count((a[:, None] ^ a[None, :]).view(np.uint64)) <= 3

    def classes(pairs):
        root = {x: x for x in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in pairs:
            root[find(x)] = find(y)
        groups = {}
        for x in fps:
            groups.setdefault(find(x), []).append(x)
        return sorted(groups.values())

    truth = classes((fps[i], fps[j]) for i, j in np.argwhere(near))
    for rows, conf in ((8192, "4"), (50, "3"), (50, "1")):
        spark.conf.set("spark.sql.shuffle.partitions", conf)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100" if rows == 50 else "10000")
        links = [tuple(r) for r in simhash.hamming_links(frame, bucket_rows=rows).collect()]
        assert all(((x ^ y) & (1 << 64) - 1).bit_count() <= 3 for x, y in links)
        assert classes(links) == truth
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_components_of_a_long_path(spark):
    from quern.llm.shared import components

    path = spark.range(1, 400).selectExpr("id as a", "id - 1 as b").unionByName(spark.createDataFrame([(1000, 1001), (1001, 1000), (5000, 5000), (None, 3)], "a long, b long"))
    got = {r.node: r.root for r in components(path).collect()}
    assert got == {**{i: 0 for i in range(1, 400)}, 1001: 1000}
