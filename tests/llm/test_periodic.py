import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import periodic


def brute(words, least=12):
    """Every period of every stretch: maximal stretches for each period, then those with a smaller one go."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)  # periods ascend: the first is the smallest
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def expected(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words and crc32(str(doc_id).encode()) % 10 == 0:
        g, n = crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, digest("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()), digest(b" ".join(kept)))


def some_words(rng, kind):
    n = rng.randrange(0, 90)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        return ["a"] * n
    if kind == 2:  # Fibonacci words have many runs
        x, y = ["a"], ["a", "b"]
        while len(y) < n:
            x, y = y, y + x
        return y[:n]
    words = [rng.choice("abcdefghijklmnop") for _ in range(n)]
    for _ in range(3):
        i, p = rng.randrange(n + 1), rng.randrange(1, 12)
        words[i:i] = (words[i : i + p] * rng.randrange(2, 9))[: rng.randrange(1, 60)]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    texts = [some_words(rng, rng.randrange(4)) for _ in range(120)]
    ends = np.cumsum([len(t) for t in texts])
    words = np.array([ord(w) for t in texts for w in t], np.int64)
    for least in (2, 12):
        start, length, period = periodic.runs_of(words, ends, least)
        got = {}
        for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
            t = int(np.searchsorted(ends, s, "right"))
            got.setdefault(t, []).append((s - int(ends[t]) + len(texts[t]), n, q))
        for t, text in enumerate(texts):
            assert got.get(t, []) == brute(text, least), (text, least)


def test_table(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(some_words(rng, rng.randrange(4)))) for i in range(150)]
    rows += [(1, "x y " * 20), (1, "x y " * 20), (None, "é ü z " * 15), (None, None), (700, ""), (701, " \t\r\n\x0b\x0c "), (702, None), (703, "one"), (704, "a b\x1ca " * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit("clash"), "collapsed": F.lit(1), "start": F.lit(None)})
    got = periodic.run_digests(docs)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)
    assert periodic.run_digests(docs.limit(0)).count() == 0


def test_plain_output_and_long_texts(spark):
    words = [f"w{i}" for i in range(30_000)]
    text = " ".join(words[:10_000] * 3 + ["odd"] * 50_000 + words)
    row = periodic.periodic_runs(spark.createDataFrame([(5, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 30_000, 10_000), (30_000, 50_000, 1)]
    assert row.collapsed == " ".join(words[:10_000] + ["odd"] + words) and row.n_words == 110_000
