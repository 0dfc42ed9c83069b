import random

import numpy as np
from pyspark.sql import functions as F

from quern.llm import decontaminate as dec


def text(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def edited(rng, words, n, vocabulary):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[i : i + (kind > 0)] = [rng.choice(vocabulary)] if kind < 2 else []
    return words


def distance(a, b):
    """Least edit distance of a to any stretch of b, cell by cell."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_recall_and_precision(spark):
    rng = random.Random(6)
    common = ["the", "of", "and", "to", "in", "é"]
    vocabulary = common * 10 + ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    items = [(i, text(rng, rng.randrange(8, 60), vocabulary)) for i in range(40)]
    docs, want = [], set()
    for i in range(300):
        body = text(rng, rng.randrange(0, 300), vocabulary)
        if i % 2:
            item = rng.choice(items)
            words = dec.words(item[1])
            leak = edited(rng, words, rng.randrange(0, int(0.15 * len(words)) + 1), vocabulary)
            body += ". " + " ".join(leak).upper() + ", " + text(rng, rng.randrange(0, 100), vocabulary)
        docs.append((i, body))
    for d, body in docs:
        for k, item in items:
            if distance(dec.words(item), dec.words(body)) <= int(0.2 * len(dec.words(item))):
                want.add((d, k))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("start", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = dec.contaminated(frame, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found <= want and len(found) >= 0.99 * len(want) > 100
    for r in got:
        item, body = dict(items)[r.item_id], dict(docs)[r.doc_id]
        assert r.distance == distance(dec.words(item), dec.words(body))
        stretch = dec.words(body)[r.first_word : r.last_word]
        assert distance(dec.words(item), stretch) == r.distance and dec.words(body[r.start : r.stop]) == stretch
    small = dec.contaminated(frame, bench, block_chars=2000).collect()
    assert {(r.doc_id, r.item_id) for r in small} == found


def test_odd_rows(spark):
    item = "One two three four five six seven eight nine ten eleven twelve."
    docs = spark.createDataFrame([(1, None), (2, ""), (3, item), (3, item), (None, "x " + item.replace("six", "6") + " y"), (4, item[:30]), (5, "İİ " + item), (6, "word " * 30000 + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, " ..."), (7, item), (10, "zz")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in dec.contaminated(docs, bench).collect()), key=str)
    assert got == sorted([(d, 7, n) for d, n in ((3, 0), (3, 0), (None, 1), (5, 0), (6, 0)) for _ in range(2)], key=str)
    assert dec.contaminated(docs.limit(0), bench).count() == 0 and dec.contaminated(docs, bench.limit(0)).count() == 0


def test_embedding_keeps_near_windows_near():
    rng = np.random.default_rng(2)
    a = rng.integers(1, 500, 60)
    b = np.delete(a, 20)
    c = rng.integers(1, 500, 60)
    steps = list(range(90))
    gap = lambda x, y: np.mean([(dec.cgk(x, np.array([0]), np.array([len(x)]), steps, t) != dec.cgk(y, np.array([0]), np.array([len(y)]), steps, t)).mean() for t in range(30)])
    assert gap(a, a) == 0 and gap(a, b) < 0.3 < 0.9 < gap(a, c)


def test_every_leak_at_the_full_bound_is_found(spark):
    rng = random.Random(12)
    vocabulary = ["the", "of", "and", "to"] * 10 + ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    items = [(i, text(rng, n, vocabulary)) for i, n in enumerate([9, 15, 20, 24, 38, 54, 59, 100, 120, 150] * 4)]
    docs, want = [], set()
    for k, item in items:
        words = dec.words(item)
        for i in range(4):
            leak = list(words)  # edits spread evenly: runs are as short as they can be
            for at in sorted(range(len(words) // 10, len(words), 5), reverse=True)[: int(0.2 * len(words))]:
                leak[at : at + 1] = [[], ["qq"], [leak[at], "qq"]][rng.randrange(3)]
            docs.append((4 * k + i, text(rng, rng.randrange(60), vocabulary) + " " + " ".join(leak) + " " + text(rng, rng.randrange(60), vocabulary)))
            assert distance(words, dec.words(docs[-1][1])) <= int(0.2 * len(words))
            want.add((4 * k + i, k))
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert want <= {(r.doc_id, r.item_id) for r in dec.contaminated(frame, bench).collect()}
    index = dec.Index.build([(i, dec.words(t)) for i, t in items], 0.2, 0, 4)  # no tables: shared runs alone, cut into parts
    every = [(d, k) for d, t in docs for k, i in items if distance(dec.words(i), dec.words(t)) <= int(0.2 * len(dec.words(i)))]
    ids = [np.array([index.vocabulary.get(w, 0) for w in dec.words(t)], np.int64) for _, t in docs]
    assert [(docs[m[0]][0], index.item_id[m[1]]) for m in index.find(np.concatenate([*ids, [0]]), np.cumsum([len(i) for i in ids]))] == every


def test_recall_at_every_length_and_edit_rate():
    """Items of 10 to 500 words, each in a document with the most edits allowed and with fewer: all are found."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    for n in (10, 30, 100, 300, 500):
        items = [(i, [rng.choice(vocabulary) for _ in range(n)]) for i in range(20)]
        index = dec.Index.build(items, 0.2, dec.tables_for(), dec.SAMPLES)
        for edits in (0.05, 0.1, 0.15, 0.2):
            docs = [text(rng, rng.randrange(1, 50), vocabulary).split() + edited(rng, words, int(edits * n), vocabulary) + text(rng, rng.randrange(1, 50), vocabulary).split() for _, words in items]
            ids = [np.array([index.vocabulary.get(w, 0) for w in d], np.int64) for d in docs]
            got = index.find(np.concatenate([*ids, np.zeros(1, np.int64)]), np.cumsum([len(i) for i in ids]))
            assert len({t for t, i, *_ in got if t == i}) >= 0.99 * len(items), (n, edits)


def test_repeated_items_and_clean_documents(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    item = text(rng, 20, vocabulary)
    bench = spark.createDataFrame([(1, item), (2, item), (None, item), (3, None), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + item), (1, text(rng, 30, vocabulary)), (None, item), (None, None), (5, "")], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    got = [(r.doc_id, r.item_id, r.distance) for r in dec.contaminated(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(d, i, 0) for d in (1, None) for i in (1, 2, None)], key=str)
    for block_chars in (dec.BLOCK_CHARS, 10):
        clean = dec.clean_documents(docs, bench, block_chars=block_chars)
        assert clean.columns == docs.columns
        kept = clean.collect()
        assert len(kept) == 3 and item not in {r.text for r in kept}
    assert dec.clean_documents(docs, bench.limit(0)).count() == 5


def test_shared_runs_without_a_match(spark):
    rng = random.Random(11)
    names = [f"w{i}" for i in range(3000)]
    for n in (10, 15, 30, 60, 300):
        items = [(n, text(rng, n, names))]
        item = items[0][1].split()
        docs = spark.createDataFrame([(1, " ".join(rng.sample(names, 30) + item[3:8] + rng.sample(names, 30)))], "doc_id long, text string")
        bench = spark.createDataFrame(items, "item_id long, text string")
        assert dec.contaminated(docs, bench).count() == (n == 10 and distance(item, dec.words(docs.first().text)) <= 2)
        assert dec.clean_documents(docs, bench).count() == 1
