import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from quern.llm import langid

SOUNDS = {"aa": ["the", "ing", "sh", "wh", "ou", "nd"], "bb": ["sch", "ei", "ung", "ö", "ich", "z"], "cc": ["ción", "ll", "ñ", "os", "que", "r"]}


def made(rng, n):
    rows = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        rows.append((i, " ".join("".join(rng.choices(SOUNDS[lang], k=3)) for _ in range(rng.randrange(3, 40))), lang, "s", 1))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = made(random.Random(4), 600)
    odd = [(9001, None, "aa", "s", 0), (9002, "", "aa", None, 0), (9003, "12 ?! ²½ _", "bb", "s", 0), (None, "schich ung zei", None, "s", 0), (9004, "schich ung zei" * 20000, None, None, None), (9005, "É", None, "s", 0), (3, *rows[3][1:])]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit("aa"))
    got = langid.language_of_documents(docs, fit_rows=100).collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows) + len(odd)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (9001, 9002, 9003))
    assert by[None].lang_pred == by[9004].lang_pred == "bb" and by[9005].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "the thing", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.language_of_documents(docs).collect()] == [(1, False, "und", 0.0)]
    assert langid.language_of_documents(docs.limit(0)).count() == 0


def test_counts_cover_the_whole_text():
    text = "Ab" * 500
    assert langid.gram_counts(text).sum() == 1000 + 999 + 998
    assert (langid.gram_counts(text) == langid.gram_counts(text.upper())).all() and langid.gram_counts("").sum() == 0


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3)) * 2
    label = np.array([rng.choice(3, p=p) for p in langid.softmax(logits)])
    assert 2.4 < langid.fit_temperature(logits * 3, label) < 3.6


def test_elastic_net_leaves_noise_at_zero():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    index = [np.unique(np.r_[k, rng.integers(2, 200, 3)]) for k in y]
    w = langid.fit_ftrl(index, [np.ones(len(i)) / 2 for i in index], y, 2, 200, l1=3.0)
    assert w[0, 0] > 0 and w[1, 1] > 0 and (w[2:200] == 0).mean() > 0.7


def test_languages_under_few_ids_are_learned(spark):
    """All documents of a language have one id, or none, and some are the same: every language is still drawn from."""
    rng = random.Random(3)
    rows = [(i, t, lang, s, n) for i, t, lang, s, n in made(rng, 900)]
    rows = [(i if lang == "aa" else None if lang == "bb" else 7, t, lang) for i, t, lang, _, _ in rows] + [(7, "que ción ll os que r", "cc")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, fit_rows=40)
    assert model.langs == ["aa", "bb", "cc"]
    got = langid.predict(spark.createDataFrame([(1, "the thing sh"), (2, "schich ung zei"), (3, "que ll os r")], "doc_id long, text string"), model)
    assert [r.lang_pred for r in got.orderBy("doc_id").collect()] == ["aa", "bb", "cc"]
    kept = langid.keep_identified(docs.unionByName(spark.createDataFrame([(7, "12 !", "aa"), (None, None, "aa"), (7, "", "bb")], docs.schema)), 0.0)
    assert kept.columns == docs.columns and kept.count() == docs.filter(~langid.held_out(F.col("doc_id"))).count() + docs.filter(langid.held_out(F.col("doc_id"))).count()


def slow_grams(text, buckets):
    counts = {}
    low = text.lower()
    for n in (1, 2, 3):
        for i in range(len(low) - n + 1):
            h = n
            for j, c in enumerate(low[i : i + n]):
                h = ((h ^ ord(c)) * int(langid._MULTIPLIERS[j])) & 0xFFFFFFFF
                h ^= h >> 15
            b = (h * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - (buckets.bit_length() - 1))
            counts[b] = counts.get(b, 0) + 1
    return counts


def test_against_brute_force(spark):
    """Frequencies, TF-IDF, steps of the training one weight at a time, temperature and predictions."""
    buckets, alpha, beta, l1, l2 = 1 << 8, 0.5, 1.0, 0.01, 0.01
    rows = [(i, t, lang) for i, t, lang, _, _ in made(random.Random(6), 45)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, buckets=buckets, fit_rows=1000)
    grams = {t: slow_grams(t, buckets) for _, t, _ in rows}
    df = [sum(b in grams[t] for _, t, _ in rows) for b in range(buckets)]
    idf = [1 + math.log((1 + len(rows)) / (1 + n)) for n in df]
    assert np.allclose(model.idf, idf)

    def features(text):
        x = {b: n * idf[b] for b, n in slow_grams(text, buckets).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {b: v / norm for b, v in x.items()}

    langs = sorted({r[2] for r in rows})
    order = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("draw", F.pmod(F.xxhash64("doc_id", "text", F.lit("fit")), F.lit(1 << 52))).collect()
    ranked = sorted((n, lang, r.text) for lang in langs for n, r in enumerate(sorted((r for r in order if r.lang == lang), key=lambda r: r.draw), 1))
    z, n = {}, {}

    def weight(b, k):
        zz, nn = z.get((b, k), 0.0), n.get((b, k), 0.0)
        return 0.0 if abs(zz) <= l1 else -(zz - math.copysign(l1, zz)) / ((beta + math.sqrt(nn)) / alpha + l2)

    def logits(x):
        return [sum(v * weight(b, k) for b, v in x.items()) for k in range(len(langs))]

    for _ in range(4):
        for place, lang, text in ranked:
            if place % 5 == 0:
                continue
            x = {**{b: float(np.float32(v)) for b, v in features(text).items()}, buckets: 0.1}
            p = langid.softmax(np.array(logits(x)))
            old = {(b, k): weight(b, k) for b in x for k in range(len(langs))}
            for b, v in x.items():
                for k in range(len(langs)):
                    g = v * (p[k] - (langs[k] == lang))
                    before = n.get((b, k), 0.0)
                    z[b, k] = z.get((b, k), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * old[b, k]
                    n[b, k] = before + g * g
    assert np.allclose(model.weights, [[weight(b, k) for k in range(len(langs))] for b in range(buckets + 1)], atol=1e-5)
    back = [(logits({**features(t), buckets: 0.1}), langs.index(lang)) for place, lang, t in ranked if place % 5 == 0]
    assert math.isclose(model.temperature, langid.fit_temperature(np.array([b[0] for b in back]), np.array([b[1] for b in back])), rel_tol=1e-3)
    for r in langid.predict(docs, model).collect():
        p = langid.softmax(np.array(logits({**features(rows[r.doc_id][1]), buckets: 0.1})) / model.temperature)
        assert r.lang_pred == langs[int(p.argmax())] and math.isclose(r.score, max(p), abs_tol=1e-4)
