import hashlib
import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from quern.llm import decontaminate, secrets
from tests.llm.test_simhash import brute as groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SOUNDS = {"aa": ["the", "ing", "sh", "wh", "ou", "nd"], "bb": ["sch", "ei", "ung", "ich", "z"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SOUNDS[lang], k=3)) for _ in range(n))


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, prose(rng, lang := rng.choice(list(SOUNDS)), rng.randrange(30, 90)), lang, "s", 1) for i in range(120)]
    items = [(i, prose(rng, "aa", 20)) for i in range(5)]
    rows += [(200 + i, rows[i][1], rows[i][2], None, 2) for i in range(10)]
    rows += [(300 + i, prose(rng, "aa", 20) + " " + items[i][1].upper(), "aa", "t", 3) for i in range(5)]
    rows += [(400, None, None, None, None), (401, "", "aa", "s", 0), (402, "12 34 !?", "bb", "s", 8), (403, prose(rng, "aa", 40) + " token=abcdefgh12 " + prose(rng, "aa", 9), "aa", "s", 5), (404, prose(rng, "bb", 30), None, "s", None), (5, rows[5][1], rows[5][2], "again", 1)]
    rows += [(6, prose(rng, "aa", 50), "aa", "shares an id", 7), (None, prose(rng, "bb", 50), "bb", "no id", 7), (None, prose(rng, "aa", 50), "aa", "no id", 8), (None, rows[9][1], "aa", "a copy", 9), (7, "", "aa", "shares an id", 0), (8, items[2][1], "aa", "shares an id", 1)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], name
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept.append([tuple(r) for r in docs.collect()])
    known = {r[0] for r in kept[0]}
    assert {400, 401, 402} & known == set() and len(kept[0]) >= len(rows) - 7 and not any(r[1] == "" for r in kept[0])
    number = {r: n for n, r in enumerate(sorted(kept[0], key=lambda r: (r[0] is None, r[0] or 0, str(r))))}  # the smallest id first
    want = {c for _, _, c in groups([(n, r[1]) for r, n in number.items()])}
    assert sorted(number[r] for r in kept[1] if r[0] != 5) == sorted(n for r, n in number.items() if n in want and r[0] != 5)
    assert [r[0] for r in kept[1]].count(5) == 1 and [r[0] for r in kept[1]].count(6) == 2 and [r[0] for r in kept[1]].count(None) == 2
    assert not {r[0] for r in kept[1]} & set(range(200, 210))
    clean = [r for r in kept[1] if not any(decontaminate.best_alignment(*(decontaminate.np.array([hash(w) for w in decontaminate.words(t)]) for t in (text, r[1])))[0] <= int(0.2 * 20) for _, text in items)]
    assert sorted(map(str, kept[2])) == sorted(map(str, clean)) and not {r[0] for r in clean} & set(range(300, 305))
    assert sum(r[0] == 8 for r in clean) == 1 and sum(r[0] is None for r in clean) == 2
    assert sorted(map(str, ((r[0], r[1]) for r in kept[3]))) == sorted(map(str, ((r[0], secrets.redact(r[1], secrets.all_spans(r[1]))) for r in clean)))
    by = {(r[0], r[1]): r for r in kept[3]}
    hidden = next(r for r in kept[3] if r[0] == 403)
    assert "[secret]" in hidden[1] and "abcdefgh12" not in hidden[1] and hidden[4] == len(hidden[1])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    final = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    want = []
    for doc_id, text in by:
        ids = library.encode(text, add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_sha256) for r in final))) == sorted(map(str, want))
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, final))


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_registered():
    names = list(__spark_entry__.queries())
    assert [n for n in names if n.startswith("op")] == sorted((n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert sum(n.startswith("op") for n in names) == 13 and "pipeline" in names


def test_top_k_against_sql(spark):
    from quern.llm import queries
    from tests.oracle import compare

    for name, sql in queries.ORACLES.items():
        assert compare(spark, name, queries.QUERIES[name], sql, "/root/testdata/sf0.001") is None


def test_every_query_gives_a_row_per_document(spark):
    from quern.llm import queries

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in ("op2_language_id", "op3_simhash_near_dedup", "op4_secret_scan", "op5_class_lm_score", "op7_suffix_dedup", "op9_bpe_encode_decode", "op12_periodic_runs", "op13_token_alignment"):
        got = queries.QUERIES[name](spark, folder).select("doc_id")
        assert got.exceptAll(docs.select("doc_id")).isEmpty() and docs.select("doc_id").exceptAll(got).isEmpty(), name
    held = queries.op2_language_id(spark, folder).filter("held_out").join(docs, "doc_id").filter("lang is not null")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.9
