import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
CASES = ["", "   ", "a" * 3000, "ab" * 1000, "<|endoftext|>x<|startoftext|> Y <|endoftext|>", "It's we'LL 12½² ΣΑΣ İ ſ é é\x1c\x85　x", "\u0000� 中文字 ßẞ"]


@pytest.fixture(scope="module")
def model():
    return bpe.Bpe(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(n):
    rng = random.Random(11)
    kinds = ["aeE sStT'nrth", "aàÀé´ sΣσ'́KſX\x1c\x85　\n123½²中ß!?.,<|>endoftxsr", "abcdefghinorst"]
    return CASES + ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_same_as_the_library(model, library):
    for text in texts(3000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("form", ["{} ", "a{}\u0323\u0334b "])
def test_every_code_point(model, library, form):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(form.format, points[i : i + 512])) for i in range(0, len(points), 512)]
    assert [model.encode(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_words(model, library):
    for text in ("e" * 300_000, "\u00e9\u4e2d" * 50_000, "." * 100_000):
        assert model.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_table(spark, library):
    rows = [(i, t) for i, t in enumerate(texts(200))] + [(7, None), (None, "no id"), (7, "twice"), (7, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")).withColumn("ids", F.lit(0))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = bpe.encode_digests(docs, PATH)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    whole = bpe.encode_ids(docs, PATH).filter("doc_id = 2").first()
    assert whole.ids == library.encode(CASES[2], add_special_tokens=False).ids
    assert bpe.encode_digests(docs.limit(0), PATH).count() == 0
