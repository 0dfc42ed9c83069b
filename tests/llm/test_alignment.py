import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm import alignment as al

ONE, TWO = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
POOL = ["the", "Hello", "unbelievable", " ", "  ", "   ", "\n", "\t", "é", "ﬁ", "½", "✓", "日本語", "　", "\xa0", "🙂", "<|endoftext|>", "<unk>", "<s>", "</s>", "<0x41>", "1234567", "'s", "...", "\x00", "ſ", "á", "‍", "zzzzqqqq", "Ġ", "x" * 60]


def brute(rows):
    """The contract, token by token, with the libraries themselves."""
    one = Tokenizer.from_file(ONE)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=TWO)
    alphabet = al.byte_alphabet()
    docs = []
    for _, text in rows:
        whole = f" {text or ''}".encode()
        a = one.encode(f" {text or ''}", add_special_tokens=False).ids
        b = two.encode(text or "")
        bytes_a = [bytes(alphabet[c] for c in one.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        docs.append((a, b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()) if text and b"".join(bytes_a) == whole == b"".join(bytes_b) else ([], [], [], []))
    links = [[(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if ends_a[i] == ends_b[j]] for a, b, ends_a, ends_b in docs]
    counts = Counter(p for x in links for p in x)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (doc_id, _), (a, b, ends_a, ends_b), own in zip(rows, docs, links):
        cuts = sorted(set(ends_a) & set(ends_b))
        low, parts = 0, []
        for c in cuts:
            parts.append(",".join(str(x) for x, e in zip(a, ends_a) if low < e <= c) + "|" + ",".join(str(x) for x, e in zip(b, ends_b) if low < e <= c))
            low = c
        out.append((doc_id, len(a), len(b), len(cuts), len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def some_rows():
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(POOL) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    return rows + [(1, "twice the same"), (1, "twice the same"), (None, "no id"), (None, None), (500, None), (501, ""), (502, " "), (503, "a▁b"), (504, "▁"), (505, "tail  "), (506, "  x")]


def test_against_brute_force(spark):
    rows = some_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({"no": F.lit("clash"), "pair": F.lit(None), "pairs": F.lit(1)})
    want = brute(rows)
    assert sum(w[1] == 0 for w in want) >= 6
    for share in (al.SHARE, 0.01, 2.0):  # pairs looked up, joined in part, and all joined
        got = al.aligned_documents(docs, ONE, TWO, P.PATTERN, share=share)
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert al.aligned_documents(docs.limit(0), ONE, TWO, P.PATTERN).count() == 0


def test_groups_are_the_text(spark):
    rows = [(i, t) for i, (_, t) in enumerate(some_rows())]
    got = al.token_groups(spark.createDataFrame(rows, "doc_id long, text string"), ONE, TWO, P.PATTERN).collect()
    coders = al._coders(open(ONE, "rb").read(), open(TWO, "rb").read(), P.PATTERN)
    digests = {d: [] for d, _ in rows}
    for r in got:
        text = f" {rows[r.doc_id][1]}".encode()[r.start : r.stop]
        assert text == b"".join(coders[0].bytes[i] for i in r.a_ids) == b"".join(coders[1].bytes[i] for i in r.b_ids) and text
        assert r.group == len(digests[r.doc_id])
        digests[r.doc_id].append(",".join(map(str, r.a_ids)) + "|" + ",".join(map(str, r.b_ids)))
    want = {r.doc_id: (r.n_groups, r.groups_sha256) for r in al.aligned_documents(spark.createDataFrame(rows, "doc_id long, text string"), ONE, TWO, P.PATTERN).collect()}
    assert want == {d: (len(x), hashlib.sha256(";".join(x).encode()).hexdigest() if x else "") for d, x in digests.items()}


def test_overlaps_are_all_pairs_that_share_bytes():
    rng = np.random.default_rng(1)
    size_a, size_b, doc_a, doc_b = [], [], [], []
    for d in range(30):
        n = int(rng.integers(1, 40))
        for sizes, docs in ((size_a, doc_a), (size_b, doc_b)):
            cuts = np.unique(np.r_[0, rng.integers(0, n, 8), n])
            sizes += np.diff(cuts).tolist()
            docs += [d] * (len(cuts) - 1)
    x = al.align(np.arange(len(size_a)), np.arange(len(size_b)), *map(np.array, (size_a, size_b, doc_a, doc_b)))
    begin_a, begin_b = x.end_a - size_a, x.end_b - size_b
    want = {(i, j) for i in range(len(size_a)) for j in range(len(size_b)) if begin_a[i] < x.end_b[j] and begin_b[j] < x.end_a[i]}
    got = list(zip(*(p.tolist() for p in x.overlaps)))
    assert set(got) == want and len(got) == len(want)
    assert list(zip(*(p.tolist() for p in x.links))) == sorted((i, j) for i, j in want if x.end_a[i] == x.end_b[j])


def test_both_coders_agree_with_the_libraries():
    one = Tokenizer.from_file(ONE)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=TWO)
    mine = al.ByteCoder(open(ONE, "rb").read(), P.PATTERN), al.PieceCoder(open(TWO, "rb").read())
    chars = [chr(c) for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c} 1{c}1 {c}{c}  {c}\n{c}" for c in chars]
    rng = random.Random(3)
    texts += ["".join(rng.choice(POOL) for _ in range(30)) for _ in range(300)]
    for text, want, pieces in zip(texts, one.encode_batch([f" {t}" for t in texts], add_special_tokens=False), two.encode(texts)):
        assert mine[0].encode(text) == want.ids, text
        got = mine[1].encode(text)
        assert got == pieces if got is not None else b"".join(mine[1].bytes[i] for i in pieces) != f" {text}".encode(), text


def test_long_texts(spark):
    text = "word " * 300_000 + " " * 200_000 + "z" * 300_000
    row = al.aligned_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), ONE, TWO, P.PATTERN).first()
    assert row.n_links == row.n_groups and row.n_a > 300_000
