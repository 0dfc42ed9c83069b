import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from quern.llm import tokencount as tc

PATH = P.path("byte_bpe_50k.tiktoken")


def brute(text, rule):
    coder = tc._encoding(open(PATH, "rb").read(), P.PATTERN)[0]
    sections = text.splitlines(keepends=True) if "\n" in text and not any(c in text for c in "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029") else None
    ends, at = [], 0
    for line in sections if sections is not None else [text]:
        at += len(line.encode())
        ends.append(at)
    owner = [next(s for s, e in enumerate(ends) if b < e) for b in range(at)] if text else []
    n, crossing, at = [0] * len(ends), [0] * len(ends), 0
    for token in coder.encode_ordinary(text):
        size = len(coder.decode_single_token_bytes(token))
        own = owner[at : at + size]
        pick = own[0] if rule == "start" else own[-1] if rule == "end" else max(sorted(set(own)), key=own.count)
        n[pick] += 1
        crossing[pick] += len(set(own)) > 1
        at += size
    return n, crossing


TEXTS = ["", "one line", "two\nlines\n", "\n\n\n  \n x", "é\n日本語 text\n\n\t\tcode  here\n   more", "a" * 3000 + "\n" + "b\n" * 50]


@pytest.mark.parametrize("rule", tc.RULES)
def test_against_brute_force(spark, rule):
    rows = [*enumerate(TEXTS), (8, None), (None, TEXTS[2]), (2, TEXTS[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("section", F.lit("clash")).withColumn("n_tokens", F.lit(0))
    got = tc.section_tokens(docs, PATH, P.PATTERN, rule=rule).collect()
    want = [(d, i, n, c) for d, t in rows for i, (n, c) in enumerate(zip(*brute(t or "", rule)))]
    assert sorted(((r.doc_id, r.section, r.n_tokens, r.n_crossing) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        if r.doc_id == 4:
            assert TEXTS[4][r.start : r.stop].endswith("\n") or r.stop == len(TEXTS[4])
    assert tc.section_tokens(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_counts_add_up_to_the_library():
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=tc._encoding(open(PATH, "rb").read(), P.PATTERN)[0]._mergeable_ranks, special_tokens={})
    for text in TEXTS:
        assert sum(brute(text, "start")[0]) == len(coder.encode_ordinary(text))


@pytest.mark.parametrize("text", [" " * 10_000_000, "x" + "\n" * 10_000_000 + "y", "a" * 10_000_000, "1" * 3_000_000, ("x" + "\u3000 " * 3000 + "\n") * 300])
def test_very_long_stretches(text):
    encoding = tc._encoding(open(PATH, "rb").read(), P.PATTERN)
    ids = tc.encode(encoding, text)
    assert encoding[0].decode(ids) == text


def test_long_white_space_is_cut_where_the_pattern_cuts():
    encoding = tc._encoding(open(PATH, "rb").read(), P.PATTERN)
    for space in (" ", "\n", "\t \u3000", "\x1c", "\r\n"):
        for n in (4095, 4096, 4097, 20000):
            stretch = (space * n)[:n]
            for text in (stretch, stretch + "word", f"a {stretch}'s b", f"1{stretch}\u00e9{stretch}", f"{stretch}.{stretch}"):
                assert tc.encode(encoding, text) == encoding[0].encode_ordinary(text)


@pytest.mark.parametrize("rule", tc.RULES)
def test_fields(spark, rule):
    rows = [(1, "Some title", "and a body\n", 3), (2, None, "", None), (None, "\u00e9", None, 12345), (2, "x" * 50, "  y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, head string, body string, number int").withColumn("field", F.lit("clash"))
    coder = tc._encoding(open(PATH, "rb").read(), P.PATTERN)[0]
    for separator in ("\n", ""):
        got = tc.field_tokens(docs, ["head", "body", "number"], PATH, P.PATTERN, separator=separator, rule=rule).collect()
        assert [r.field for r in got] == ["head", "body", "number"] * 4
        want = []
        for _, *fields in rows:
            parts = [("" if f is None else str(f)) + (separator if i < 2 else "") for i, f in enumerate(fields)]
            owner, n, at = [i for i, p in enumerate(parts) for _ in p.encode()], [0] * 3, 0
            for token in coder.encode_ordinary("".join(parts)):
                size = len(coder.decode_single_token_bytes(token))
                own = owner[at : at + size]
                n[own[0] if rule == "start" else own[-1] if rule == "end" else max(sorted(set(own)), key=own.count)] += 1
                at += size
            want += n
        assert [r.n_tokens for r in got] == want
    with pytest.raises(ValueError):
        tc.field_tokens(docs, [], PATH, P.PATTERN)


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        tc.section_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN, rule="none")
