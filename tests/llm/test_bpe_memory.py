import public_tokenizers

from quern.llm import bpe


def test_words_that_come_again_are_not_forgotten():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    small, whole = bpe.Bpe(spec), bpe.Bpe(spec)
    small.kept = 20
    encoded, encode = [], small.encode_word
    small.encode_word = lambda word: encoded.append(word) or encode(word)
    for i in range(60):
        text = f"again and again, word{chr(97 + i % 26)}{chr(97 + i // 26)}x"
        assert small.digest(text) == whole.digest(text)
        assert max(map(len, (small.known, small.chunks))) <= 10
    assert encoded.count("again") == encoded.count("and") == 1
