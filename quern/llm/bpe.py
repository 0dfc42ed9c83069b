"""BPE encoding and decoding by dynamic programming over prefixes."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import slices

#: Words whose ids a Python worker keeps, pairs of tokens that it knows to fit or not, and the longest word kept. When half
#: of the words are new it forgets those of the other half that it did not meet since; of pairs it starts anew (results
#: don't depend on it).
KEPT_WORDS = 200_000
KEPT_PAIRS = 500_000
KEPT_CHARS = 200
#: Python's white space that the pattern's \\s does not count.
_ODD_SPACE = regex.compile("[\\x1c-\\x1f]")
_SPACE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Where the library's Unicode tables differ from Python's. Its pattern engine does not yet know these as
# letters and numbers, its normal form takes these marks for letters of their own (they are newer than its tables; one
# letter with a decomposition is too), and its lower case is newer than Python's.
_NO_LETTER = "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
_NO_NUMBER = "\U00011de0-\U00011de9\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ff4-\U00016ff6"
_NEW_MARKS = "\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c\U00010d24-\U00010d27\U00010eab-\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50\U00010f82-\U00010f85\U00011070\U0001133b\U0001145e\U00011839-\U0001183a\U00011930\U00011938\U0001193d-\U0001193e\U00011943\U000119e0\U00011a34\U00011a47\U00011a99\U00011d42\U00011d44-\U00011d45\U00011d97\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef"
_NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_MARKS = regex.compile(f"([{_NEW_MARKS}])")
_ODD = regex.compile(f"[{_NO_LETTER}{_NO_NUMBER}{_NEW_MARKS}{''.join(map(chr, _NEW_LOWER))}]")
_LAST = 0x10000  # added to a word's last symbol where the vocabulary has word ends


def _byte_symbols() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Bpe:
    """One vocabulary. A text is split into words by the pattern; each word's tokens are found prefix by prefix: the
    automaton over the vocabulary gives the tokens that end at a position, and the one that may follow the last token
    of the prefix before it is that prefix's last token. There is exactly one, so following the back-pointers from
    the end gives the ids that merging pair by pair would give."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        self._check(model)
        bpe = model["model"]
        self.end = bpe.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = bpe["vocab"]
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.token = {i: t for t, i in {**self.vocab, **self.specials}.items()}
        pattern = next(p for p in model["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        pattern = pattern.replace("\\s", _SPACE)  # the only \s of the pattern is in a class
        self.find = regex.compile(pattern).findall
        narrow = regex.sub(r"\[(\^?)([^\]]*)\]", lambda m: f"[{m[1]}[{m[2]}]--[{_NO_LETTER}{_NO_NUMBER}]]" if not m[1] else f"[[^{m[2]}]||[{_NO_LETTER}{_NO_NUMBER}]]", pattern)
        self.find_odd = regex.compile(narrow, regex.V1).findall  # the same for texts with characters that its engine does not know
        self.spaces = regex.compile(f"[{_SPACE}]+")
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")").split if self.specials else None
        self.symbols = _byte_symbols()
        rank: dict[tuple[int, int], int] = {}
        self.rank = [-1] * (max(self.vocab.values()) + 1)
        self.parts: list[tuple[int, int] | None] = [None] * len(self.rank)
        self.merged: dict[tuple[int, int], int] = {}
        for n, pair in enumerate(bpe["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made, key = self.vocab[left + right], (self.vocab[left], self.vocab[right])
            if key not in rank:
                rank[key] = n
                self.merged[key] = n
            if self.parts[made] is None:
                self.parts[made], self.rank[made] = key, n
        self.fits: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.vocab.items():
            parts = self.parts[i]
            form = self._form(token)
            if parts is None and len(form) == 1 or parts is not None and self.compatible(*parts, below=self.rank[i]):
                self.automaton.add_word(form, (i, len(form)))
        self.automaton.make_automaton()
        self.kept = KEPT_WORDS
        self.known: dict[str, tuple[str, str, int]] = {}
        self.chunks: dict[str, tuple[str, str, int]] = {}
        self.known_before, self.chunks_before = self.known, self.chunks

    @staticmethod
    def _check(model: dict) -> None:
        steps = [n["type"] for n in model["normalizer"]["normalizers"]]
        cut = [p["type"] for p in model["pre_tokenizer"]["pretokenizers"]]
        if model["model"]["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or cut != ["Split", "ByteLevel"] or model["decoder"]:
            raise ValueError("only word BPE (NFC, spaces, lower case; split, byte level; no decoder) is supported")

    def _form(self, token: str) -> str:
        """One character per symbol; the last of a word is shifted."""
        if self.end and token.endswith(self.end):
            token = token[: -len(self.end)]
            return token[:-1] + chr(ord(token[-1]) + _LAST)
        return token

    def compatible(self, left: int, right: int, below: int = 1 << 60) -> bool:
        """Whether merging leaves left and right apart when they stand side by side, merges of rank `below` and later
        aside: undo the merges next to the seam, latest first; no pair met on the way may have a merge that comes
        before the one which took it apart."""
        key = (left, right)
        if below == 1 << 60 and (known := self.fits.get(key)) is not None:
            return known
        a, b, limit, ok = left, right, (below, 0), True
        while True:
            n = self.merged.get((a, b))
            # of two merges of one rank the left one is first: the seam's merge goes before one on its right only
            if n is not None and (n, 0) < limit:
                ok = False
                break
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                limit = (ra, 0)
                a = self.parts[a][1]
            else:
                limit = (rb, 1)
                b = self.parts[b][0]
        if below == 1 << 60:
            if len(self.fits) > KEPT_PAIRS:
                self.fits.clear()
            self.fits[key] = ok
        return ok

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word of the pattern."""
        form = "".join([self.symbols[b] for b in word.encode()])
        if self.end:
            form = form[:-1] + chr(ord(form[-1]) + _LAST)
        last: list[tuple[int, int] | None] = [None] * len(form)
        fits, compatible = self.fits, self.compatible
        for at, (token, size) in self.automaton.iter(form):
            if last[at] is not None:
                continue
            before = at - size
            if before < 0:
                last[at] = (token, size)
            elif (prior := last[before]) is not None:
                pair = (prior[0], token)
                if fits[pair] if pair in fits else compatible(*pair):
                    last[at] = (token, size)
        ids, at = [], len(form) - 1
        while at >= 0:
            token, size = last[at]
            ids.append(token)
            at -= size
        return ids[::-1]

    def _word(self, word: str) -> tuple[str, str, int]:
        made = self.known_before.get(word)
        if made is None:
            ids = self.encode_word(word)
            made = (" ".join(map(str, ids)), " ".join([self.token[i] for i in ids]), len(ids))
        if len(word) <= KEPT_CHARS:
            if len(self.known) >= self.kept // 2:
                self.known_before, self.known = self.known, {}
            self.known[word] = made
        return made

    def normal(self, piece: str) -> str:
        if piece.isascii():
            return piece.lower()
        if _ODD.search(piece):
            parts = [unicodedata.normalize("NFC", p) for p in _MARKS.split(piece)]
            piece = "".join(parts).translate(_NEW_LOWER)
        else:
            piece = unicodedata.normalize("NFC", piece)
        return piece.replace("Σ", "σ").lower()  # each character by itself, whatever its place in a word

    def words(self, text: str) -> list[str]:
        """Words of the pattern in a normal text."""
        return (self.find if text.isascii() or not _ODD.search(text) else self.find_odd)(text)

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """What lies between special tokens, and the special tokens themselves, which count as they stand."""
        for n, piece in enumerate(self.split(text) if self.split else [text]):
            if piece:
                yield piece, bool(n % 2)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece, special in self.pieces(text):
            if special:
                ids.append(self.specials[piece])
            else:
                for w in self.words(self.spaces.sub(" ", self.normal(piece))):
                    ids += self.encode_word(w)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, word ends and byte symbols left as they are, as without a decoder."""
        return " ".join([self.token[i] for i in ids])

    def _chunk(self, chunk: str) -> tuple[str, str, int]:
        """Ids of what stands between white space, which no word of the pattern crosses."""
        made = self.chunks.get(chunk) or self.chunks_before.get(chunk)
        if made is None:
            words = [self.known.get(w) or self._word(w) for w in self.words(chunk)]
            made = words[0] if len(words) == 1 else (" ".join([w[0] for w in words]), " ".join([w[1] for w in words]), sum([w[2] for w in words]))
        if len(chunk) <= KEPT_CHARS:
            if len(self.chunks) >= self.kept // 2:
                self.chunks_before, self.chunks = self.chunks, {}
            self.chunks[chunk] = made
        return made

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids in decimal and of the decoded text."""
        made = []
        for piece, special in self.pieces(text):
            if special:
                made.append((str(self.specials[piece]), piece, 1))
                continue
            low = self.normal(piece)
            parts = self.spaces.split(low) if _ODD_SPACE.search(low) else low.split()
            get, miss = self.chunks.get, self._chunk
            made += [get(c) or miss(c) for c in parts if c]
        ids, tokens = " ".join([m[0] for m in made]), " ".join([m[1] for m in made])
        return sum([m[2] for m in made]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(tokens.encode()).hexdigest()


@lru_cache(maxsize=2)
def _loaded(spec: str, kept: int = KEPT_WORDS) -> Bpe:
    made = Bpe(spec)
    made.kept = kept
    return made


def _spec(docs: DataFrame, vocabulary: str):
    """The vocabulary file, read on the driver and broadcast: its size does not depend on the data."""
    with open(vocabulary, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode_ids(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) for every row: the token ids themselves. Null texts count as empty."""
    spec = _spec(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value)
        for batch in slices(batches):
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(bpe.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", kept_words: int = KEPT_WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row, repeated ones and null ids included.

    Null and empty texts have no ids: n_tokens 0 and the digest of the empty string. Other columns are ignored.
    kept_words: what a worker remembers; fewer take less memory and more time, and give the same results."""
    spec = _spec(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value, kept_words)
        for batch in slices(batches):
            made = [bpe.digest(t or "") for t in batch.column(1).to_pylist()]
            n, ids, decoded = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
