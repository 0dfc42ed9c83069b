"""Alignment of two tokenizers' tokens: pandas merge_asof from each side's token starts to the other's covering tokens.

Each batch of documents is encoded by both tokenizers; token bytes of both sides add up to the same text, so tokens have
places in bytes. The union of both directions' matches is every pair of tokens that overlap; pairs that end together
link, and their ends cut a document into groups. Counts of linked ids are summed over the corpus: pairs of ids that make
up a millionth of all links are few and looked up in a broadcast table, all others by a join."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import tokencount
from quern.llm.shared import cut, slices

#: Pairs of ids that make up this share of all links are looked up in tasks; there are at most 1 / SHARE of them.
SHARE = 2.0**-20
#: Characters of text that are aligned as one batch, about; distinct pairs that a task counts before it hands them on;
#: segments that a coder remembers, and their characters at most.
_BATCH = 1 << 20
_COUNTED = 1 << 20
_SEGMENTS, _SEGMENT = 1 << 17, 48


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is visible in Latin-1, else the
    next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteCoder:
    """Byte-level BPE from a tokenizer file whose merges have ascending ids. Special tokens are plain text."""

    def __init__(self, spec: bytes, pattern: str):
        model = json.loads(spec)
        special = {t["content"] for t in model["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(map(alphabet.__getitem__, token)): i for token, i in model["model"]["vocab"].items() if token not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        ids = [ranks[bytes(map(alphabet.__getitem__, "".join(p)))] for p in pairs]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            raise ValueError("merges must have ascending ids")
        self.size = max(ranks.values()) + 1
        self.bytes = [b""] * self.size
        for token, i in ranks.items():
            self.bytes[i] = token
        whole = tiktoken.Encoding("whole", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.coder = (tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), None, whole)

    def encode(self, text: str) -> list[int]:
        """Ids of a space and the text."""
        return tokencount.encode(self.coder, f" {text}")


class PieceCoder:
    """Pieces with byte fallback. As no piece goes on over a space, segments of spaces and what follows them are encoded
    by themselves, and common ones are remembered."""

    def __init__(self, spec: bytes):
        self.coder = sentencepiece.SentencePieceProcessor(model_proto=spec)
        pieces = [self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece goes on over a space")
        self.size = len(pieces)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.coder.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = [self.coder.piece_to_id("▁")]
        self.known: dict[str, list[int] | None] = {}

    def _segment(self, segment: str) -> list[int] | None:
        ids = self.coder.encode(segment[1:]) if len(segment) > 1 else self.space  # the coder adds one space
        if b"".join([self.bytes[i] for i in ids]) != segment.encode():
            ids = None
        if len(segment) <= _SEGMENT:
            if len(self.known) >= _SEGMENTS:
                self.known.clear()
            self.known[segment] = ids
        return ids

    def encode(self, text: str) -> list[int] | None:
        """Ids of a space and the text; None if they stand for other bytes."""
        segments = _SEGMENTS_OF.findall(f" {text}")
        get, out = self.known.get, []
        for segment in segments:
            ids = get(segment) or self._segment(segment)
            if ids is None:
                return None
            out.append(ids)
        return list(chain.from_iterable(out))


_SEGMENTS_OF = re.compile(" +[^ ]*")


@dataclass
class Aligned:
    """Tokens of some documents: ids, the document's number and byte offsets (counted through) of both sides; tokens
    that overlap, and those that end together, as pairs of token numbers, ascending."""

    a: np.ndarray
    b: np.ndarray
    doc_a: np.ndarray
    doc_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    overlaps: tuple[np.ndarray, np.ndarray]
    links: tuple[np.ndarray, np.ndarray]


def align(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray) -> Aligned:
    """Each side's token starts take the other side's covering token of the same document; the union of both directions
    are all overlaps, and those with equal ends the links."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    left = pd.DataFrame({"start": end_a - size_a, "doc": doc_a, "token": np.arange(len(a))})
    right = pd.DataFrame({"start": end_b - size_b, "doc": doc_b, "token": np.arange(len(b))})
    over_a = pd.merge_asof(left[["start", "doc"]], right, on="start", by="doc")["token"].to_numpy(np.int64)
    over_b = pd.merge_asof(right[["start", "doc"]], left, on="start", by="doc")["token"].to_numpy(np.int64)
    later = np.flatnonzero(left["start"].to_numpy()[over_b] != right["start"].to_numpy())  # equal starts are there already
    i, j = np.concatenate([np.arange(len(a)), over_b[later]]), np.concatenate([over_a, later])
    same = np.flatnonzero(end_a[i] == end_b[j])
    same = same[np.argsort(i[same], kind="stable")]
    return Aligned(a, b, doc_a, doc_b, end_a, end_b, (i, j), (i[same], j[same]))


@lru_cache(maxsize=2)
def _coders(spec_a: bytes, spec_b: bytes, pattern: str) -> tuple:
    one, two = ByteCoder(spec_a, pattern), PieceCoder(spec_b)
    sizes = [np.array([len(t) for t in c.bytes], np.int64) for c in (one, two)]
    words = [f"{i}{c}" for i in range(one.size) for c in ",|"] + [f"{i}{c}" for i in range(two.size) for c in ",;"]
    return one, two, *sizes, words


def _aligned(batches: Iterator[pa.RecordBatch], coders: tuple) -> Iterator[tuple[pa.Array, Aligned]]:
    """Documents' ids and their aligned tokens, in batches of some _BATCH characters."""
    one, two, sizes_a, sizes_b, _ = coders

    def settle(texts: list[str]) -> Aligned:
        ids_a, ids_b = [], []
        for text in texts:
            b = two.encode(text) if text else None
            a = one.encode(text) if b else []
            ids_a.append(a), ids_b.append(b or [])
        n_a, n_b = [len(x) for x in ids_a], [len(x) for x in ids_b]
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, sum(n)) for x, n in ((ids_a, n_a), (ids_b, n_b)))
        doc = np.arange(len(texts))
        return align(a, b, sizes_a[a], sizes_b[b], np.repeat(doc, n_a), np.repeat(doc, n_b))

    for batch in slices(batches):
        ids, texts, size, at = batch.column(0), [], 0, 0
        for i, text in enumerate(batch.column(1)):
            text = text.as_py() or ""
            if texts and size + len(text) > _BATCH:
                yield ids.slice(at, i - at), settle(texts)
                texts, size, at = [], 0, i
            texts.append(text)
            size += len(text)
        if texts:
            yield ids.slice(at), settle(texts)


def _lists(flat: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, kind))


def _bounds(numbers: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(numbers, np.arange(n + 1))


def _group_rows(specs, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(*specs.value, pattern)
        for ids, x in _aligned(batches, coders):
            i, j = x.links
            doc = x.doc_a[i]
            first = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.empty(0, bool)
            number = np.arange(len(doc)) - np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
            begin = np.where(first, np.r_[0, x.end_a[i]][: len(i)], np.r_[0, x.end_a[i][:-1]][: len(i)])
            base = np.maximum.accumulate(np.where(first, begin, 0)) if len(doc) else begin
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [ids.take(rows), pa.array(number), pa.array(begin - base), pa.array(x.end_a[i] - base), _lists(x.a, np.r_[0, i + 1], pa.int64()), _lists(x.b, np.r_[0, j + 1], pa.int64())],
                ["doc_id", "group", "start", "stop", "a_ids", "b_ids"],
            )

    return run


_GROUPS = "doc_id long, group long, start long, stop long, a_ids array<long>, b_ids array<long>"
_DOCS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def _summaries(specs, pattern: str):
    """Counts and digest of each document's groups, and its linked pairs of ids with how often each stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(*specs.value, pattern)
        size_a, size_b, words = coders[0].size, coders[1].size, coders[4]
        for ids, x in _aligned(batches, coders):
            n, (i, j) = len(ids), x.links
            last_a, last_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
            last_a[i], last_b[j] = 1, 1
            # written group by group: before a token stand those of its side before it, and the other side's of all
            # groups before (for the first side) or up to its own
            place = np.r_[np.arange(len(x.a)) + np.r_[0, j + 1][np.cumsum(last_a) - last_a], np.arange(len(x.b)) + np.r_[i + 1, 0][np.cumsum(last_b) - last_b]]
            order = np.empty(len(place), np.int64)
            order[place] = np.r_[2 * x.a + last_a, 2 * size_a + 2 * x.b + last_b]
            written = list(map(words.__getitem__, order.tolist()))
            cuts_a, cuts_b, cuts = _bounds(x.doc_a, n), _bounds(x.doc_b, n), _bounds(x.doc_a[i], n)
            both = (cuts_a + cuts_b).tolist()
            digests = [hashlib.sha256("".join(written[p:q])[:-1].encode()).hexdigest() if q > p else "" for p, q in zip(both, both[1:])]
            pair = size_b * x.a[i] + x.b[j]
            key, times = np.unique(x.doc_a[i] * (size_a * size_b) + pair, return_counts=True)
            linked = pa.array(np.diff(cuts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(np.diff(cuts_a), pa.int64()), pa.array(np.diff(cuts_b), pa.int64()), linked, linked, pa.array(digests, pa.string()),
                    _lists(key % (size_a * size_b), (own := _bounds(key // (size_a * size_b), n)), pa.int64()), _lists(times, own, pa.int32()),
                ],
                [f.split()[0] for f in _DOCS.split(", ")],
            )

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of times per pair, of as many rows at once as have _COUNTED pairs."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def summed() -> tuple[np.ndarray, np.ndarray]:
        pair, number = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return pair, np.bincount(number, np.concatenate([h[1] for h in held]), len(pair)).astype(np.int64)

    for batch in slices(batches):
        held.append((batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()))
        if sum(len(h[0]) for h in held) > _COUNTED:
            held = [summed()]
            if len(held[0][0]) > _COUNTED // 2:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), ["pair", "n"])
                held = []
    if held:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, summed())), ["pair", "n"])


def _look_up(table):
    """Per document the sums over its pairs that the table has (pair null), and a row for each that it doesn't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = table.value
        for batch in slices(batches):
            lists, times = batch.column(1), batch.column(2).flatten().to_numpy().astype(np.int64)
            asked = lists.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(pair, asked), len(pair) - 1) if len(pair) else np.zeros(len(asked), np.int64)
            known = pair[at] == asked if len(pair) else np.zeros(len(asked), bool)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row[known], times[known] * best[at[known]])
            np.add.at(sums[1], row[known], times[known] * n[at[known]])
            none, own = pa.nulls(batch.num_rows, pa.int64()), pa.array(row[~known])
            yield pa.RecordBatch.from_arrays([batch.column(0), none, none, *map(pa.array, sums)], ["no", "pair", "times", "n_best", "count_sum"])
            none = pa.nulls(len(own), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), pa.array(asked[~known]), pa.array(times[~known]), none, none], ["no", "pair", "times", "n_best", "count_sum"])

    return run


def _specs(docs: DataFrame, vocabulary_a: str, vocabulary_b: str):
    read = []
    for path in (vocabulary_a, vocabulary_b):
        with open(path, "rb") as f:
            read.append(f.read())
    return docs.sparkSession.sparkContext.broadcast(tuple(read)), len(PieceCoder(read[1]).bytes)  # of a size that no data changes


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def token_groups(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, group, start, stop, a_ids, b_ids): the stretches of a space and every whole text between places where a
    token of both sides ends, in bytes, with each side's ids. Texts without tokens, see aligned_documents, have none."""
    specs, _ = _specs(docs, vocabulary_a, vocabulary_b)
    return _rows(docs, id_col, text_col).mapInArrow(_group_rows(specs, pattern), _GROUPS)


def aligned_documents(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Both sides encode a space and the whole text, special tokens being plain text. Links are pairs of tokens whose bytes
    end together; n_best counts those whose pair of ids has the most links in all rows among pairs of its second id,
    ties included; count_sum adds up the pairs' links in all rows. groups_sha256 is of the groups' ids as text. Null and
    empty texts, and those that the second side doesn't give back, have no tokens: zeros and an empty digest. Rows that
    repeat or have null ids count each by themselves; an empty table gives an empty result; other columns are ignored."""
    specs, size_b = _specs(docs, vocabulary_a, vocabulary_b)
    made = _rows(docs, id_col, text_col).mapInArrow(_summaries(specs, pattern), _DOCS).withColumn("no", F.monotonically_increasing_id())
    made, _ = cut(made, "aligned")
    pairs = made.select("pairs", "times").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % size_b)
    pairs, _ = cut(pairs, "pairs")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    pairs, _ = cut(pairs.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "counts")
    total = pairs.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") >= share * total
    table = pairs.filter(often).orderBy("pair").toArrow()  # 1 / share rows at most
    table = docs.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "n", "best")))
    found, _ = cut(made.select("no", "pairs", "times").mapInArrow(_look_up(table), "no long, pair long, times long, n_best long, count_sum long"), "sums")
    rare = found.filter("pair is not null").select("no", "pair", "times").join(pairs.filter(~often), "pair")
    sums = found.filter("pair is null").select("no", "n_best", "count_sum").unionByName(rare.select("no", (F.col("times") * F.col("best")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")))
    sums = sums.groupBy("no").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return made.drop("pairs", "times").join(sums, "no").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
