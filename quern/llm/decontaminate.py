"""Benchmark decontamination: CGK embedding of item-sized windows, bit-sampling LSH, runs of words that every match shares,
exact edit distance."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits per word of an item, at most: a similarity of 0.8.
MAX_EDITS = 0.2
#: Sampled positions per table, and what the number of tables is made for: the recall of windows whose embeddings
#: differ at this share of positions. Windows with more edits differ at more; those the tables miss are found by the
#: runs of words that they share with the item (Index.by_runs), so that the recall of matches does not hang on these.
SAMPLES = 4
TARGET_RECALL = 0.99
EMBEDDED_DISTANCE = 0.3
#: Characters of benchmark text that tasks hold at once; a larger benchmark is taken in blocks, one pass each.
BLOCK_CHARS = 16_000_000
_WORD = re.compile(r"[^\W_]+")
_PAD = -1
_GRAM = 4
_POSTS = 1 << 20
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def tables_for(recall: float = TARGET_RECALL, distance: float = EMBEDDED_DISTANCE, samples: int = SAMPLES) -> int:
    """Independent tables after which a pair at that embedded Hamming distance has met with the target probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - distance) ** samples))


def _grams(ids: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q words from each position on; places too near the end get what they get and are cut off."""
    h = np.zeros(len(ids) - q + 1, np.uint64)
    for i in range(q):
        h = (h ^ ids[i : len(ids) - q + 1 + i].astype(np.uint64)) * _PRIMES[i]
        h ^= h >> np.uint64(29)
    return h


def walk(ids: np.ndarray, start: np.ndarray, stop: np.ndarray, at: list[int], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """CGK walks over ids[start:stop] for many windows: symbols under the pointer, and the pointer, at some steps.

    At every step the symbol under the pointer is copied out, and a random bit of (step, symbol) says whether the
    pointer moves on. Windows at edit distance d then mostly differ at few steps. Past its end a window gives a pad."""
    here = start.copy()
    out, places = np.empty((len(start), len(at)), np.int64), np.empty((len(start), len(at)), np.int64)
    want = {step: n for n, step in enumerate(at)}
    last = len(ids) - 1
    for step in range(max(at) + 1):
        symbol = np.where(here < stop, ids[np.minimum(here, last)], _PAD)
        if step in want:
            out[:, want[step]], places[:, want[step]] = symbol, here
        mixed = (symbol.astype(np.uint64) + np.uint64((seed * 1_000_003 + step) * int(_PRIMES[1]) & 0xFFFFFFFFFFFFFFFF)) * _PRIMES[0]
        here = here + ((mixed ^ (mixed >> np.uint64(32))) * _PRIMES[2] >> np.uint64(63)).astype(np.int64)
    return out, places


def cgk(ids: np.ndarray, start: np.ndarray, stop: np.ndarray, at: list[int], seed: int) -> np.ndarray:
    return walk(ids, start, stop, at, seed)[0]


def best_alignment(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to any stretch of the text: (distance, start, stop)."""

    def row(a, b):
        places = np.arange(len(b) + 1)
        d = np.zeros(len(b) + 1, np.int64)
        for i, x in enumerate(a, 1):
            t = d + 1
            t[1:] = np.minimum(t[1:], d[:-1] + (b != x))
            t[0] = i
            d = np.minimum.accumulate(t - places) + places
        return d

    d = row(item, text)
    stop = int(d.argmin())
    back = row(item[::-1], text[:stop][::-1])
    return int(d[stop]), stop - int(back.argmin()), stop


@dataclass
class Index:
    """LSH tables over one block of items."""

    vocabulary: dict[str, int]
    item_id: list[int]
    items: list[np.ndarray]
    grams: dict[int, np.ndarray]
    posts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by gram size: where each gram's items begin, items, places
    classes: list[tuple[int, int, list[int]]]  # least and greatest length, items
    tables: list[list[tuple[list[int], np.ndarray, np.ndarray]]]  # by table and class: sampled steps, sorted keys, items
    max_edits: float

    @staticmethod
    def build(rows: list[tuple[int, list[str]]], max_edits: float, tables: int, samples: int) -> Index:
        vocabulary: dict[str, int] = {}
        items = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in ws], np.int64) for _, ws in rows]
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for i, item in enumerate(items):
            q = Index.gram(len(item), max_edits)
            h = _grams(item, q)
            held.setdefault(q, []).append((h, np.full(len(h), i), np.arange(len(h))))
        grams, posts = {}, {}
        for q, parts in held.items():
            h, item, place = map(np.concatenate, zip(*parts))
            sort = np.lexsort((place, item, h))
            grams[q], first = np.unique(h[sort], return_index=True)
            posts[q] = (np.r_[first, len(h)], item[sort], place[sort])
        order = sorted(range(len(items)), key=lambda i: len(items[i]))
        classes: list[tuple[int, int, list[int]]] = []
        for i in order:
            n = len(items[i])
            if classes and n <= 1.15 * classes[-1][0]:
                classes[-1] = (classes[-1][0], n, [*classes[-1][2], i])
            else:
                classes.append((n, n, [i]))
        rng = np.random.default_rng(20240607)
        flat = np.concatenate([*items, [_PAD]])
        begin = np.r_[0, np.cumsum([len(i) for i in items])]
        made = []
        for t in range(tables):
            by_class = []
            for least, _, members in classes:
                at = sorted(rng.choice(max(1, int(1.6 * least)), min(samples, max(1, int(1.6 * least))), replace=False).tolist())
                m = np.array(members)
                key = Index.key(cgk(flat, begin[m], begin[m + 1], at, t))
                sort = np.argsort(key, kind="stable")
                by_class.append((at, key[sort], m[sort]))
            made.append(by_class)
        return Index(vocabulary, [r[0] for r in rows], items, grams, posts, classes, made, max_edits)

    @staticmethod
    def gram(n: int, max_edits: float) -> int:
        """Words of a run that an item of n words shares with every match: d edits leave one of d + 1 pieces whole."""
        return max(1, min(_GRAM, n // (int(max_edits * n) + 1)))

    @staticmethod
    def key(symbols: np.ndarray) -> np.ndarray:
        h = np.zeros(len(symbols), np.uint64)
        for i in range(symbols.shape[1]):
            h = (h ^ symbols[:, i].astype(np.uint64)) * _PRIMES[i % 4]
            h ^= h >> np.uint64(31)
        return h

    def runs(self, ids: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By gram size: positions where a gram of some item stands, and its number among the known ones."""
        out = {}
        for q, known in self.grams.items():
            if len(ids) < q:
                continue
            at = np.flatnonzero(np.convolve(ids > 0, np.ones(q, int), "valid") == q)
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for i in range(q):
                h = (h ^ ids[at + i].astype(np.uint64)) * _PRIMES[i]
                h ^= h >> np.uint64(29)
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[place] == h
            out[q] = at[hit], place[hit]
        return out

    def window_starts(self, ids: np.ndarray, runs: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Positions where a window has to be looked at: those near a run of words that an item has."""
        longest = int(self.classes[-1][1] * (1 + self.max_edits)) + 1
        edge = np.zeros(len(ids) + 1, np.int32)
        for at, _ in runs.values():
            np.add.at(edge, np.maximum(at - longest, 0), 1)
            np.add.at(edge, at + 1, -1)
        return np.flatnonzero((np.cumsum(edge)[: len(ids)] > 0) & (ids > 0))

    def _parts(self, ends: np.ndarray, runs: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The runs in parts of whole texts, cut where _POSTS places of items are passed."""
        for q, (at, gram) in runs.items():
            if not len(at):
                continue
            first = self.posts[q][0]
            text, total = np.searchsorted(ends, at, "right"), np.cumsum((first[1:] - first[:-1])[gram]) // _POSTS
            new = np.flatnonzero(text[1:] != text[:-1]) + 1
            cuts = new[np.flatnonzero(np.diff(total[new], prepend=0))]
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(at)]):
                yield q, at[a:b], gram[a:b]

    def by_runs(self, ids: np.ndarray, ends: np.ndarray, runs: dict[int, tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """(text, item, start) of every window that shares enough runs of words with an item for a match; none is lost.

        A match within d edits keeps n - q + 1 - q d of the item's n - q + 1 grams, one at least, and shifts each by d
        places at most from where the item begins."""
        pairs = []
        lengths = np.array([len(i) for i in self.items])
        for q, at, gram in self._parts(ends, runs):
            first, item_of, place_of = self.posts[q]
            n = (first[1:] - first[:-1])[gram]
            post = np.repeat(first[gram], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item, begin, here = item_of[post], np.repeat(at, n) - place_of[post], np.repeat(at, n)
            edits = (self.max_edits * lengths[item]).astype(np.int64)
            text = np.searchsorted(ends, here, "right")
            sort = np.lexsort((begin, item, text))
            text, item, begin, edits = text[sort], item[sort], begin[sort], edits[sort]
            need = np.maximum(lengths[item] - q + 1 - q * edits, 1)
            # a match has its first gram, by begin, at most 2 d before its last: so many rows on must be the same item's
            last = np.arange(len(item)) + need - 1
            ok = last < len(item)
            last = np.minimum(last, len(item) - 1)
            ok &= (text[last] == text) & (item[last] == item) & (begin[last] <= begin + 2 * edits)
            pairs.append(np.column_stack([text[ok], item[ok], np.maximum(begin[ok], 0)]))
            pairs.append(np.column_stack([text[ok], item[ok], np.maximum(begin[ok] + 2 * edits[ok], 0)]))
        return pairs

    def find(self, ids: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Matches in some texts' words (0 where unknown), ends: where each text stops in ids.
        (text, item, distance, first word, word after the last), the best one for each text and item."""
        runs = self.runs(ids)
        start = self.window_starts(ids, runs)
        if not len(start):
            return []
        text = np.searchsorted(ends, start, "right")
        stop = ends[text]
        begin = np.r_[0, ends[:-1]]
        pairs = self.by_runs(ids, ends, runs)
        for t, by_class in enumerate(self.tables):
            steps = sorted({step for at, _, _ in by_class for step in at})
            symbols, places = walk(ids, start, stop, steps, t)  # one walk for windows of all sizes: they differ in their pads
            for (_, most, _), (at, keys, members) in zip(self.classes, by_class):
                cols = np.searchsorted(steps, at)
                key = self.key(np.where(places[:, cols] < (start + most)[:, None], symbols[:, cols], _PAD))
                low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                hit = np.flatnonzero(high > low)
                if len(hit):
                    n = (high - low)[hit]
                    one = np.repeat(hit, n)
                    other = members[np.repeat(low[hit], n) + np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n)]
                    pairs.append(np.column_stack([text[one], other, start[one]]))
        pairs = [p for p in pairs if len(p)]
        if not pairs:  # runs of words are shared, but nowhere as many as a match has
            return []
        found = np.unique(np.concatenate(pairs), axis=0)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        new = np.flatnonzero(np.r_[True, (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1]) | (found[1:, 2] > found[:-1, 2] + 2 * self.classes[-1][1])])
        for a, b in zip(new, np.r_[new[1:], len(found)]):  # neighbouring windows of one item are verified together
            t, i = int(found[a, 0]), int(found[a, 1])
            item = self.items[i]
            edits = int(self.max_edits * len(item))
            low = max(int(begin[t]), int(found[a, 2]) - edits - 1)
            high = min(int(ends[t]), int(found[b - 1, 2]) + len(item) + edits + 1)
            distance, first, last = best_alignment(item, ids[low:high])
            if distance <= edits and ((t, i) not in best or distance < best[t, i][0]):
                best[t, i] = (distance, low + first - int(begin[t]), low + last - int(begin[t]))
        return [(t, i, *m) for (t, i), m in sorted(best.items())]


_SCHEMA = "doc_id long, item_id long, distance int, similarity double, first_word int, last_word int, start int, stop int"


def _scan(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: Index = index.value
        get = x.vocabulary.get
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                raw = [t or "" for t in batch.column(1).to_pylist()]
                ids = [np.array([get(w, 0) for w in words(t)], np.int64) for t in raw]
                rows = []
                for t, i, distance, first, last in x.find(np.concatenate([*ids, np.zeros(1, np.int64)]), np.cumsum([len(i) for i in ids])):
                    spans = [m.span() for m in _WORD.finditer(raw[t])] if len(raw[t].lower()) == len(raw[t]) else [m.span() for m in _WORD.finditer(raw[t].lower())]
                    rows.append((batch.column(0)[t].as_py(), x.item_id[i], distance, 1 - distance / len(x.items[i]), first, last, spans[first][0], spans[last - 1][1]))
                cols = list(zip(*rows)) if rows else [()] * 8
                types = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in _SCHEMA.split(", ")])

    return run


def _blocks(benchmark: DataFrame, max_edits: float, recall: float, samples: int, block_chars: int) -> Iterator[Index]:
    """Indexes over the different texts of the benchmark (numbered by their hash), of some block_chars characters each."""
    items = benchmark.select(F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    number = F.xxhash64("text")
    for b in range(blocks):
        block = [(r.number, words(r.text)) for r in items.filter(F.pmod(number, F.lit(blocks)) == b).select("text", number.alias("number")).orderBy("text").collect()]  # block_chars characters, about
        block = [r for r in block if r[1]]
        if block:
            yield Index.build(block, max_edits, tables_for(recall, samples=samples), samples)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL, samples: int = SAMPLES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, similarity, first_word, last_word, start, stop): for every document and benchmark
    item that a stretch of the whole document comes within max_edits edits per word of, the closest such stretch.

    Words are runs of letters and digits, lower-cased; an edit inserts, drops or changes one. Positions: words, and
    characters of the text (of its lower-cased form where that has another length). Items without words and null texts
    match nothing; repeated documents and items, and those without ids, give a row each; an empty table on either side
    gives no rows. Items of one text are searched once; the corpus is read once for each block of the benchmark."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    out = None
    for index in _blocks(benchmark, max_edits, recall, samples, block_chars):
        found = rows.mapInArrow(_scan(spark.sparkContext.broadcast(index)), _SCHEMA)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], _SCHEMA)
    ids = benchmark.select(F.xxhash64(F.col("text").cast("string")).alias("number"), F.col("item_id").cast("long").alias("item_id"))
    return out.withColumnRenamed("item_id", "number").join(ids, "number").select(*(f.split()[0] for f in _SCHEMA.split(", ")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL, samples: int = SAMPLES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs, columns as they are, without the rows that hold a benchmark item as contaminated() has it; every row is
    judged by its own text, whatever its id. Null texts stay."""
    for index in _blocks(benchmark, max_edits, recall, samples, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            x: Index = shared.value
            get = x.vocabulary.get
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch = whole.slice(at, 512)
                    ids = [np.array([get(w, 0) for w in words(t or "")], np.int64) for t in batch.column(batch.schema.names.index(text_col)).to_pylist()]
                    keep = np.ones(len(ids), bool)
                    keep[[t for t, *_ in x.find(np.concatenate([*ids, np.zeros(1, np.int64)]), np.cumsum([len(i) for i in ids]))]] = False
                    yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
