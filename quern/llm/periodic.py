"""Runs of repeated words: branching tandem repeats over an enhanced suffix array, rotated and merged into runs.

The suffix array of a batch of texts comes from prefix doubling; the ranks of every doubling are kept, so that any two
stretches of words compare by a few look-ups. An interval of suffixes that share D words holds a tandem repeat of period
D where it also holds the suffix D words on or back; it is branching if the word after it does not go on with the
period, which every run shows once per period, at its end. Only suffixes outside each interval's largest child are
tested, so that texts take n log n steps. Rotating such a repeat to the left as far as it goes gives its run."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import slices

#: Words of the shortest run.
LEAST = 12
#: Bytes of text that are taken as one batch, about; suffixes that are tested at once.
_BATCH = 1 << 21
_TESTS = 1 << 20


class WordSuffixes:
    """Suffixes of several texts' words, sorted within each text. words: numbers of the words; ends: where texts stop."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        n = len(words)
        self.words, self.end = words, np.repeat(ends, np.diff(np.r_[0, ends]))
        text = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
        key = text << 32 | words
        self.order = np.argsort(key)
        slot = np.arange(n)
        key = key[self.order]
        new = np.r_[True, key[1:] != key[:-1]]
        #: Doubling at which a suffix in the order parts from the one before it.
        self.parts = np.where(new, 0, -1)
        rank = np.empty(n + 1, np.int32)
        rank[n] = -1
        rank[self.order] = np.maximum.accumulate(np.where(new, slot, 0))
        self.ranks = [rank]
        head = np.r_[new, True]
        open_ = slot[~(head[:-1] & head[1:])]
        size = 1
        while len(open_):
            at = self.order[open_]
            follow = at + size
            key = rank[at].astype(np.int64) << 32 | np.where(follow < self.end[at], rank[np.minimum(follow, n)].astype(np.int64) + 1, 0)
            sort = np.argsort(key)
            key, self.order[open_] = key[sort], at[sort]
            new = np.r_[True, key[1:] != key[:-1]]
            fresh = new & (self.parts[open_] < 0)
            self.parts[open_[fresh]] = len(self.ranks)
            rank = rank.copy()
            first = np.flatnonzero(new)
            rank[self.order[open_]] = open_[first[np.cumsum(new) - 1]]
            self.ranks.append(rank)
            open_ = open_[~(new & np.r_[new[1:], True])]
            size *= 2
        self.place = np.empty(n, np.int64)
        self.place[self.order] = slot

    def common(self) -> np.ndarray:
        """Words that each suffix in the order shares with the one before it; -1 at the first of a text."""
        out = np.zeros(len(self.words), np.int64)
        a, b = np.r_[0, self.order[:-1]], self.order
        for level in range(1, len(self.ranks)):  # those that part at a level share half of it at least
            some = np.flatnonzero(self.parts == level)
            i, j, n = a[some], b[some], np.full(len(some), 1 << level - 1)
            for k in range(level - 2, -1, -1):
                rank = self.ranks[k]
                x, y = i + n, j + n
                n = n + np.where((x < self.end[i]) & (y < self.end[j]) & (rank[np.minimum(x, len(self.words))] == rank[np.minimum(y, len(self.words))]), 1 << k, 0)
            out[some] = n
        out[self.end[a] != self.end[b]] = -1
        if len(out):
            out[0] = -1
        return out

    def before(self, start: np.ndarray, period: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many words before `start` equal those `period` words on, back to `begin` at most."""
        n = np.zeros(len(start), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            at = start - n - (1 << k)
            ok = at >= begin
            at = np.maximum(at, 0)
            n += np.where(ok & (self.ranks[k][at] == self.ranks[k][np.minimum(at + period, len(self.words))]), 1 << k, 0)
        return n


def _bounds(common: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For places of an array: the last place before with a smaller value, the first after with one, and the first after
    with one that is not greater. Minima over stretches of doubling length; both ends of the array are smaller than all."""
    n = len(common)
    levels = [common]
    while 2 << len(levels) - 1 <= n:
        step = 1 << len(levels) - 1
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    value = common[at]
    low, high, even = at - 1, at + 1, at + 1
    for k in range(len(levels) - 1, -1, -1):
        m, step = levels[k], 1 << k
        last = len(m) - 1
        low = low - np.where((low - step + 1 >= 0) & (m[np.clip(low - step + 1, 0, last)] >= value), step, 0)
        high = high + np.where((high + step <= n) & (m[np.minimum(high, last)] >= value), step, 0)
        even = even + np.where((even + step <= n) & (m[np.minimum(even, last)] > value), step, 0)
    return low, high, even


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the stretch, place) of every place of some stretches."""
    number = np.repeat(np.arange(len(first)), size)
    return number, np.arange(len(number)) - np.repeat(np.cumsum(size) - size, size) + first[number]


def branching_repeats(suffixes: WordSuffixes, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching tandem repeats in texts that can have a run of at least `least` words."""
    common, order, place, end, words = suffixes.common(), suffixes.order, suffixes.place, suffixes.end, suffixes.words
    # a run's first suffix shares all but a period of it, half or more, with the suffix one period on
    able = np.unique(end[order[common >= -(-least // 2)]])
    at = np.flatnonzero((common > 0) & np.isin(end[order], able))
    empty = np.empty(0, np.int64)
    if not len(at):
        return empty, empty
    low, high, even = _bounds(common, at)
    depth = common[at]
    # an interval goes from `low` to before `high`; its boundaries, the places of its least common length, cut it into
    # children: one to the right of each boundary, and one to the left of its first
    key = np.lexsort((at, low, depth))
    at, low, high, even, depth = at[key], low[key], high[key], even[key], depth[key]
    new = np.r_[True, (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])]
    interval, first = np.cumsum(new) - 1, np.flatnonzero(new)
    child = np.concatenate([at, low[first]])
    size = np.concatenate([even - at, at[first] - low[first]])
    owner = np.concatenate([interval, np.arange(len(first))])
    key = np.lexsort((size, owner))
    child, size, owner = child[key], size[key], owner[key]
    small = np.r_[owner[1:] == owner[:-1], False]  # the last, largest child of each is left out
    child, size, owner = child[small], size[small], owner[small]
    low, high, depth = low[first], high[first], depth[first]
    starts, periods = [empty], [empty]
    part = np.cumsum(size) // _TESTS
    for a, b in zip(np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), np.flatnonzero(np.r_[part[1:] != part[:-1], True]) + 1):
        number, slot = _spread(child[a:b], size[a:b])
        own = owner[a:b][number]
        i, d = order[slot], depth[own]
        for start in (i, i - d):
            other = start + d
            ok = (start >= 0) & (other < end[i])
            start, other, who, width = start[ok], other[ok], own[ok], d[ok]
            partner = place[np.where(start == i[ok], other, start)]
            ok = (partner >= low[who]) & (partner < high[who])
            start, width = start[ok], width[ok]
            after = start + 2 * width
            last = len(words) - 1
            ok = (after <= end[start]) & ((after == end[start]) | (words[np.minimum(after, last)] != words[np.minimum(after - width, last)]))
            starts.append(start[ok]), periods.append(width[ok])
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(words: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of some texts' words, by start and period; starts count from the first text.

    A run is a stretch with smallest period q, at least twice that and `least` words long, that no neighbouring word of
    its text extends."""
    none = np.empty(0, np.int64)
    if not len(words):
        return none, none, none
    suffixes = WordSuffixes(words, ends)
    start, period = branching_repeats(suffixes, least)
    begin = np.r_[0, ends][np.searchsorted(ends, start, "right")] if len(start) else none
    stop = start + 2 * period
    start = start - suffixes.before(start, period, begin)
    keep = stop - start >= least
    start, stop, period = start[keep], stop[keep], period[keep]
    key = np.lexsort((period, stop, start))
    start, stop, period = start[key], stop[key], period[key]
    new = np.r_[True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])] if len(start) else np.empty(0, bool)
    start, length, period = start[new], (stop - start)[new], period[new]  # multiples of a period come after it
    key = np.lexsort((period, start))
    return start[key], length[key], period[key]


def fold(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, of which those of one id in ten, by its crc32, repeat with a period from some word on."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def _finder(least: int, change):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def settle(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        words = np.fromiter(map(numbers.setdefault, chain.from_iterable(texts), count()), np.int64, int(ends[-1]))
        start, length, period = runs_of(words, ends, least)
        edge = np.zeros(len(words) + 1, np.int32)
        np.add.at(edge, start + period, 1), np.add.at(edge, start + length, -1)
        kept = np.cumsum(edge[:-1]) == 0
        begin = np.r_[0, ends[:-1]]
        text = np.searchsorted(ends, start, "right")
        some = np.zeros(len(texts), bool)
        some[text] = True
        left = [b" ".join([w for w, k in zip(t, kept[a : a + len(t)].tolist()) if k] if s else t) for t, a, s in zip(texts, begin.tolist(), some.tolist())]
        cuts = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
        flat = pa.StructArray.from_arrays([pa.array(start - begin[text]), pa.array(length), pa.array(period)], fields=list(kind.value_type))
        runs = pa.ListArray.from_arrays(pa.array(cuts), flat, type=kind)
        return pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in texts], pa.int64()), runs, pa.array(left, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, size, at = [], 0, 0
            for i, (doc_id, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()))):
                raw = raw.as_py() or b""
                if texts and size + len(raw) > _BATCH:
                    yield settle(batch.column(0).slice(at, i - at), texts)
                    texts, size, at = [], 0, i
                words = raw.split()  # of bytes: at ASCII white space only
                texts.append(change(words, doc_id) if change else words)
                size += len(raw)
            if texts:
                yield settle(batch.column(0).slice(at), texts)

    return run


_RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, change=None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row: the runs of its whole text, by start and period, and the text
    without what repeats: of every run only the words of its first period stay, joined by one space.

    Words are what ASCII white space parts. change(words, doc_id), if given, makes the words that are judged. Null and
    empty texts have no words, no runs and an empty text; rows that repeat, and rows with null ids, get a result each;
    an empty table gives an empty result; other columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_finder(least, change), _RUNS)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, its words folded by its id (a null id leaves them as they are): the count of its runs, the
    longest (of equals the first, then that of the smallest period), and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("small"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    found = periodic_runs(docs, id_col, text_col, change=fold).withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.small")).alias("period"),
        F.expr("(1000 * best.length) div (-best.small)").alias("exponent_milli"), F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
