"""Removal of repeated byte strings: suffixes sorted by hashed comparisons within groups that share an anchor.

Every string of `length` bytes has an anchor, the gram of least hash among its grams, so equal strings have equal
anchors at equal places. Anchors are thus the only suffixes that need sorting: those whose gram occurs nowhere else are
dropped, those whose whole neighbourhood occurs elsewhere are settled by its digest, and the rest are sorted, to the
right and to the left of the anchor, within the group of their gram. A group that is too large for a task is halved:
its strings that begin near the anchor and those that begin far from it each have bytes in common by which the halves
part into smaller groups, down to groups of one and the same string."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import cut, slices

LENGTH = 200
GRAM = 32
#: Neighbourhoods that are sorted as one group at most; larger groups are halved until they are this small.
GROUP_ROWS = 8_192
#: Rows of one key that a join keeps together, about; more are dealt out.
JOIN_ROWS = 4_096
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class PrefixHashes:
    """Polynomial hashes (modulo 2**64) of any stretch of a buffer, from sums over its prefixes."""

    def __init__(self, buffer: np.ndarray):
        size = 1 << max(10, int(len(buffer)).bit_length())
        up, self.down = _powers(size)
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(0x51ED27)) * up[: len(buffer)], out=self.sums[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at a and b, `most` at most, by binary search."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n = len(v)
    padded = np.full(-(-n // width) * width, np.iinfo(v.dtype).max, v.dtype)
    padded[:n] = v
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(raw: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of some texts: (text number, position, first and last start of the strings they stand for, gram hash)."""
    sizes = np.array([len(r) for r in raw], np.int64)
    ends = np.cumsum(sizes)
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    none = np.empty(0, np.int64)
    if len(buffer) < length:
        return none, none, none, none, none
    hashes = _mixed(PrefixHashes(buffer).of(np.arange(len(buffer) - gram + 1), gram))
    order = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)  # ties: the leftmost
    at = (_sliding_min(order, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(len(buffer) + 1, np.int32)  # strings may not cross the end of a text
    np.add.at(edge, np.maximum(ends - length + 1, ends - sizes), 1)
    np.add.at(edge, ends, -1)
    start = np.flatnonzero(np.cumsum(edge)[: len(at)] == 0)
    if not len(start):
        return none, none, none, none, none
    at = at[start]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
    first, last = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
    at = at[new]
    text = np.searchsorted(ends, at, "right")
    offset = (ends - sizes)[text]
    return text, at - offset, first - offset, last - offset, hashes[at].view(np.int64)


def anchors_of(raw: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """anchors(); one long text is taken in slices, so that memory does not grow with it."""
    if len(raw) > 1 or not raw or len(raw[0]) <= _CHUNK:
        return anchors(raw, length, gram)
    found = [anchors([raw[0][s : s + _CHUNK + length - 1]], length, gram) for s in range(0, len(raw[0]) - length + 1, _CHUNK)]
    base = np.repeat(np.arange(len(found)) * _CHUNK, [len(f[0]) for f in found])
    at, first, last = (np.concatenate([f[i] for f in found]) + base for i in (1, 2, 3))
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])  # one anchor on both sides of a cut is one again
    ends = np.r_[new[1:] - 1, len(at) - 1]
    return np.zeros(len(new), np.int64), at[new], first[new], last[ends], np.concatenate([f[4] for f in found])[new]


def _pieces(raw: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at, size = 0, 0
    for i, r in enumerate(raw):
        if size and size + len(r) > _CHUNK:
            yield at, raw[at:i]
            at, size = i, 0
        size += len(r)
    if at < len(raw):
        yield at, raw[at:]


def _find_grams(length: int, gram: int):
    """Hashes of the anchors' grams, with how often each occurs in a piece of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for _, part in _pieces([t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]):
                g, n = np.unique(anchors_of(part, length, gram)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(n)], ["g", "n"])

    return run


def _find_anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            for begin, part in _pieces(raw):
                text, at, first, last, g = anchors_of(part, length, gram)
                z = _digests([part[t][a:b] for t, a, b in zip(text.tolist(), first.tolist(), (last + length).tolist())])
                rows = pa.array(text + begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g), pa.array(z[:, 0]), pa.array(z[:, 1]), pa.array(at - first, pa.int32()), pa.array(at - last, pa.int32()), pa.array(first, pa.int32()), batch.column(0).take(rows), batch.column(1).take(rows)],
                    ["g", "z1", "z2", "high", "low", "first", "k1", "k2"],
                )

    return run


def _digests(data: list[bytes]) -> np.ndarray:
    """128 bits of BLAKE2b for each, as two integers."""
    return np.frombuffer(b"".join([hashlib.blake2b(d, digest_size=16).digest() for d in data]), np.int64).reshape(-1, 2)


def _batcher(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stages of Batcher's odd-even mergesort over n (a power of two) places: pairs to compare and exchange."""
    p = 1
    while p < n:
        k = p
        while k >= 1:
            i = np.arange(n - k)
            ok = ((i - k % p) % (2 * k) < k) & (i >= k % p) & (i // (2 * p) == (i + k) // (2 * p))
            yield i[ok], i[ok] + k
            k //= 2
        p *= 2


def suffix_sort(buffer: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes (start, size) within groups (ascending numbers), and each one's common extension with the one
    before it (-1 at a group's first).

    A mergesort whose comparisons are binary searches over prefix hashes, done for all groups of like size at once.
    Neighbours are then compared byte by byte, and must ascend; a group where a hash was wrong is sorted anew by its
    bytes."""
    hashes = PrefixHashes(buffer)
    n = len(start)
    code = np.append(buffer, 0).astype(np.int64)
    order = np.arange(n)
    begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    counts = np.diff(np.r_[begins, n])
    for power in np.unique(np.ceil(np.log2(np.maximum(counts, 1))).astype(int)):
        if power == 0:
            continue
        width = 1 << int(power)
        some = np.flatnonzero(np.ceil(np.log2(np.maximum(counts, 1))).astype(int) == power)
        place = begins[some][:, None] + np.arange(width)
        place[np.arange(width) >= counts[some][:, None]] = -1  # beyond the group: after all others
        for i, j in _batcher(width):
            a, b = place[:, i].ravel(), place[:, j].ravel()
            real = np.flatnonzero((a >= 0) & (b >= 0))
            x, y = a[real], b[real]
            most = np.minimum(size[x], size[y])
            same = hashes.common(start[x], start[y], most)
            cx, cy = np.where(same < size[x], code[start[x] + same], -1), np.where(same < size[y], code[start[y] + same], -1)
            swap = (a < 0) & (b >= 0)
            swap[real] = (cx > cy) | (cx == cy) & (x > y)
            place[:, i], place[:, j] = np.where(swap, b, a).reshape(-1, len(i)), np.where(swap, a, b).reshape(-1, len(i))
        kept = place >= 0
        order[(begins[some][:, None] + np.arange(width))[kept]] = place[kept]
    common = np.full(n, -1, np.int64)
    wrong = np.zeros(len(begins), bool)
    number = np.repeat(np.arange(len(begins)), counts)
    inner = np.flatnonzero(np.r_[False, group[1:] == group[:-1]])
    for some in np.array_split(inner, max(1, len(inner) // 20_000)):
        a, b = order[some - 1], order[some]
        most = np.minimum(size[a], size[b])
        step = np.arange(int(most.max(initial=0)))
        last = len(code) - 1
        differ = (code[np.minimum(start[a][:, None] + step, last)] != code[np.minimum(start[b][:, None] + step, last)]) | (step >= most[:, None])
        common[some] = np.where(differ.any(axis=1), differ.argmax(axis=1), most) if len(step) else 0
        same = common[some]
        ca, cb = np.where(same < size[a], code[np.minimum(start[a] + same, last)], -1), np.where(same < size[b], code[np.minimum(start[b] + same, last)], -1)
        wrong[number[some[(same != hashes.common(start[a], start[b], most)) | (ca > cb)]]] = True  # a hash misled some comparison
    for w in np.flatnonzero(wrong):
        own = slice(begins[w], begins[w] + counts[w])
        data = buffer.tobytes()
        text = lambda i: data[start[i] : start[i] + size[i]]
        order[own] = sorted(range(own.start, own.stop), key=text)
        for i in range(own.start + 1, own.stop):
            a, b = text(order[i - 1]), text(order[i])
            common[i] = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return order, common


def repeated_offsets(contexts: list[bytes], high: np.ndarray, low: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Matrix (context, offset): whether the string that begins `offset` bytes before the context's anchor also stands
    in another context of its group. A context runs from `high` bytes before its anchor on and stands for the offsets
    from low to high; group numbers ascend."""
    n, size = len(contexts), np.array([len(c) for c in contexts], np.int64)
    begin = np.r_[0, np.cumsum(size)[:-1]].astype(np.int64)
    buffer = np.frombuffer(b"".join(contexts), np.uint8)
    turned = np.frombuffer(b"".join(c[::-1] for c in contexts), np.uint8)
    right, right_common = suffix_sort(buffer, begin + high, size - high, group)
    left, left_common = suffix_sort(turned, begin + size - high, high, group)
    offsets = np.arange(int(high.max(initial=0)) + 1)
    out = np.zeros((n, len(offsets)), bool)

    def classes(order, common, depth):
        made = np.empty(n, np.int64)
        made[order] = np.cumsum(common < depth)
        return made

    for o in offsets:
        use = np.flatnonzero((low <= o) & (o <= high))
        if len(use) > 1:
            key = classes(left, left_common, o)[use] * (n + 1) + classes(right, right_common, length - o)[use]
            found, place, many = np.unique(key, return_inverse=True, return_counts=True)
            out[use, o] = many[place] > 1
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each stretch of set flags."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


_COVER = "k1 long, k2 int, start int, stop int"
_CONTEXT = "g long, n long, first int, high int, low int, k1 long, k2 int, context binary"
_HALF = f"{_CONTEXT}, least int, most int"


def _covers(k1: pa.Array, k2: pa.Array, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([k1, k2, pa.array(start, pa.int32()), pa.array(stop, pa.int32())], ["k1", "k2", "start", "stop"])


def _compare(length: int):
    """Over contexts sorted by gram, whole groups at a time."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        who = np.column_stack([table[c].to_numpy().astype(np.int64) for c in ("g", "k1", "k2", "first")])
        order = np.lexsort(who.T[::-1])
        who = who[order]  # rows that repeat under one id give the same neighbourhoods: one is enough
        table = table.take(pa.array(order[np.r_[True, (who[1:] != who[:-1]).any(axis=1)]]))
        g = table["g"].to_numpy()
        high, low = table["high"].to_numpy().astype(np.int64), table["low"].to_numpy().astype(np.int64)
        group = np.cumsum(np.r_[0, g[1:] != g[:-1]])
        found = repeated_offsets(table["context"].to_pylist(), high, low, group, length)
        found &= (table["n"].to_numpy() == 1)[:, None]  # the others are covered already
        row, near, far = _runs(found)
        if len(row):
            at = (table["first"].to_numpy() + high)[row]
            rows = pa.array(row)
            yield _covers(table["k1"].combine_chunks().take(rows), table["k2"].combine_chunks().take(rows), at - far, at - near + length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                g = batch.column("g").to_numpy()
                last = int(np.flatnonzero(np.r_[True, g[1:] != g[:-1]])[-1])
                if held and (last or held[-1].column("g")[-1].as_py() != g[0]):
                    yield from settle(pa.Table.from_batches([*held, batch.slice(0, last)] if last else held))
                    held = []
                elif last:
                    yield from settle(pa.Table.from_batches([batch.slice(0, last)]))
                held.append(batch.slice(last))
        if held:
            yield from settle(pa.Table.from_batches(held))

    return run


def _slice(length: int):
    """Over texts with what is asked of them: neighbourhoods of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keys = list(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist()))
                new = [i for i, k in enumerate(keys) if k not in done and (done.add(k) or True)]  # rows that repeat are asked once
                if len(done) > 100_000:
                    done.clear()
                batch = batch.take(pa.array(new, pa.int64()))
                raw = batch.column("text").cast(pa.binary()).to_pylist()
                asked = batch.column("asked")
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
                flat = asked.flatten()
                first, high, low = (flat.field(c).to_numpy() for c in ("first", "high", "low"))
                context = [raw[r][f : f + h - o + length] for r, f, h, o in zip(row.tolist(), first.tolist(), high.tolist(), low.tolist())]
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays([flat.field("g"), flat.field("n"), flat.field("first"), flat.field("high"), flat.field("low"), batch.column("k1").take(rows), batch.column("k2").take(rows), pa.array(context, pa.binary())], ["g", "n", "first", "high", "low", "k1", "k2", "context"])

    return run


def _halve(length: int):
    """Neighbourhoods of groups that stand for offsets from `least` to `most`, parted into those of the nearer and the
    farther half. Strings of one half all hold the bytes from its least offset before the anchor to the end of its
    greatest offset's string, so these bytes give the new group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for g, n, first, high, low, k1, k2, context, least, most in zip(*(c.to_pylist() for c in batch.columns)):
                middle = (least + most) // 2
                for a, b in ((least, middle), (middle + 1, most)):
                    l, h = max(low, a), min(high, b)
                    if l <= h:
                        part = context[high - h : high + length - l]
                        own = hashlib.blake2b(part[h - a : h + length - b], digest_size=8, key=g.to_bytes(8, "little", signed=True), salt=a.to_bytes(4, "little")).digest()
                        rows.append((int.from_bytes(own, "little", signed=True), n, first + high - h, h, l, k1, k2, part, a, b))
            cols = list(zip(*rows)) if rows else [()] * 10
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in _HALF.split(", ")])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """Texts with a key of 96 bits of id and text: rows that share it are the same text, and so have the same spans."""
    id_, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return docs.select(F.xxhash64(id_, text).alias("k1"), F.hash(id_, text).alias("k2"), text.alias("text"), *more)


def _among(rows: DataFrame, counted: DataFrame, count: str, key: list[str]) -> DataFrame:
    """Rows whose key counts more than once. Keys of very many rows are few; they are looked up first, without a shuffle
    while their table is small, and dealt out over several keys of the join, so that none is hot. The join is by merging
    at every size, as the counted keys grow with the input."""
    salts = F.ceil(F.col(count) / JOIN_ROWS)
    hot, _ = cut(counted.filter(F.col(count) > JOIN_ROWS).select(*key, salts.alias("salts")), "hot")
    salt = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("k1", "k2", "first"), F.col("salts"))).alias("salt")
    wanted = counted.filter(F.col(count) > 1).select(*key, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"))
    return rows.join(hot, key, "left").select(*(F.col(c) for c in rows.columns), salt.cast("long").alias("salt")).join(wanted.hint("merge"), [*key, "salt"], "left_semi").drop("salt")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(k1, k2, start, stop): stretches of bytes, overlapping or not, that together hold every byte covered by a string
    of `length` bytes that starts anywhere else too. k1, k2: the key of the id and the text, see _keyed."""
    texts = _keyed(docs, id_col, text_col)
    # counts are tables of their own, so that the joins with them have plain exchanges on both sides, which adaptive
    # execution can split where one gram has very many anchors
    again, _ = cut(texts.mapInArrow(_find_grams(length, gram), "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).filter("n > 1"), "grams")
    key = ["g", "z1", "z2", "high", "low"]
    found = texts.mapInArrow(_find_anchors(length, gram), "g long, z1 long, z2 long, high int, low int, first int, k1 long, k2 int")
    found, _ = cut(_among(found, again, "n", ["g"]), "repeated")
    one = [F.first(c).alias(c) for c in ("k1", "k2", "first")]  # any member, all three of one and the same
    classes, _ = cut(found.groupBy(*key).agg(F.count("*").alias("n"), *one), "classes")
    stretch = [F.col("first").alias("start"), (F.col("first") + F.col("high") - F.col("low") + length).alias("stop")]
    covers = _among(found, classes, "n", key).select("k1", "k2", *stretch)
    per_g, _ = cut(classes.groupBy("g").agg(F.count("*").alias("k")).filter("k > 1"), "groups")
    open_, _ = cut(classes.join(per_g, "g").select("g", "n", "k", "k1", "k2", "first", "high", "low"), "open")

    def contexts(rows: DataFrame) -> DataFrame:
        wanted = rows.groupBy("k1", "k2").agg(F.collect_list(F.struct("g", "n", "first", "high", "low")).alias("asked"))
        once = texts.filter(F.octet_length("text") >= length)
        return once.join(wanted, ["k1", "k2"]).mapInArrow(_slice(length), _CONTEXT)

    def settled(rows: DataFrame) -> DataFrame:
        return rows.repartition("g").sortWithinPartitions("g").mapInArrow(_compare(length), _COVER)

    large = F.col("k") > group_rows
    if open_.filter(large).isEmpty():
        return covers.unionByName(settled(contexts(open_)))
    # the texts are joined once for both kinds of groups; those of large ones carry their n below zero
    both, _ = cut(contexts(open_.withColumn("n", F.when(large, -F.col("n")).otherwise(F.col("n")))), "contexts")
    covers = covers.unionByName(settled(both.filter("n > 0")))
    large = both.filter("n < 0").withColumn("n", -F.col("n")).withColumns({"least": F.lit(0), "most": F.lit(length - gram)})
    key = ["g", "least", "most", "high", "low", "context"]
    for _ in range((length - gram).bit_length() + 1):  # the halves of one offset hold equal strings, which count as one
        halves, _ = cut(large.mapInArrow(_halve(length), _HALF), "halves")
        classes, _ = cut(halves.groupBy(*key).agg(F.count("*").alias("c"), F.max("n").alias("n"), *one), "parts")
        covers = covers.unionByName(_among(halves.filter("n = 1"), classes, "c", key).select("k1", "k2", *stretch))
        per_g, _ = cut(classes.groupBy("g").agg(F.count("*").alias("k")).filter("k > 1"), "groups")
        open_ = classes.join(per_g, "g").withColumn("n", F.greatest("n", F.least("c", F.lit(2))))
        covers = covers.unionByName(settled(open_.filter(F.col("k") <= group_rows).selectExpr(*(f.split()[0] for f in _CONTEXT.split(", ")))))
        large = open_.filter(F.col("k") > group_rows).selectExpr(*(f.split()[0] for f in _HALF.split(", ")))
        if per_g.filter(F.col("k") > group_rows).isEmpty():
            break
    return covers


def union_of(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of a union of stretches."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.r_[True, start[1:] > stop[:-1]])
    return start[new], stop[np.r_[new[1:] - 1, len(stop) - 1]]


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)):
            text, removed, n = text or b"", 0, 0
            kept = text
            if spans.is_valid and len(spans.values):
                start, stop = union_of(spans.values.field("start").to_numpy().astype(np.int64), spans.values.field("stop").to_numpy().astype(np.int64))
                edges = [0, *np.column_stack([start, stop]).ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                removed, n = int((stop - start).sum()), len(start)
            rows.append((len(text), removed, n, hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row: its UTF-8 bytes without those covered by
    a string of `length` bytes that starts anywhere else, in the same text or another.

    Null and empty texts have no bytes. Rows that repeat, also under one id or a null id, are texts of their own that
    repeat each other, one result each; different texts under one id don't mix. Matches don't cross texts; an empty
    table gives an empty result."""
    spans = repeated_spans(docs, id_col, text_col, length, gram, group_rows)
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = _keyed(docs, id_col, text_col, F.col(id_col).cast("long").alias("doc_id")).join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
