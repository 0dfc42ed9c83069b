"""SimHash near-duplicate groups by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import components, cut

WORDS = 3
SEED = 42
DISTANCE = 3
SEGMENTS = 2
#: Members of one table bucket that a task compares at once; larger buckets are dealt out in pairs of chunks.
BUCKET_ROWS = 8192
_BLOCK = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> bytes:
    """64-bit SimHash over word shingles of one UTF-8 text, big-endian."""
    found = text.lower().split()  # of bytes: only A-Z, only ASCII white space
    if not found:
        return bytes(8)
    shingles = [b" ".join(found)] if len(found) < words else list(map(b" ".join, zip(*(found[i:] for i in range(words)))))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), _BLOCK):
        digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles[at : at + _BLOCK]])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles)).tobytes()


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = b"".join(fingerprint(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.frombuffer(made, ">i8").astype(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) for every row; a null text counts as empty and gives fingerprint zero."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fp long")


def _balls(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _spread(fps: DataFrame, distance: int, segments: int) -> DataFrame:
    """(key, fp): every fingerprint under each segment value within its small ball; two that differ in at most
    `distance` bits have a segment in which they differ in at most distance // segments bits, so that one lies in the
    other's ball there."""
    width = 64 // segments
    masks = ", ".join(f"{m}L" for m in _balls(width, distance // segments))
    parts = [f"transform(array({masks}), m -> ((shiftrightunsigned(fp, {s * width}) & {(1 << width) - 1}L) ^ m) | {s << width}L)" for s in range(segments)]
    return fps.select(F.explode(F.expr(f"concat({', '.join(parts)})")).alias("key"), "fp")


def _linker(distance: int, segments: int, limit: int, keys: int):
    """A mapInArrow function over rows sorted by their first `keys` columns: links of each bucket, or for buckets of
    over `limit` rows the rows themselves with hot set."""
    width = 64 // segments
    low = np.int64((1 << width) - 1)

    def near(x, y):
        return np.bitwise_count((x ^ y).view(np.uint64)) <= distance

    def walk(f: np.ndarray) -> tuple[list, list]:
        """A spanning forest of one large bucket: each pair at most once compared, n - 1 links at most."""
        left, out_a, out_b = f, [], []
        while len(left):
            frontier, left = left[:1], left[1:]
            while len(frontier) and len(left):
                grown = []
                for x in frontier:
                    hit = near(left, x)
                    if hit.any():
                        new = left[hit]
                        out_a.append(np.full(len(new), x)), out_b.append(new), grown.append(new)
                        left = left[~hit]
                        if not len(left):
                            break
                frontier = np.concatenate(grown) if grown else left[:0]
        return out_a, out_b

    def links(k: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """k: number of the bucket, ascending; f: fingerprints."""
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        sizes = np.diff(np.r_[starts, len(k)])
        group = np.repeat(np.arange(len(starts)), sizes)
        a, b = [f[:0]], [f[:0]]
        small = sizes[group] <= 32
        x, g = f[small], group[small]
        for step in range(1, int(sizes[sizes <= 32].max(initial=1))):
            ok = np.flatnonzero(g[step:] == g[:-step])
            ok = ok[near(x[ok], x[ok + step])]
            a.append(x[ok]), b.append(x[ok + step])
        for i in np.flatnonzero(sizes > 32):
            more = walk(f[starts[i] : starts[i] + sizes[i]])
            a += more[0]
            b += more[1]
        return np.concatenate(a), np.concatenate(b)

    def made(a, b, hot):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), hot))], ["a", "b", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # the rows of the last bucket seen
        count, spilling = 0, False

        def settle(cols, f):
            if len(f) < 2:
                return
            new = np.any(cols[:, 1:] != cols[:, :-1], axis=0)
            k = np.r_[0, np.cumsum(new)]
            if keys == 1:  # a bucket without a table entry of its own has only links that other buckets find
                own = (f >> (width * (cols[0] >> width)) & low) == (cols[0] & low)
                keep = (np.bincount(k, own)[k] > 0) & (np.bincount(k)[k] > 1)
                k, f = k[keep], f[keep]
            if len(f):
                a, b = links(k, f)
                if len(a):
                    yield made(a, b, False)

        for batch in batches:
            cols = np.vstack([batch.column(i).to_numpy() for i in range(keys)])
            f = batch.column(keys).to_numpy()
            if not len(f):
                continue
            if held and np.any(held[-1][0][:, -1] != cols[:, 0]):
                if not spilling:
                    yield from settle(np.hstack([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                held, count, spilling = [], 0, False
            same = np.all(cols == cols[:, -1:], axis=0)
            start = len(f) - int(np.argmin(same[::-1])) if not same.all() else 0  # where the last bucket begins
            if start:
                first = int(np.argmax(np.any(cols != cols[:, :1], axis=0)))  # the held bucket goes on up to here
                if spilling:
                    yield made(np.full(first, cols[0, 0]), f[:first], True)
                    held, count, spilling = [], 0, False
                    cols, f, start = cols[:, first:], f[first:], start - first
                if start or held:
                    yield from settle(np.hstack([*(h[0] for h in held), cols[:, :start]]), np.concatenate([*(h[1] for h in held), f[:start]]))
                held, count = [], 0
            held.append((cols[:, start:], f[start:]))
            count += len(f) - start
            if count > limit:
                for c, x in held:
                    yield made(c[0][: len(x)], x, True)
                held, spilling = [(cols[:, -1:], f[:0])], True
        if held and not spilling:
            yield from settle(np.hstack([h[0] for h in held]), np.concatenate([h[1] for h in held]))

    return run


def hamming_links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links of fingerprints (distinct longs in column fp) that differ in at most `distance` bits, enough of
    them to connect whatever is connected. Buckets are never expanded into pairs: each gives a spanning forest."""
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = _spread(fps, distance, segments).repartition(n, "key").sortWithinPartitions("key")
    found, _ = cut(spread.mapInArrow(_linker(distance, segments, bucket_rows, 1), "a long, b long, hot boolean"), "links")
    links, hot = found.filter("not hot").select("a", "b"), found.filter("hot").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if not hot.isEmpty():
        chunks = hot.groupBy("key").agg(F.ceil(2 * F.count("*") / bucket_rows).cast("int").alias("n"))
        dealt = (
            hot.join(chunks, "key")
            .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("n")).cast("long"))
            .select("key", "fp", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)).alias("d"))
            .select("key", F.least("c", "d").alias("x"), F.greatest("c", "d").alias("y"), "fp")
        )
        dealt = dealt.repartition(n, "key", "x", "y").sortWithinPartitions("key", "x", "y")
        links = links.unionByName(dealt.mapInArrow(_linker(distance, segments, 1 << 62, 3), "a long, b long, hot boolean").select("a", "b"))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, segments: int = SEGMENTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable over links).

    Null and empty texts, and texts without words, have fingerprint zero and link like any other. Rows with a null id
    are returned and take the smallest id of their group, null if there is none. Repeated rows stay, one result each.
    An empty table gives an empty result; other columns of docs are ignored."""
    rows, _ = cut(fingerprints(docs, id_col, text_col), "fingerprints")
    groups = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(hamming_links(groups.select("fp"), distance, segments, bucket_rows))
    member = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = member.join(ids, "root").select("fp", "component_id")
    return rows.join(member, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
