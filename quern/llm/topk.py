"""Exact top-k inner-product search: shards by space, a ball tree in each, branch and bound, two rounds that share the
k-th score. A query goes first to the shard of the highest bound, then only to shards whose bound reaches its k-th score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.shared import cut

#: Rows of a leaf; rows of a shard and of a block of queries at most: what a task holds at once, some 50 MB at 64
#: components.
LEAF = 64
SHARD_ROWS = 65_536
BLOCK_ROWS = 16_384
#: Vectors that the regions of space are drawn from, about. Every vector is then put into a region, with exact bounds.
SAMPLE_ROWS = 16_384
_MOST, _LEAST = (1 << 63) - 1, -(1 << 63)


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as double; null if the vector is null or has a null or non-finite one."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


class BallTree:
    """Balls over integer vectors, split at the median along the direction of the farthest pair of a rough search;
    nodes lie in arrays: children follow by number, leaves hold ranges of rows."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(rows))
        self.center, self.radius, self.range, self.child = [], [], [], []
        stack = [(0, len(rows), -1, 0)] if len(rows) else []
        while stack:
            low, high, parent, side = stack.pop()
            part = rows[self.order[low:high]]
            center = part.mean(axis=0)
            off = np.sqrt(((part - center) ** 2).sum(axis=1))
            node = len(self.center)
            self.center.append(center), self.radius.append(off.max()), self.range.append((low, high)), self.child.append([-1, -1])
            if parent >= 0:
                self.child[parent][side] = node
            if high - low > leaf:
                far = part[off.argmax()]
                axis = part[((part - far) ** 2).sum(axis=1).argmax()] - far
                middle = (high - low) // 2
                self.order[low:high] = self.order[low:high][np.argpartition(part @ axis, middle)]
                stack += [(low, low + middle, node, 0), (low + middle, high, node, 1)]
        self.center, self.radius = np.array(self.center), np.array(self.radius)
        self.child = np.array(self.child).reshape(-1, 2)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products as int64 (beyond its range: its ends). Floating point where every sum fits its mantissa."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.array([[min(max(x, _LEAST), _MOST) for x in row] for row in exact], np.int64).reshape(exact.shape)


def search(ids: np.ndarray, rows: np.ndarray, numbers: np.ndarray, query_numbers: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Branch and bound over one shard. numbers: of the rows, a query's own row being no candidate. floor: the k-th score
    that each query has already; lower scores are left out. Returns positions of queries, ids and scores of each query's
    best k here."""
    tree, n = BallTree(rows.astype(np.float64)), len(queries)
    best = np.full((n, k), _LEAST)
    best_id = np.full((n, k), _MOST)
    best_no = np.full((n, k), -1)
    if not len(ids) or not n:
        return np.empty(0, int), np.empty(0, int), np.empty(0, int)
    q = queries.astype(np.float64)
    norm = np.sqrt((q**2).sum(axis=1))
    kth = floor.copy()

    def bound(nodes, who):
        """No row of a node scores more: at its center, and its radius along the query; a little is added for rounding."""
        top = q[who] @ tree.center[nodes].T + norm[who, None] * tree.radius[nodes][None, :]
        return top + 1e-9 * np.abs(top) + 1e-6

    def visit(node, who):
        low, high = tree.range[node]
        at = tree.order[low:high]
        score = _scores(queries[who], rows[at])
        score_id = np.broadcast_to(ids[at], score.shape)
        own = numbers[at][None, :] == query_numbers[who][:, None]
        all_s = np.concatenate([best[who], np.where(own, _LEAST, score)], axis=1)
        all_i = np.concatenate([best_id[who], np.where(own, _MOST, score_id)], axis=1)
        all_n = np.concatenate([best_no[who], np.where(own, -1, numbers[at][None, :])], axis=1)
        pick = np.lexsort((all_n == -1, all_i, ~all_s), axis=1)[:, :k]  # ~x falls as x rises and cannot overflow
        best[who], best_id[who], best_no[who] = (np.take_along_axis(x, pick, 1) for x in (all_s, all_i, all_n))
        full = best_no[who, -1] != -1
        kth[who] = np.where(full, np.maximum(kth[who], best[who, -1]), kth[who])

    # down to the leaves level by level, dropping what no query can use, most promising node first
    everyone = np.arange(n)
    start = np.zeros(n, int)  # each query first visits the leaf that its best child leads to
    for _ in range(64):
        inner = tree.child[start, 0] >= 0
        if not inner.any():
            break
        pair = tree.child[start[inner]]
        top = (q[inner][:, None, :] * tree.center[pair]).sum(axis=2) + norm[inner, None] * tree.radius[pair]
        start[inner] = pair[np.arange(len(pair)), top.argmax(axis=1)]
    for node in np.unique(start):
        visit(node, everyone[start == node])
    work = [(0, everyone)]
    while work:
        node, who = work.pop()
        who = who[bound(np.array([node]), who)[:, 0] >= kth[who]]  # the k-th scores may have risen since
        if tree.child[node, 0] < 0:
            who = who[start[who] != node]
            if len(who):
                visit(node, who)
        elif len(who):
            pair = tree.child[node]
            top = bound(pair, who)
            for j in np.argsort(top.max(axis=0)):  # the last is taken first: the highest bound
                work.append((pair[j], who[top[:, j] >= kth[who]]))
    keep = (best_no != -1) & (best >= floor[:, None])
    who = np.nonzero(keep)[0]
    return who, best_id[keep], best[keep]


def _searcher(k: int):
    """One shard against one block of queries; all its vectors have one length."""

    def run(_, shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        who, found, score = np.empty((3, 0), np.int64)
        if len(shard) and len(block):
            who, found, score = search(shard["vec_id"].to_numpy(np.int64), _matrix(shard["v"]), shard["number"].to_numpy(np.int64), block["number"].to_numpy(np.int64), _matrix(block["v"]), block["kth"].to_numpy(np.int64), k)
        return pd.DataFrame({"number": block["number"].to_numpy(np.int64)[who.astype(int)], "query_id": block["vec_id"].to_numpy(np.int64)[who.astype(int)], "vec_id": found, "score": score})

    return run


def _matrix(vectors) -> np.ndarray:
    vectors = list(vectors)
    return np.array(vectors, np.int64).reshape(len(vectors), -1)


class Regions:
    """Parts of space: a sample is halved again and again along the direction of its farthest pair, at the median."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.axis, self.at, self.child, self.center = [], [], [], []
        stack = [(sample, leaves, None, 0)]
        while stack:
            part, n, parent, side = stack.pop()
            center = part.mean(axis=0)
            far = part[((part - center) ** 2).sum(axis=1).argmax()]
            axis = part[((part - far) ** 2).sum(axis=1).argmax()] - far
            along = part @ axis
            low = along <= np.median(along)
            if n > 1 and not low.all():
                node = len(self.axis)
                self.axis.append(axis), self.at.append(np.median(along)), self.child.append([0, 0])
                stack += [(part[low], n // 2, node, 0), (part[~low], n - n // 2, node, 1)]
            else:
                node = ~len(self.center)  # a region
                self.center.append(center)
            if parent is None:
                self.root = node
            else:
                self.child[parent][side] = node
        self.axis, self.at, self.child, self.center = np.array(self.axis), np.array(self.at), np.array(self.child), np.array(self.center)

    def of(self, rows: np.ndarray) -> np.ndarray:
        """Number of each row's region."""
        node = np.full(len(rows), self.root)
        while len(inner := np.flatnonzero(node >= 0)):
            own = node[inner]
            node[inner] = self.child[own, ((rows[inner] * self.axis[own]).sum(axis=1) > self.at[own]).astype(int)]
        return ~node


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vector length, places of the rows that have it, and their vectors as doubles."""
    vectors = batch.column(column)
    size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield int(n), at, vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), int(n))


def _place(shared):
    """Adds to vectors their length, their region, and how far they lie from its center."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, region, off = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for n, at, rows in _by_length(batch, "v"):
                length[at] = n
                if n in shared.value and n:
                    own = shared.value[n]
                    region[at] = own.of(rows)
                    off[at] = np.sqrt(((rows - own.center[region[at]]) ** 2).sum(axis=1))
                else:
                    off[at] = np.sqrt((rows**2).sum(axis=1))  # a length that the sample lacks is one region about zero
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length), pa.array(region), pa.array(off)], [*batch.schema.names, "length", "region", "off"])

    return run


def _route(shared, first: bool):
    """Regions that a query goes to: that of the highest bound (first), or all others than this (home) whose bound
    reaches the query's k-th score. (number, vec_id, v, kth, length, region)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at, rows in _by_length(batch, "v"):
                if n not in shared.value:
                    continue
                region, center, radius = shared.value[n]
                kth = batch.column("kth").to_numpy()[at]
                for low in range(0, len(at), 256):
                    some = slice(low, low + 256)
                    norm = np.sqrt((rows[some] ** 2).sum(axis=1))
                    bound = rows[some] @ center.T + norm[:, None] * radius
                    if first:
                        who, to = np.arange(len(bound)), bound.argmax(axis=1)
                    else:
                        bound += 1e-9 * np.abs(bound) + 1e-6  # for rounding
                        reach = bound >= kth[some][:, None]
                        home = batch.column("home").to_numpy()[at][some]
                        reach[np.arange(len(reach)), np.searchsorted(region, home)] = False
                        who, to = np.nonzero(reach)
                    places = pa.array(at[some][who])
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(places) for c in ("number", "vec_id", "v", "kth")), pa.array(np.full(len(who), n), pa.int32()), pa.array(region[to], pa.int32())], ["number", "vec_id", "v", "kth", "length", "region"])

    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k best of all vectors but its own row, by integer
    inner product, ties to the smaller id; all of them if there are fewer.

    vectors, queries: (number long, vec_id long, v array<long>), number naming the rows: a query's own row is the vector of
    its number. Rows with a null id or vector take no part; vectors of different lengths don't meet; rows that share an id
    are candidates and queries each by itself. Vectors are put into regions of space and, where a region has more than
    shard_rows, dealt into shards; queries of a shard are dealt into blocks: a task holds one shard and one block."""
    spark = vectors.sparkSession
    context = spark.sparkContext
    names = ["number", "vec_id", "v"]
    rows, _ = cut(vectors.select(*names).filter("vec_id is not null and v is not null"), "vectors")
    asked, _ = cut(queries.select(*names).filter("vec_id is not null and v is not null"), "queries")
    n = rows.count()
    part = F.pmod(F.xxhash64("number", F.lit("sample")), F.lit(1 << 30)) < F.lit(sample_rows / max(n, 1) * (1 << 30))
    sample = [np.array(r.v, np.float64) for r in rows.filter(part).select("v").collect()]  # sample_rows, about
    spread = 2 * max(context.defaultParallelism, 4)
    regions = max(-(-n // shard_rows), min(spread, -(-n // 256)), 1)
    lengths = {len(v) for v in sample}
    held = {m: Regions(np.array([v for v in sample if len(v) == m]), regions) for m in lengths if m}
    placed, _ = cut(rows.mapInArrow(_place(context.broadcast(held)), "number long, vec_id long, v array<long>, length int, region int, off double"), "placed")
    found = placed.groupBy("length", "region").agg(F.max("off").alias("radius"), F.count("*").alias("n"))
    bounds: dict[int, list] = {}
    for r in found.orderBy("length", "region").collect():  # a row per region: n / shard_rows of them, about
        center = held[r.length].center[r.region] if r.length in held else np.zeros(r.length)
        bounds.setdefault(r.length, []).append((r.region, center, r.radius))
    shared = context.broadcast({m: (np.array([x[0] for x in b]), np.array([x[1] for x in b]).reshape(len(b), m), np.array([x[2] for x in b])) for m, b in bounds.items()})
    key = ["length", "region"]
    pieces = found.select(*key, F.ceil(F.col("n") / shard_rows).alias("pieces"))
    dealt = placed.join(pieces, key).select(*names, *key, F.pmod(F.xxhash64("number"), F.col("pieces")).alias("piece"))

    def round_(queries: DataFrame, first: bool) -> tuple[DataFrame, DataFrame]:
        sent, _ = cut(queries.mapInArrow(_route(shared, first), "number long, vec_id long, v array<long>, kth long, length int, region int"), "sent")
        blocks, _ = cut(sent.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).alias("blocks")), "blocks")
        left = dealt.join(blocks, key).select(*names, *key, "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        right = sent.join(blocks, key).join(pieces, key).select(*names, "kth", *key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"), F.pmod(F.xxhash64("number", F.lit("block")), F.col("blocks")).alias("block"))
        task = [*key, "piece", "block"]
        return sent, left.groupBy(*task).cogroup(right.groupBy(*task)).applyInPandas(_searcher(k), "number long, query_id long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    sent, found = round_(asked.withColumn("kth", F.lit(_LEAST)), True)
    first, _ = cut(ranked(found), "topk")
    floor = first.groupBy("number").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(_LEAST).alias("kth"))
    homes = sent.select("number", F.col("region").alias("home"))
    second = asked.join(homes, "number").join(floor, "number", "left").select(*names, F.coalesce("kth", F.lit(_LEAST)).alias("kth"), "home")
    return ranked(first.drop("rank").unionByName(round_(second, False)[1])).select("query_id", "rank", "vec_id", "score")


def embedding_top_k(embeddings: DataFrame, every: int = 20, k: int = 20, scale: int = 64, **limits: int) -> DataFrame:
    """exact_top_k of the rows whose vec_id is divisible by `every` against all rows, after quantizing components."""
    rows = embeddings.select(F.monotonically_increasing_id().alias("number"), F.col("vec_id").cast("long").alias("vec_id"), quantized(F.col("embedding"), scale).alias("v"))
    rows, _ = cut(rows.filter("vec_id is not null and v is not null"), "quantized")
    return exact_top_k(rows, rows.filter(F.col("vec_id") % every == 0), k, **limits)
