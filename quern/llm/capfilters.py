"""Near-duplicate vectors by spherical-cap filters: random product codes, list decoding, joins on filters, verification.

A filter is a direction of a structured code: the space is turned at random and cut into blocks, each block has a few
random unit vectors, and every choice of one per block makes a direction. A vector passes the filters whose direction it
is close to; they are listed block by block, without a look at the others. Two vectors of high cosine pass one filter
in common with a probability that the cap's height sets, and far ones hardly ever do."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import components, cut

COSINE = 0.98
#: Share of pairs at exactly COSINE that pass a filter in common in one of some independent codes; closer pairs do so more
#: often. Codes of half that share each cost least: lists are short, and where one code lists few filters another has more.
RECALL = 0.995
CODE_RECALL = 0.5
#: Directions per block; blocks of a vector. A code has CODES ** BLOCKS filters (65,536), of which a vector passes some
#: four; 2048 directions make four million, for tables of more than some 10^8 vectors of a label.
CODES = 256
BLOCKS = 2
SEED = 7
#: Members of a filter that a task compares with each other at once; larger filters are dealt out in pairs of chunks.
CHUNK_ROWS = 1024
_TRIALS = 500
_BATCH = 512


class ProductCode:
    """Directions of one dimension: block sums in two halves, so that all filters above a height come from two lists."""

    def __init__(self, dims: int, codes: int = CODES, blocks: int = BLOCKS, seed: int = SEED, number: int = 0):
        rng = np.random.default_rng([seed, dims, number])
        self.first = number * codes**blocks
        self.turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        self.blocks = max(1, min(blocks, dims // 2))
        edges = np.linspace(0, dims, self.blocks + 1).astype(int)
        self.parts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]
        self.books = []
        for p in self.parts:
            book = rng.standard_normal((codes, p.stop - p.start))
            self.books.append(book / np.sqrt((book**2).sum(axis=1))[:, None])

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the first blocks' products with a vector, for each choice of codes, and of the last blocks'."""
        turned = unit @ self.turn
        score = [turned[:, p] @ book.T for p, book in zip(self.parts, self.books)]
        out = []
        for some in (score[: self.blocks // 2], score[self.blocks // 2 :]):
            total = np.zeros((len(unit), 1))
            for s in some:
                total = (total[:, :, None] + s[:, None, :]).reshape(len(unit), -1)
            out.append(total)
        return out[0], out[1]

    def decode(self, unit: np.ndarray, height: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter whose direction has at least that product with a row, ascending."""
        rows, filters = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        least = height * np.sqrt(self.blocks)
        for at in range(0, len(unit), _BATCH):
            left, right = self.halves(unit[at : at + _BATCH])
            lr, lc = np.nonzero(left >= least - right.max(axis=1, keepdims=True))
            rr, rc = np.nonzero(right >= least - left.max(axis=1, keepdims=True))
            place = lr * 16.0 - left[lr, lc]  # products lie within 4 of zero, so rows stay apart
            order = np.argsort(place, kind="stable")
            place, lr, lc = place[order], lr[order], lc[order]
            first = np.searchsorted(lr, rr)
            n = np.maximum(np.searchsorted(place, rr * 16.0 - (least - right[rr, rc]), "right") - first, 0)
            pick = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, code = np.repeat(rr, n), lc[pick] * right.shape[1] + np.repeat(rc, n) + self.first
            order = np.lexsort((code, row))
            rows.append(row[order] + at), filters.append(code[order])
        return np.concatenate(rows), np.concatenate(filters)


@lru_cache(maxsize=16)
def codes_of(dims: int, cosine: float, recall: float, codes: int, blocks: int, seed: int) -> tuple[list[ProductCode], float]:
    """Codes of a dimension and the height of their caps: the greatest, in hundredths, at which CODE_RECALL of _TRIALS
    random pairs at exactly that cosine pass a filter of one code in common. It depends on the parameters alone."""
    n = int(np.ceil(np.log(1 - recall) / np.log(1 - CODE_RECALL)))
    made = [ProductCode(dims, codes, blocks, seed, i) for i in range(n)]
    rng = np.random.default_rng([seed, dims])
    a = rng.standard_normal((_TRIALS, dims))
    a /= np.sqrt((a**2).sum(axis=1))[:, None]
    b = rng.standard_normal((_TRIALS, dims))
    b -= (a * b).sum(axis=1)[:, None] * a
    norm = np.sqrt((b**2).sum(axis=1))[:, None]
    b = cosine * a + np.sqrt(1 - cosine**2) * np.divide(b, norm, out=np.zeros_like(b), where=norm > 1e-9)

    def enough(height: int) -> bool:
        x, y = made[0].decode(a, height / 100), made[0].decode(b, height / 100)
        return len(np.unique(np.intersect1d(x[0] * codes**blocks + x[1], y[0] * codes**blocks + y[1]) // codes**blocks)) >= CODE_RECALL * _TRIALS

    height = next((h for h in range(95, -100, -5) if enough(h)), -100)
    height = next((h for h in range(height + 4, height, -1) if enough(h)), height)
    return made, height / 100


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, whatever the size of their components."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _decoder(cosine: float, recall: float, codes: int, blocks: int, seed: int):
    """(no, filter) of every class of equal vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1)).to_numpy()
            for dims in np.unique(sizes):
                some = batch.filter(pa.array(sizes == dims))
                made, height = codes_of(int(dims), cosine, recall, codes, blocks, seed)
                unit = unit_rows(_matrix(some.column(1), int(dims)))
                for code in made:
                    rows, filters = code.decode(unit, height)
                    yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(rows)), pa.array(filters)], ["no", "filter"])

    return run


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def near(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which unit rows have at least that cosine. Products close to it are summed anew, in one order wherever they stand,
    so that a pair is judged alike in every block."""
    product = a @ b.T
    found = product >= cosine
    i, j = np.nonzero(np.abs(product - cosine) < 1e-12)
    found[i, j] = (a[i] * b[j]).sum(axis=1) >= cosine
    return found


def _common(a: np.ndarray, b: np.ndarray, filters_a: list[np.ndarray], filters_b: list[np.ndarray], least: int) -> np.ndarray:
    """For pairs of rows (positions in the lists): whether they share a filter below `least`."""
    lists = [f[f < least] for f in (*filters_a, *filters_b)]
    flat = np.concatenate(lists)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    known, number, many = np.unique(flat, return_inverse=True, return_counts=True)
    keep = many[number] > 1
    row, number = row[keep], np.unique(number[keep], return_inverse=True)[1]
    out = np.zeros((len(filters_a), len(filters_b)), bool)
    for at in range(0, int(number.max(initial=-1)) + 1, 2048):
        here = (number >= at) & (number < at + 2048)
        has = np.zeros((len(lists), 2048), np.float32)
        has[row[here], number[here] - at] = 1
        out |= has[: len(filters_a)] @ has[len(filters_a) :].T > 0
    return out[a, b]


def _forest(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, column) that connect what the set places of a matrix connect: all of them if they are few."""
    i, j = np.nonzero(found)
    if len(i) <= 2 * sum(found.shape):
        return i, j
    open_row, open_col = found.any(axis=1), found.any(axis=0)
    out = []
    while open_row.any():
        rows = np.flatnonzero(open_row)[:1]
        open_row[rows] = False
        while len(rows):  # columns not seen yet take one row each, then rows one column each
            cols = np.flatnonzero(found[rows].any(axis=0) & open_col)
            open_col[cols] = False
            out.append((rows[found[np.ix_(rows, cols)].argmax(axis=0)], cols))
            new = np.flatnonzero(found[:, cols].any(axis=1) & open_row) if len(cols) else rows[:0]
            open_row[new] = False
            out.append((new, cols[found[np.ix_(new, cols)].argmax(axis=1)] if len(new) else new))
            rows = new
    return tuple(np.concatenate(x) for x in zip(*out))


_LINKS = "a long, b long, links long"


def _verifier(cosine: float):
    """Over members of filters, sorted by (label, dims, filter, x, y): for each pair of chunks the links that connect its
    near pairs (a, b), and each member's number of them (a, links). A pair counts in its first common filter only."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        least, x, y, dims = (rows[c][0].as_py() for c in ("filter", "x", "y", "dims"))
        no, n, chunk = (rows[c].to_numpy() for c in ("no", "n", "c"))
        unit = unit_rows(_matrix(rows["v"].combine_chunks(), dims))
        one, two = np.flatnonzero(chunk == x), np.flatnonzero(chunk == y)
        found = near(unit[one], unit[two], cosine)
        if x == y:
            np.fill_diagonal(found, False)
        keep_a, keep_b = found.any(axis=1), found.any(axis=0)
        one, two, found = one[keep_a], two[keep_b], found[keep_a][:, keep_b]
        if not len(one):
            return
        i, j = np.nonzero(found)
        filters = rows["filters"].combine_chunks()
        lists = {int(r): filters[int(r)].values.to_numpy() for r in np.union1d(one, two)}
        found[i, j] = ~_common(i, j, [lists[r] for r in one.tolist()], [lists[r] for r in two.tolist()], least)
        a, b = _forest(np.triu(found) if x == y else found)
        yield _links(no[one[a]], no[two[b]], np.zeros(len(a), np.int64))
        yield _links(no[one], None, found @ n[two])
        if x != y:
            yield _links(no[two], None, found.T @ n[one])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch]) if held else pa.Table.from_batches([batch])
            new = np.zeros(whole.num_rows - 1, bool)
            for name in ("label", "dims", "filter", "x", "y"):
                c = whole[name]
                new |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy()
            cuts = np.flatnonzero(new) + (0 if held else 1)  # where another begins, in the batch
            at = 0
            for stop in cuts.tolist():
                if stop > at:
                    held.append(batch.slice(at, stop - at))
                yield from settle(pa.Table.from_batches(held))
                held, at = [], stop
            held.append(batch.slice(at))
        if held:
            yield from settle(pa.Table.from_batches(held))

    return run


def _links(a: np.ndarray, b: np.ndarray | None, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, recall: float = RECALL, codes: int = CODES, blocks: int = BLOCKS, seed: int = SEED, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: how many other rows of its label (equal, not null) and its
    dimension have at least that cosine with it, the smallest id reachable over such links, and whether that is its own.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows without a
    label. Equal vectors of a label are one class with a count, however many there are, and link with each other. Rows
    that repeat are vectors of their own. Null ids are never the smallest; a row is kept if its id is its component's,
    null being equal to null. An empty table gives an empty result; other columns are ignored."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    ok = F.col("label").isNotNull() & _valid(F.col("v"))
    classes = rows.filter(ok).groupBy("label", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))
    classes, _ = cut(classes.select("label", F.size("v").alias("dims"), "v", "n", "first_id", F.monotonically_increasing_id().alias("no")), "vectors")
    passed, _ = cut(classes.select("no", "v").mapInArrow(_decoder(cosine, recall, codes, blocks, seed), "no long, filter long").join(classes.select("no", "label", "dims"), "no"), "filters")
    key = ["label", "dims", "filter"]
    shared = passed.groupBy(*key).agg(F.count("*").alias("k")).filter("k > 1").select(*key, F.ceil(F.col("k") / chunk_rows).cast("int").alias("chunks"))
    own = passed.join(shared, key).groupBy("no").agg(F.sort_array(F.collect_list(F.struct("filter", "chunks"))).alias("own"))  # a vector passes a few filters
    members = (
        classes.join(own, "no")
        .select("no", "n", "label", "dims", "v", F.col("own.filter").alias("filters"), F.explode("own").alias("one"))
        .select("no", "n", "label", "dims", "v", "filters", "one.filter", F.pmod(F.xxhash64("no"), F.col("one.chunks")).cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.col("one.chunks") - 1)).alias("d"))
        .withColumns({"x": F.least("c", "d"), "y": F.greatest("c", "d")})
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartition(parts, *key, "x", "y").sortWithinPartitions(*key, "x", "y")
    found, _ = cut(dealt.mapInArrow(_verifier(cosine), _LINKS), "near")
    links = found.filter("b is null").groupBy(F.col("a").alias("no")).agg(F.sum("links").alias("more"))
    roots = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "no")
    member = classes.join(roots, "no", "left").join(links, "no", "left").withColumn("root", F.coalesce("root", "no"))
    ids = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = member.join(ids, "root").select("label", "v", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id", F.lit(True).alias("ok"))
    out = rows.withColumn("ok", ok).join(member, ["label", "v", "ok"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
