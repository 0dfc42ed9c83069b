"""Indexes beside a table's parts: bounds and Bloom filters of their keys, and hash trees of their rows.

An upsert joins its batch with the parts that may hold one of its keys only; two tables are compared from the root of
their trees down, and only rows of leaves that differ are read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.sources.store import TableStore, scratch_table

#: Bits of a Bloom filter per row of its part, and hash functions: one key in 400 is taken for one that is there.
BITS = 16
HASHES = 4
_BUCKET = 32_768  # bits that bitmap_construct_agg takes
#: Levels of a hash tree below its root, and children of a node: 4096 leaves.
LEVELS = 3
FAN = 16
LEAVES = FAN**LEVELS


def _key(keys: list[str]) -> Column:
    return F.struct(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)))


def _places(keys: list[str], bits: Column) -> Column:
    """Bit numbers of a row's key in a filter of some bits."""
    return F.array(*(F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys), F.lit(i)), bits) for i in range(HASHES)))


def index_part(store: TableStore, table: str, part: str, keys: list[str]) -> None:
    """Writes a part's bounds and Bloom filter: <table>/_keys/<part> with (part, rows, low, high, bits, bucket, bitmap).
    Rows whose key has a NULL are no rows of the index, as such keys match nothing."""
    rows = store.read_parts(table, [part]).select(*(f"`{k}`" for k in keys)).filter(reduce(lambda a, b: a & b, (F.col(f"`{k}`").isNotNull() for k in keys)))
    facts = rows.agg(F.count("*").alias("rows"), F.min(_key(keys)).alias("low"), F.max(_key(keys)).alias("high"))
    facts = scratch_table(facts.withColumn("bits", F.greatest(F.ceil(F.col("rows") * BITS / _BUCKET), F.lit(1)) * _BUCKET), "facts")
    bits = facts.first().bits
    at = rows.select(F.explode(_places(keys, F.lit(bits))).alias("p")).select((F.col("p") / _BUCKET).cast("long").alias("bucket"), (F.col("p") % _BUCKET).alias("bit"))
    maps = at.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    facts.select(F.lit(part).alias("part"), "rows", "low", "high", "bits").join(maps, F.lit(True), "left").write.parquet(f"{store.root}/{table}/_keys/{part}")  # facts: one row


def _indexed(store: TableStore, table: str, parts: list[str]) -> list[str]:
    fs = store._fs()
    return [p for p in parts if fs.exists(store._path(table, "_keys", p, "_SUCCESS"))]


def parts_that_may_hold(store: TableStore, table: str, parts: list[str], batch: DataFrame, keys: list[str]) -> list[str]:
    """The parts that may hold a key of the batch: those whose bounds and Bloom filter let one through, and those without
    an index. No part that holds one is left out."""
    known = _indexed(store, table, parts)
    if not known:
        return parts
    index = store.spark.read.parquet(*(f"{store.root}/{table}/_keys/{p}" for p in known))
    asked = scratch_table(batch.select(*(f"`{k}`" for k in keys)).distinct(), "asked")
    ends = asked.agg(F.min(_key(keys)).alias("from"), F.max(_key(keys)).alias("to"))
    near = index.select("part", "low", "high", "bits").distinct().join(ends, (F.col("to") >= F.col("low")) & (F.col("from") <= F.col("high")))  # ends: one row
    near = {r.part: r.bits for r in near.select("part", "bits").collect()}  # of the version's parts
    if not near:
        return [p for p in parts if p not in known]
    # filters of one size have equal places, so that a key is hashed once per size
    sizes = F.array(*(F.lit(b).cast("long") for b in sorted(set(near.values()))))
    probes = asked.select(_key(keys).alias("key"), *(f"`{k}`" for k in keys), F.explode(sizes).alias("bits"))
    probes = probes.select("key", "bits", F.explode(_places(keys, F.col("bits"))).alias("p"))
    probes = probes.select("key", "bits", (F.col("p") / _BUCKET).cast("long").alias("bucket"), (F.col("p") % _BUCKET).alias("bit")).distinct()
    count = probes.groupBy("key", "bits").agg(F.count("*").alias("_all"))
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("bit") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    held = F.call_function("getbit", byte, (F.col("bit") % 8).cast("int")) == 1
    hits = probes.join(index.filter(F.col("part").isin(list(near))).filter("bucket IS NOT NULL"), ["bits", "bucket"]).filter(held & F.col("key").between(F.col("low"), F.col("high")))
    found = hits.groupBy("part", "key", "bits").agg(F.count("*").alias("_n")).join(count, ["key", "bits"]).filter("_n = _all").select("part").distinct()
    may = {r.part for r in found.collect()}  # of the version's parts
    return [p for p in parts if p not in known or p in may]


def row_hash(df: DataFrame, cols: list[str]) -> Column:
    """A number for a row's content, as decimal so that sums don't overflow. NULLs count: values that move between
    columns change it. Nested columns count as JSON."""
    nested = lambda c: df.schema[c].dataType.typeName() in ("struct", "array", "map")
    values = [x for c in cols for x in (F.col(f"`{c}`").isNull(), F.to_json(c) if nested(c) else F.col(f"`{c}`"))]
    return F.xxhash64(*values).cast("decimal(38,0)") * 4_294_967_296 + F.hash(*values)


def _leaf(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(LEAVES)).cast("int")


def write_with_tree(store: TableStore, table: str, df: DataFrame, keys: list[str]) -> int:
    """A version of df whose rows lie by leaf of their key, so that a leaf's rows are read from a few row groups, with
    the sums of each leaf beside it: the sums of parts add up to those of tables."""
    laid = df.withColumn("_leaf", _leaf(keys)).repartitionByRange("_leaf").sortWithinPartitions("_leaf")
    part = store.write_part(table, laid)
    now = store.read_parts(table, [part])
    cols = sorted(c for c in now.columns if c != "_leaf")
    now.groupBy("_leaf").agg(F.count("*").alias("n"), F.sum(row_hash(now, cols)).alias("sum")).write.parquet(f"{store.root}/{table}/_trees/{part}")
    return store.replace(table, [], [part], keep=False)


def tree(store: TableStore, table: str, version: int | None = None) -> DataFrame:
    """(level, node, n, sum): the leaves of a version, and their sums up to the root."""
    leaves = store.spark.read.parquet(*(f"{store.root}/{table}/_trees/{p}" for p in store.parts(table, version)))
    leaves = leaves.groupBy("_leaf").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
    levels = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.floor(F.col("_leaf") / FAN ** (LEVELS - k)).cast("int").alias("node")) for k in range(LEVELS + 1))))
    return leaves.select(levels.alias("at"), "n", "sum").groupBy("at.level", "at.node").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))


def differing_leaves(one: DataFrame, two: DataFrame) -> tuple[list[int], int]:
    """The leaves in which two trees differ, and the nodes looked at on the way: children of equal nodes are not."""
    both = one.withColumn("side", F.lit(1)).unionByName(two.withColumn("side", F.lit(2)))
    nodes = scratch_table(both.groupBy("level", "node").agg(*(F.max(F.when(F.col("side") == s, F.struct("n", "sum"))).alias(f"s{s}") for s in (1, 2))), "tree")
    open_, seen = [0], 0
    for level in range(LEVELS + 1):
        at = nodes.filter((F.col("level") == level) & F.col("node").isin(open_)).select("node", (~F.col("s1").eqNullSafe(F.col("s2"))).alias("differs")).collect()  # LEAVES at most
        seen += len(at)
        differ = sorted(r.node for r in at if r.differs)
        if not differ or level == LEVELS:
            return differ, seen
        open_ = [n * FAN + i for n in differ for i in range(FAN)]
    return [], seen


def differing_rows(store: TableStore, one: str, two: str) -> tuple[DataFrame, list[int]]:
    """Rows that one table has more often than the other, with how many more (above zero) or fewer (below), and the
    leaves that were read for it: none if the tables are equal, which their trees tell without reading a row."""
    leaves, _ = differing_leaves(tree(store, one), tree(store, two))
    sides = [store.read(t).filter(F.col("_leaf").isin(leaves)).drop("_leaf").withColumn("_d", F.lit(d)) for t, d in ((one, 1), (two, -1))]
    both = sides[0].unionByName(sides[1])
    cols = [f"`{c}`" for c in both.columns if c != "_d"]
    return both.groupBy(*cols).agg(F.sum("_d").alias("surplus")).filter("surplus <> 0"), leaves
