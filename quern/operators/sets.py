"""Sets of any size as rows: sorted, distinct, in chunks of equal length, each with its digest, and one digest per set.

What a cell holds is a chunk, however many members a set has; digests are combined level by level, so that neither a task
nor a cell has all chunks of a set. Equal sets, and only those (but for collisions of SHA-256), have equal digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.segments import in_segments
from quern.sources.store import scratch_table

#: Members of a chunk, and digests that one digest of the next level is made of.
CHUNK = 4096


def _digest(parts: Column, mark: str = "") -> Column:
    """SHA-256 of texts, each with its length in bytes before it, so that no other division gives the same; the mark
    before them tells digests of digests from digests of members."""
    return F.sha2(F.concat_ws("", F.lit(mark), F.transform(parts, lambda x: F.concat(F.octet_length(x).cast("string"), F.lit(":"), x))), 256)


def set_chunks(df: DataFrame, by: list[str], item: str | Column, size: int = CHUNK) -> DataFrame:
    """(by, chunk, n, items, digest): the distinct texts of each group, ascending by their UTF-8 bytes, `size` to a row
    (chunk from 0; only a group's last one may have fewer).

    NULL items are left out, groups without any other have no row; NULL keys are groups; `by` may be empty; an empty text
    is a member. Repeated rows are reduced before the shuffle."""
    return _chunks(df, by, item, size, F.lit(True))


def _chunks(df: DataFrame, by: list[str], item: str | Column, size: int, wanted: Column) -> DataFrame:
    if size < 2:
        raise ValueError("a chunk must have two members at least")
    keys = [f"_s{i}" for i in range(len(by))]
    value = (F.col(f"`{item}`") if isinstance(item, str) else item).cast("string")
    members = df.select(*(F.col(f"`{b}`").alias(k) for b, k in zip(by, keys)), value.alias("_item")).filter("_item IS NOT NULL").distinct()
    placed = in_segments(members, keys, ["_item"], 0, size)
    held = placed.groupBy(*keys, "_segment").agg(F.count("*").alias("_n"), F.sort_array(F.collect_list("_item")).alias("_items")).filter(wanted)
    own = [F.col("_segment").alias("chunk"), F.col("_n").alias("n"), F.col("_items").alias("items"), _digest(F.col("_items")).alias("digest")]
    return held.select(*(F.col(k).alias(b) for k, b in zip(keys, by)), *own)


def set_digests(chunks: DataFrame, by: list[str], size: int = CHUNK) -> DataFrame:
    """(by, n, chunks, digest) per set of set_chunks: members, chunks, and the digest of its chunks' digests, `size` of
    them at a time, in as many levels as leave one. A single digest is its own, so that a set's hangs on no other set."""
    if size < 2:
        raise ValueError("a digest must be made of two at least")
    keys = [f"_s{i}" for i in range(len(by))]
    level = chunks.select(*(F.col(f"`{b}`").alias(k) for b, k in zip(by, keys)), F.col("chunk").alias("_at"), F.col("n").alias("_n"), F.lit(1).cast("long").alias("_chunks"), F.col("digest").alias("_digest"))
    while True:
        parts = F.transform(F.sort_array(F.collect_list(F.struct("_at", "_digest"))), lambda p: p["_digest"])
        level = level.groupBy(*keys, F.floor(F.col("_at") / size).alias("_up")).agg(F.sum("_n").alias("_n"), F.sum("_chunks").alias("_chunks"), F.when(F.count("*") == 1, F.any_value("_digest")).otherwise(_digest(parts, "+")).alias("_digest"))
        level = scratch_table(level.withColumnRenamed("_up", "_at"), "digests")
        if level.filter("_at > 0").isEmpty():
            break
    return level.select(*(F.col(k).alias(b) for k, b in zip(keys, by)), F.col("_n").alias("n"), F.col("_chunks").alias("chunks"), F.col("_digest").alias("digest"))


def shared_members(df: DataFrame, by: list[str], item: str | Column, size: int = CHUNK) -> DataFrame:
    """set_chunks of the groups with more than one member: contents that several files have, layouts of several files. A
    group of one has a single chunk of one, so no count has to be joined."""
    return _chunks(df, by, item, size, (F.col("_n") > 1) | (F.col("_segment") > 0))
