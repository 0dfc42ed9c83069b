"""Helpers of the training-data operators: shared scratch tables and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or where that is unset, in a local session (tests), a new
    local one. A cluster without the setting is an error, as executors would write to disks of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="quern-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes df as a table in the shared folder and reads it back: lineage ends there and a lost executor loses nothing.

    Returns the table and its path; the caller may remove() it once nothing reads it. What is left goes when the
    application ends."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/quern-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def _forget(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the JVM may be gone already
        pass


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds few texts as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def doc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a long, b long): (node, root), root being the smallest node reachable.

    Alternates large-star and small-star steps until the edges stay as they are. Each step groups with partial
    aggregation and joins on the node, so that hubs are pre-aggregated and split by adaptive execution. Nodes without
    edges are not listed; loops and nulls are ignored; an empty input gives an empty result. Rounds grow with the logarithm
    of a component's size; more than max_rounds, which no real graph takes, are an error."""
    spark = edges.sparkSession
    now, path = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    before = _digest(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(low, "hi")
            .select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct("hi", F.col("m").alias("lo")))).alias("e"))
            .select("e.hi", "e.lo").filter("hi <> lo").distinct()
        )
        after, new_path = cut(small, "edges")
        remove(spark, path)
        now, path, digest = after, new_path, _digest(after)
        if digest == before:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = digest
    if before[0]:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
