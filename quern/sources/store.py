"""Versioned parquet tables: a version is a list of part folders that are written once, so an append writes its own rows
only, and an upsert or a clean-up only the parts that it touches. Reached through Spark and Hadoop paths."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINEAGE = ("_ingestion_run_id", "_ingestion_batch_id", "_ingestion_chunk_id", "_ingestion_timestamp", "_source_id", "_source_file", "_source_checksum", "_source_snapshot_id")


def scratch_store(spark: SparkSession) -> TableStore:
    """A store of its own in the folder that executors share (spark.checkpoint.dir), or where that is unset, in a local
    session, in a local one; it goes when the application ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quern-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    store = TableStore(spark, f"{root.rstrip('/')}/store-{uuid.uuid4().hex}")
    atexit.register(store.drop)
    return store


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """df, written to a store of its own in the shared folder and read back: what follows starts from there, also when
    executors are lost, and Spark knows its size."""
    store = scratch_store(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(f"{store.root}/{name}/{store.write_part(name, df)}")


class TableStore:
    """Tables under one root: <root>/<table>/part-<id>/, and per published version a file that lists its parts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop(self) -> None:
        try:
            self._fs().delete(self._path("."), True)
        except Exception:  # the JVM may be gone already
            pass

    def remove(self, *at: str) -> None:
        self._fs().delete(self._path(*at), True)

    def versions(self, table: str) -> list[int]:
        fs, at = self._fs(), self._path(table, "_published")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(at)) if fs.exists(at) else []

    def current(self, table: str) -> int | None:
        return max(self.versions(table), default=None)

    def parts(self, table: str, version: int | None = None) -> list[str]:
        """Names of the parts of a pinned version, or of the newest published one."""
        v = version if version is not None else self.current(table)
        if v is None or v not in self.versions(table):
            raise LookupError(f"{table} has no version {v}")
        source = self._fs().open(self._path(table, "_published", str(v)))
        try:
            return bytes(source.readAllBytes()).decode().split()
        finally:
            source.close()

    def read_parts(self, table: str, parts: list[str]) -> DataFrame:
        paths = [f"{self.root}/{table}/{p}" for p in parts]
        return self.spark.read.option("mergeSchema", len(paths) > 1).option("basePath", paths[0] if len(paths) == 1 else f"{self.root}/{table}").parquet(*paths)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self.read_parts(table, self.parts(table, version))

    def publish(self, table: str, version: int, parts: list[str]) -> None:
        """Lists the parts of a version in one step: readers see it only when all of it is written."""
        fs, at = self._fs(), self._path(table, "_published", str(version))
        fs.mkdirs(self._path(table, "_published"))
        draft = self._path(table, f"_draft-{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray("\n".join(parts).encode()))
        out.close()
        if fs.exists(at) or not fs.rename(draft, at):
            raise FileExistsError(f"{table} version {version} is published already")

    def write_part(self, table: str, df: DataFrame, partitions: tuple[str, ...] = ()) -> str:
        part = f"part-{uuid.uuid4().hex}"
        df.write.partitionBy(*partitions).parquet(f"{self.root}/{table}/{part}")
        return part

    def write(self, table: str, df: DataFrame, partitions: tuple[str, ...] = ()) -> int:
        """A new version of df alone; df may read the version before."""
        return self.replace(table, [], [self.write_part(table, df, partitions)], keep=False)

    def replace(self, table: str, gone: list[str], new: list[str], keep: bool = True) -> int:
        """A version without some parts of the current one (without all of them unless keep) and with new ones."""
        now = self.current(table)
        old = self.parts(table, now) if now is not None and keep else []
        v = (now or 0) + 1
        self.publish(table, v, [p for p in old if p not in gone] + new)
        return v

    def part_of(self) -> Column:
        """The part that a row of read() comes from."""
        return F.regexp_extract("_metadata.file_path", "/(part-[0-9a-f]{32})/", 1)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as multisets, column by column and NULL by NULL: one grouped count of both, one side's rows counting down."""
    if a.columns != b.columns:
        return False
    both = a.withColumn("_d", F.lit(1)).unionByName(b.withColumn("_d", F.lit(-1)))
    return both.groupBy(*(f"`{c}`" for c in a.columns)).agg(F.sum("_d").alias("_n")).filter("_n <> 0").isEmpty()


def write_snapshot(store: TableStore, table: str, df: DataFrame, partitions: tuple[str, ...] = ()) -> int:
    """Overwrites a whole table, or leaves it alone if the content is the same; what was written is read back."""
    now = store.current(table)
    if now is not None and same_rows(df.select(*sorted(df.columns)), store.read(table).select(*sorted(df.columns))):
        return now
    v = store.write(table, df, partitions)
    if not same_rows(df.select(*sorted(df.columns)), store.read(table, v).select(*sorted(df.columns))):
        raise IOError(f"{table} version {v} does not read back as written")
    return v


def append_rows(store: TableStore, table: str, df: DataFrame) -> int:
    """A version with one part more; columns that one side lacks are NULL there."""
    return store.replace(table, [], [store.write_part(table, df)])


def append_once(store: TableStore, table: str, df: DataFrame, run_id: str, chunk_id: int) -> bool:
    """Appends a chunk known by (run, chunk) unless it is there already; other content under that name is an error.
    Only the chunk's own rows are compared and written."""
    chunk = df.withColumns({"_ingestion_run_id": F.lit(run_id), "_ingestion_chunk_id": F.lit(chunk_id).cast("long")})
    if store.current(table) is not None:
        there = store.read(table).filter((F.col("_ingestion_run_id") == run_id) & (F.col("_ingestion_chunk_id") == chunk_id))
        if not there.isEmpty():
            if same_rows(there.select(*chunk.columns), chunk):
                return False
            raise ValueError(f"chunk {chunk_id} of run {run_id} is there with other rows")
    part = store.write_part(table, chunk)
    if not same_rows(store.read_parts(table, [part]).select(*chunk.columns), chunk):
        raise IOError("the chunk does not read back as written")
    store.replace(table, [], [part])
    return True


def bronze_append(store: TableStore, table: str, df: DataFrame, **lineage) -> int:
    """Appends source rows with the eight lineage columns; see files.bronze_lineage for their names."""
    from quern.sources.files import bronze_lineage

    return append_rows(store, table, bronze_lineage(df, **lineage))


def upsert_table(store: TableStore, table: str, incoming: DataFrame, keys: list[str], ts: str, partitions: tuple[str, ...] = ()) -> int:
    """A version after the upsert, or the current one if the upsert would change nothing. Parts that hold a row to be
    replaced are written anew, others stay; rows of new keys make part of the same new part. Only parts that may hold a
    key of the batch, by the bounds and Bloom filters beside them, are read; new parts get theirs."""
    from quern.operators.upsert import judged, upsert
    from quern.sources.index import index_part, parts_that_may_hold

    def written(df: DataFrame) -> str:
        part = store.write_part(table, df, partitions)
        index_part(store, table, part, keys)
        return part

    now = store.current(table)
    if now is None:
        return store.replace(table, [], [written(incoming)], keep=False)
    parts = store.parts(table, now)
    near = parts_that_may_hold(store, table, parts, incoming, keys)
    if near:
        target = store.read_parts(table, near).withColumn("_part", store.part_of())
        verdict = judged(target, incoming, keys, ts)
    else:
        verdict = incoming.withColumns({"_take": F.lit(True), "_part": F.lit(None).cast("string")})
    name = store.write_part("_plans", verdict)
    try:
        plan = store.read_parts("_plans", [name])
        touched = [r._part for r in plan.filter("_take AND _part IS NOT NULL").select("_part").distinct().collect()]  # of the version's parts
        rows = plan.filter(F.col("_take") | F.col("_part").isin(touched)).drop("_part", "_take")
        if not touched and rows.isEmpty():
            return now
        made = upsert(store.read_parts(table, touched), rows, keys, ts) if touched else rows
        return store.replace(table, touched, [written(made)])
    finally:
        store.remove("_plans", name)


def clean_up(store: TableStore, table: str, keep: int = 1) -> list[str]:
    """Removes all but the newest `keep` versions of a table, then the parts, with what stands beside them, that no
    version left names; returns these parts. Readers of removed versions must be done."""
    versions = store.versions(table)
    for v in versions[:-keep]:
        store.remove(table, "_published", str(v))
    used = {p for v in versions[-keep:] for p in store.parts(table, v)}
    gone = [s.getPath().getName() for s in store._fs().listStatus(store._path(table)) if s.getPath().getName().startswith("part-") and s.getPath().getName() not in used]
    for part in gone:
        for at in ((part,), ("_keys", part), ("_trees", part)):
            store.remove(table, *at)
    return sorted(gone)


def new_artifacts(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Artifacts whose content (source and checksum) no earlier run has loaded."""
    return manifest.join(loaded.select("source_id", "sha256").distinct(), ["source_id", "sha256"], "left_anti").select(manifest.columns)


def verify_run(df: DataFrame, run_id: str, rows: int) -> DataFrame:
    """One row: rows of a run, whether as many as expected and all of one source."""
    mine = df.filter(F.col("_ingestion_run_id") == run_id)
    return mine.agg(F.count("*").alias("n_rows"), F.count_distinct("_source_id").alias("n_sources")).withColumn("ok", (F.col("n_rows") == rows) & (F.col("n_sources") <= 1))


def cleanup_run(store: TableStore, table: str, run_id: str) -> int:
    """A version without the rows of one failed run: parts without such rows stay as they are."""
    mine = F.col("_ingestion_run_id").eqNullSafe(run_id)
    hit = [r.part for r in store.read(table).filter(mine).select(store.part_of().alias("part")).distinct().collect()]  # of the version's parts
    if not hit:
        return store.current(table)
    return store.replace(table, hit, [store.write_part(table, store.read_parts(table, hit).filter(~mine))])


def compact(store: TableStore, table: str, partitions: tuple[str, ...] = ()) -> int:
    """A version of the same rows in one part."""
    return store.write(table, store.read(table), partitions)


def read_incremental(df: DataFrame, run_id: str | None = None, watermark=None, ts: str = "_ingestion_timestamp") -> DataFrame:
    """Rows of a run, rows after a high-water mark, or both; neither is an error."""
    if run_id is None and watermark is None:
        raise ValueError("an incremental read needs a run or a watermark")
    wanted = [F.col("_ingestion_run_id") == run_id] if run_id is not None else []
    wanted += [F.col(ts) > F.lit(watermark)] if watermark is not None else []
    return df.filter(reduce(lambda a, b: a & b, wanted))


def advance_watermark(df: DataFrame, col: str, current=None) -> DataFrame:
    """One row: the greatest value seen, the current one on an empty load, never less than it."""
    kind = df.schema[col].dataType
    return df.agg(F.greatest(F.max(col), F.lit(current).cast(kind)).alias("watermark"))


def publish_batch(store: TableStore, versions: dict[str, int], dq: DataFrame) -> int:
    """Publishes a batch (a manifest of table versions) only if every row of dq (check, violations) is zero."""
    if not dq.filter("violations IS NULL OR violations <> 0").isEmpty():
        raise ValueError("the batch has violations and is not published")
    rows = [(t, v) for t, v in sorted(versions.items())]
    for table, v in rows:
        if v not in store.versions(table):
            raise LookupError(f"{table} has no version {v}")
    return store.write("_batches", store.spark.createDataFrame(rows, "table string, version long"))
