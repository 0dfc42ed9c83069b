"""Window functions over series of any length: each series is cut into segments of equal rows, and every segment gets the
last rows of the one before it, so that a task holds a segment and not a series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.match import join_back
from quern.sources.store import scratch_table

ROWS = 100_000


def in_segments(df: DataFrame, by: list[str], order: list[str], halo: int, rows: int = ROWS) -> DataFrame:
    """df with _index (the row's number in its series, from 0), _segment (its number there) and _halo: rows that are
    given again, before the segment that they go on into. `by` may be empty, its NULLs are series of their own; `order`
    must tell the rows of a series apart, or ties stand in any order."""
    if not 0 <= halo <= rows:
        raise ValueError("a segment must have as many rows as its halo")
    place = [*by, *order]
    ranged = df.repartitionByRange(*place).sortWithinPartitions(*place).withColumn("_range", F.spark_partition_id())
    ranged = scratch_table(ranged, "ranges")
    counts = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_n"))  # a row per series and range
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*by, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))
    numbered = join_back(ranged, counts, [*by, "_range"]).withColumn("_index", F.col("_before") + number - 1).drop("_before", "_range")
    own = F.floor(F.col("_index") / rows).cast("long")
    again = F.array(F.struct((own + 1).alias("segment"), F.lit(True).alias("halo")))
    places = F.array(F.struct(own.alias("segment"), F.lit(False).alias("halo")))
    last = F.col("_index") % rows >= rows - halo
    return numbered.withColumn("_at", F.explode(F.when(last, F.concat(places, again)).otherwise(places))).withColumns({"_segment": F.col("_at.segment"), "_halo": F.col("_at.halo")}).drop("_at")


def over_segments(df: DataFrame, by: list[str], order: list[str], halo: int, compute: Callable[[DataFrame, list[str], str], DataFrame], rows: int = ROWS) -> DataFrame:
    """What compute(df, by, period) gives over whole series, if it looks `halo` rows back at most: it is run over the
    segments with their halos, which then go."""
    made = compute(in_segments(df, by, order, halo, rows), [*by, "_segment"], "_index")
    return made.filter(~F.col("_halo")).drop("_index", "_segment", "_halo")


def numbered(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """df with each row's number, from 0, in the order of some columns that tell all rows apart: an order of outputs that
    can be checked, found without taking all rows into one task."""
    return in_segments(df, [], order, 0).withColumn(name, F.col("_index").cast("long")).drop("_index", "_segment", "_halo")
