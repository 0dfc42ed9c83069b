"""Exact order statistics of groups of any size by distributed selection.

All groups are refined at once: rows are counted per value range, the ranges that hold a wanted rank are counted again in
finer ranges, until the rank stands alone in a range of one value. Counts combine before the shuffle, so that no task
holds a group; what goes from round to round are a few ranges per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.match import join_back
from quern.sources.store import scratch_table

#: Ranges that a range is cut into per round. Any double stands alone after the first cut and three of these.
WIDTH = 1 << 16
_OCTAVE = 16


def _first_range(v: Column) -> Column:
    """Number of a value's range, ascending with it: sixteenths of powers of two, by sign; zero, the infinities and NaN
    (after all numbers, as Spark orders it) have ranges of their own."""
    size = F.floor((F.log2(F.abs(v)) + 1075) * _OCTAVE) + 1
    return F.when(F.isnan(v), 1 << 20).when(v == float("inf"), 1 << 19).when(v == float("-inf"), -(1 << 19)).when(v == 0, 0).otherwise(F.when(v > 0, size).otherwise(-size)).cast("long")


def _picked(counts: DataFrame, cell: list[str], ranks: Column) -> DataFrame:
    """Ranges (cell, _range, _n, _low, _high) that hold a wanted rank of their cell, one row per rank: its place among
    all wanted ranks of the group (_rank) and in the range (_place, from 0). ranks: array of (rank, place)."""
    w = Window.partitionBy(*cell).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_upto", F.sum("_n").over(w)).withColumn("_from", F.col("_upto") - F.col("_n"))
    held = F.filter(ranks, lambda r: (r["place"] >= F.col("_from")) & (r["place"] < F.col("_upto")))
    return upto.withColumn("_r", F.explode(held)).withColumns({"_rank": F.col("_r.rank"), "_place": F.col("_r.place") - F.col("_from")}).drop("_r", "_upto", "_from")


def exact_quantiles(df: DataFrame, by: list[str], value: str | Column, shares: list[float]) -> DataFrame:
    """One row per group that has a number: by, n, and quantiles, an array with the linearly interpolated quantile of
    each share (0 to 1). NULL values are left out, NULL keys are groups; NaN counts as the greatest number. `by` may be
    empty. The rows are read once per round: four times, or fewer where all wanted ranks stand alone earlier."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    keys = [f"_g{i}" for i in range(len(by))]
    rows = df.select(*(F.col(f"`{b}`").alias(k) for b, k in zip(by, keys)), (v + 0.0).alias("_v")).filter("_v IS NOT NULL")
    counted = [F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]

    first = rows.groupBy(*keys, _first_range(F.col("_v")).alias("_range")).agg(*counted)
    total = first.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    at = [F.lit(float(s)) * (F.col("_total") - 1) for s in shares]
    wanted = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(p), F.ceil(p)) for p in at))))
    first = join_back(first, total, keys)
    ranks = F.transform(wanted, lambda k: F.struct(k.alias("rank"), k.alias("place")))
    picks = _picked(first, keys, ranks).select(*keys, "_total", "_n", "_rank", "_place", "_low", "_high")
    found = []
    for round_ in range(4):
        picks = scratch_table(picks, "ranges")
        alone = F.col("_low").eqNullSafe(F.col("_high"))
        found.append(picks.filter(alone).select(*keys, "_total", "_rank", F.col("_low").alias("_value")))
        cells = picks.filter(~alone).groupBy(*keys, "_total", "_low", "_high").agg(F.collect_list(F.struct(F.col("_rank").alias("rank"), F.col("_place").alias("place"))).alias("_ranks"))
        if round_ == 3 or cells.isEmpty():
            break
        # a group has two ranges per share at most, so the join multiplies no row; the ranges of a group are apart
        cells = cells.select(*(F.col(k).alias(f"c{k}") for k in keys), F.col("_total"), F.col("_low").alias("_a"), F.col("_high").alias("_b"), "_ranks")
        on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"c{k}")) for k in keys), F.col("_v").between(F.col("_a"), F.col("_b")))
        # the last round takes value by value what three cuts have left together: neighbouring doubles
        part = F.floor((F.col("_v") - F.col("_a")) / (F.col("_b") - F.col("_a")) * (WIDTH - 1)) if round_ < 2 else F.col("_v")
        inner = rows.join(cells, on)
        finer = inner.groupBy(*keys, "_total", "_a", "_b", "_ranks", part.alias("_range")).agg(*counted)
        picks = _picked(finer, [*keys, "_a", "_b"], F.col("_ranks")).select(*keys, "_total", "_n", "_rank", "_place", "_low", "_high")
    values = reduce(DataFrame.unionByName, found).groupBy(*keys, "_total").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))

    def quantile(p: Column) -> Column:
        low, high, part = F.col("_at")[F.floor(p)], F.col("_at")[F.ceil(p)], p - F.floor(p)
        return F.when(part == 0, low).otherwise((1 - part) * low + part * high)

    return values.select(*(F.col(k).alias(b) for k, b in zip(keys, by)), F.col("_total").alias("n"), F.array(*map(quantile, at)).alias("quantiles"))
