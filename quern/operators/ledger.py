"""Cross-source checks and their ledger: every relation between sources gives one row with its status, how many pairs of
observations it matched, how many lie outside their precision, by how much at most, and where the comparison ends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import intervals

STATUSES = ("DIAGNOSTIC", "VERIFIED_ENCODING", "PENDING_UNIT_REVIEW", "PENDING_PERIOD_REVIEW", "INCOMPATIBLE")


def _entry(name: str, matched: DataFrame, repeated: DataFrame, one: Column, two: Column, status: str, limits: str) -> DataFrame:
    """matched: pairs of observations; repeated: one row with the number of keys that are not unique (_bad)."""
    if status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}")
    # plain columns, which are computed once however often they are used; a filter of them would be computed below them,
    # with all that they are made of anew for each of its parts
    both = matched.select(one["low"].alias("a0"), one["high"].alias("a1"), two["low"].alias("b0"), two["high"].alias("b1"))
    a, b = ({"low": F.col(f"{c}0"), "high": F.col(f"{c}1")} for c in "ab")
    known = F.col("a0").isNotNull() & F.col("b0").isNotNull()
    row = both.agg(F.count_if(known).alias("n"), F.count_if(known & ~intervals.meets(a, b)).alias("out"), F.max(F.when(known, intervals.distance(a, b))).alias("far")).join(repeated, F.lit(True))  # one row each
    bad = F.col("_bad") > 0
    return row.select(
        F.lit(name).alias("relation"), F.when(bad, "INCOMPATIBLE").otherwise(status).alias("status"), F.when(bad, 0).otherwise(F.col("n")).cast("long").alias("matched"), F.when(~bad, F.col("out")).alias("outside"),
        F.when(~bad, F.col("far")).alias("max_distance"), F.when(bad, F.concat(F.col("_bad").cast("string"), F.lit(" keys are not unique; none was selected"))).otherwise(F.lit(limits)).alias("limits"),
    )


def _repeated(*sides: tuple[DataFrame, list[str]]) -> DataFrame:
    counts = [df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("_bad")) for df, keys in sides]
    return reduce(DataFrame.unionByName, counts).agg(F.sum("_bad").alias("_bad"))


def equal_values(name: str, left: DataFrame, right: DataFrame, keys: list[str], value: str, status: str = "DIAGNOSTIC", limits: str = "") -> DataFrame:
    """Whether two sources give the same numbers for the keys that both have, up to the digits in which they are
    written. A key that a source repeats makes the relation incompatible."""
    one, two = left.select(*keys, F.col(value).alias("_left")), right.select(*keys, F.col(value).alias("_right"))
    return _entry(name, one.join(two, keys), _repeated((left, keys), (right, keys)), intervals.interval(F.col("_left")), intervals.interval(F.col("_right")), status, limits)


def product_identity(name: str, df: DataFrame, keys: list[str], factors: tuple[str, str], product: str, scale: float = 1.0, status: str = "DIAGNOSTIC", limits: str = "") -> DataFrame:
    """Whether product = scale * factor * factor can hold for the numbers as they are written, row by row."""
    made = intervals.scaled(intervals.times(*(intervals.interval(F.col(c)) for c in factors)), scale)
    return _entry(name, df, _repeated((df, keys)), made, intervals.interval(F.col(product)), status, limits)


def parts_and_total(name: str, parts: DataFrame, totals: DataFrame, keys: list[str], value: str, n_parts: int, status: str = "DIAGNOSTIC", limits: str = "") -> DataFrame:
    """Whether totals are the sums of their parts, where all n_parts of them are numbers."""
    one = parts.withColumn("_v", intervals.interval(F.col(value))).groupBy(*keys).agg(F.count("_v.low").alias("_n"), intervals.total(F.col("_v")).alias("_parts")).filter(F.col("_n") == n_parts)
    two = totals.select(*keys, intervals.interval(F.col(value)).alias("_total"))
    return _entry(name, one.join(two, keys), _repeated((totals, keys)), F.col("_parts"), F.col("_total"), status, limits)


def not_comparable(spark, name: str, limits: str, status: str = "INCOMPATIBLE") -> DataFrame:
    """A relation that nobody may compute yet, for the record."""
    return spark.range(1).select(F.lit(name).alias("relation"), F.lit(status).alias("status"), F.lit(0).cast("long").alias("matched"), F.lit(None).cast("long").alias("outside"), F.lit(None).cast("double").alias("max_distance"), F.lit(limits).alias("limits"))


def cross_source_ledger(*relations: DataFrame) -> DataFrame:
    """(relation, status, matched, outside, max_distance, limits, finding) of all relations."""
    finding = F.when(F.col("outside").isNull(), "not compared").when(F.col("matched") == 0, "nothing matched").when(F.col("outside") == 0, "agrees within its digits").otherwise("differs beyond its digits")
    return reduce(DataFrame.unionByName, relations).withColumn("finding", finding)
