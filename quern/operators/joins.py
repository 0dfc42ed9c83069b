"""Checks and pairings by join; keys are never collected, and small sides are broadcast by size only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

D = "decimal(38,8)"


def enrich(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Fact with a dimension's columns; Spark broadcasts the dimension if statistics show that it is small."""
    return fact.join(dim, on, how)


def left_default(df: DataFrame, sparse: DataFrame, keys: list[str], default: dict) -> DataFrame:
    return df.join(sparse, keys, "left").fillna(default)


def semi(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def fk_orphans(df: DataFrame, col: str, dim: DataFrame, pk: str) -> DataFrame:
    """(value, n) of foreign keys without a row in the dimension; NULLs are no references."""
    return df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n")).join(dim.select(F.col(pk).alias("value")), "value", "left_anti")


def attribution_mismatch(df: DataFrame, fk: str, dim: DataFrame, pk: str, col: str, dim_col: str | None = None) -> DataFrame:
    """Fact rows whose attribute differs from that of the dimension row they refer to."""
    other = dim.select(F.col(pk).alias("_pk"), F.col(dim_col or col).alias("_other"))
    return df.join(other, F.col(fk) == F.col("_pk")).filter(~F.col(col).eqNullSafe(F.col("_other"))).drop("_pk")


def unknown_codes(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """(code, n) of codes that a reference list lacks, NULL among them if there is any."""
    found = df.groupBy(F.col(col).alias("code")).agg(F.count("*").alias("n"))
    return found.join(ref.select(F.col(ref_col).alias("code")).distinct(), "code", "left_anti")


def multiset_diff(left: DataFrame, right: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that one side has more often, with side and n: compared by the columns themselves, NULLs equal."""
    cols = cols or left.columns
    both = left.select(*cols, F.lit(1).alias("_d")).unionByName(right.select(*cols, F.lit(-1).alias("_d")))
    n = both.groupBy(*cols).agg(F.sum("_d").alias("_n")).filter("_n <> 0")
    return n.select(*cols, F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), F.abs("_n").alias("n"))


def lineage_missing(published: DataFrame, upstream: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct lineage tuples that are published but not upstream."""
    return published.select(*cols).subtract(upstream.select(*cols))


def cross_equal(a: DataFrame, b: DataFrame, keys: list[str], value: str, tol: str = "0") -> DataFrame:
    """Keys that both publications have with values further apart than tol; one NULL against a number counts."""
    x, y = (df.select(*keys, F.col(value).cast(D).alias(n)) for df, n in ((a, "value_a"), (b, "value_b")))
    far = F.abs(F.col("value_a") - F.col("value_b")) > F.lit(tol).cast(D)
    return x.join(y, keys).filter(far | (F.col("value_a").isNull() != F.col("value_b").isNull()))


def parts_vs_total(df: DataFrame, keys: list[str], part: str, value: str, total_label: str, parts: list[str], half_step: str) -> DataFrame:
    """Keys with every part and the total: gap, and whether it is within rounding (half a step for each of them)."""
    is_part = F.col(part).isin(parts)
    v = F.col(value).cast(D)
    g = df.groupBy(*keys).agg(F.sum(F.when(is_part, v)).alias("parts"), F.count(F.when(is_part, v)).alias("_n"), F.max(F.when(F.col(part) == total_label, v)).alias("total"))
    gap = F.abs(F.col("parts") - F.col("total"))
    return g.filter((F.col("_n") == len(parts)) & F.col("total").isNotNull()).select(*keys, "parts", "total", gap.alias("gap"), (gap <= F.lit(half_step).cast(D) * (len(parts) + 1)).alias("ok"))


def product_identity(df: DataFrame, keys: list[str], x: str, y: str, z: str, factor: str = "1", half_step: str = "0.5") -> DataFrame:
    """Whether factor * x * y can be z, if each is known to half a step only: intervals of exact decimals."""
    lit = lambda s: F.lit(s).cast("decimal(12,6)")
    a, b, c = (F.col(n).cast("decimal(14,4)") for n in (x, y, z))
    h = lit(half_step)
    low = F.greatest(a - h, F.lit(0)) * F.greatest(b - h, F.lit(0)) * lit(factor)
    high = (a + h) * (b + h) * lit(factor)
    ok = (high >= c - h) & (low <= c + h)
    return df.filter(a.isNotNull() & b.isNotNull() & c.isNotNull()).select(*keys, F.col(x), F.col(y), F.col(z), ok.alias("ok"))


def pair_unit_value(quantity: DataFrame, value: DataFrame, keys: list[str], factor: int = 1) -> DataFrame:
    """Unit value of quantities and values that belong together, where the quantity is positive."""
    q, v = quantity.select(*keys, F.col("value").alias("quantity")), value.select(*keys, F.col("value").alias("amount"))
    return q.join(v, keys).select(*keys, "quantity", "amount", F.when((F.col("quantity") > 0) & F.col("amount").isNotNull(), (F.col("amount") * factor / F.col("quantity")).cast("double")).alias("unit_value"))


def resolve_member(dim: DataFrame, **filters):
    """The one row that fits; none or several are an error."""
    rows = dim.filter(reduce(lambda a, b: a & b, (F.col(k) == v for k, v in filters.items()))).limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"{'no' if not rows else 'more than one'} member for {filters}")
    return rows[0]


def common_periods(df: DataFrame, group: str, period: str, valid: str = "true") -> DataFrame:
    """Periods in which every group has a valid row."""
    good = df.filter(valid)
    groups = df.agg(F.count_distinct(group).alias("_all"))
    per = good.groupBy(period).agg(F.count_distinct(group).alias("_n"))
    return per.join(F.broadcast(groups), F.col("_n") == F.col("_all")).select(period)
