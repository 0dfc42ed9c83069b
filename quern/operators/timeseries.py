"""Calendar-aware series: gaps stay gaps, nothing is filled in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.aggregates import duplicates


def _one_row_each(df: DataFrame, grain: list[str]) -> None:
    if found := duplicates(df, grain).limit(3).collect():
        raise ValueError(f"rows repeat at the grain {grain}: {[tuple(r) for r in found]}")


def calendar_yoy(df: DataFrame, group: list[str], year: str, value: str) -> DataFrame:
    """Adds previous_value and yoy_pct from exactly the year before; a repeated (group, year) is an error."""
    _one_row_each(df, [*group, year])
    before = df.select(*group, (F.col(year) + 1).alias(year), F.col(value).alias("previous_value"))
    pct = F.when(F.col("previous_value") > 0, (F.col(value).cast("double") / F.nullif(F.col("previous_value").cast("double"), F.lit(0.0)) - 1) * 100)
    return df.join(before, [*group, year], "left").withColumn("yoy_pct", pct)


def dense_calendar(df: DataFrame, by: list[str], period: str, grain: str = "month") -> DataFrame:
    """Every month (or day) between a series' first and last row, with observed_row; absent rows have NULL values.

    period is a date, the first of its month for the month grain; a repeated (by, period) is an error."""
    _one_row_each(df, [*by, period])
    step = F.expr("INTERVAL 1 MONTH" if grain == "month" else "INTERVAL 1 DAY")
    spine = df.groupBy(*by).agg(F.min(period).alias("_a"), F.max(period).alias("_b")).select(*by, F.explode(F.sequence("_a", "_b", step)).alias(period))
    return spine.join(df.withColumn("observed_row", F.lit(True)), [*by, period], "left").fillna({"observed_row": False})


def _months(period: str):
    return F.year(period) * 12 + F.month(period)


def pct_change(df: DataFrame, by: list[str], period: str, value: str) -> DataFrame:
    """Change in percent on the row before, which dense_calendar makes the month before; its value must be positive."""
    last = F.lag(F.col(value).cast("double")).over(Window.partitionBy(*by).orderBy(period))
    return df.withColumn("change_pct", F.when(last > 0, (F.col(value).cast("double") / F.nullif(last, F.lit(0.0)) - 1) * 100))


def rolling_mean(df: DataFrame, by: list[str], period: str, value: str, n: int = 12) -> DataFrame:
    """Mean of the last n periods, all of which must have numbers."""
    w = Window.partitionBy(*by).orderBy(period).rowsBetween(1 - n, 0)
    v = F.col(value).cast("double")
    return df.withColumn(f"rolling_mean_{n}", F.when(F.count(v).over(w) == n, F.avg(v).over(w)))


def log_volatility(df: DataFrame, by: list[str], period: str, value: str, n: int = 12) -> DataFrame:
    """Sample deviation of n consecutive log returns in percent: n + 1 positive numbers in a row."""
    order = Window.partitionBy(*by).orderBy(period)
    v = F.col(value).cast("double")
    log = F.when(v > 0, F.log(F.when(v > 0, v)))
    made = df.withColumn("_r", log - F.lag(log).over(order))
    w = order.rowsBetween(1 - n, 0)
    return made.withColumn(f"volatility_{n}", F.when(F.count("_r").over(w) == n, F.stddev_samp("_r").over(w) * 100)).drop("_r")


def observation_gap(df: DataFrame, by: list[str], date: str) -> DataFrame:
    """Days since the series' observation before."""
    return df.withColumn("gap_days", F.datediff(date, F.lag(date).over(Window.partitionBy(*by).orderBy(date))))


def drawdown(df: DataFrame, by: list[str], period: str, value: str) -> DataFrame:
    """(peak, peak_period, last_value, drawdown_pct): the earliest peak, and from there to the last number."""
    v = F.col(value).cast("double")
    g = df.filter(v.isNotNull()).groupBy(*by).agg(F.max(v).alias("peak"), F.max(F.struct(v.alias("v"), (-_day(period)).alias("d"), F.col(period).alias("p")))["p"].alias("peak_period"), F.max_by(v, period).alias("last_value"))
    return g.withColumn("drawdown_pct", F.when(F.col("peak") > 0, (F.col("last_value") / F.nullif(F.col("peak"), F.lit(0.0)) - 1) * 100))


def _day(period: str):
    return F.datediff(F.col(period), F.lit("1970-01-01").cast("date"))


def calendar_gaps(df: DataFrame, by: list[str], period: str) -> DataFrame:
    """(represented, span, absent) in months of each series."""
    m = _months(period)
    g = df.groupBy(*by).agg(F.count_distinct(m).alias("represented"), (F.max(m) - F.min(m) + 1).cast("long").alias("span"))
    return g.withColumn("absent", F.col("span") - F.col("represented"))


def rank_in_period(df: DataFrame, by: list[str], period: str, value: str) -> DataFrame:
    return df.withColumn("rank", F.dense_rank().over(Window.partitionBy(*by, period).orderBy(F.desc_nulls_last(value))))


def calendar_spine(spark, first: int, last: int, *marts: tuple[str, DataFrame, str]) -> DataFrame:
    """One row per year from first to last with how many rows each mart (name, frame, year column) has there."""
    out = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    for name, mart, year in marts:
        out = out.join(mart.groupBy(F.col(year).cast("int").alias("year")).agg(F.count("*").alias(f"{name}_rows")), "year", "left").fillna({f"{name}_rows": 0})
    return out
