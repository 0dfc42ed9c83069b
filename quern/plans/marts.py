"""Marts (fixed-schema extracts) and measures over them, and the checks that a mart has to pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.operators import aggregates as agg
from quern.operators import timeseries as ts
from quern.operators.reshape import row_ratio, unpivot_metrics


def fact_overview_mart(facts: dict[str, DataFrame], value: str, period: str) -> DataFrame:
    """One row per fact: coverage, numeric share in percent to 8 decimals, and the period as text."""
    rows = [agg.coverage(f, value, period).withColumn("fact", F.lit(n)) for n, f in sorted(facts.items())]
    out = reduce(DataFrame.unionByName, rows)
    pct = F.round(F.col("numeric_observations") * F.lit(100.0) / F.nullif(F.col("n_rows"), F.lit(0)), 8)
    return out.withColumns({"numeric_pct": pct, "period_text": F.concat_ws("-", F.col("first_period").cast("string"), F.col("last_period").cast("string"))})


def national_mart(df: DataFrame, keys: list[str], metric: str, value: str, names: dict[str, str]) -> DataFrame:
    """Metrics side by side with presence; two rows of one cell are an error."""
    from quern.operators.reshape import pivot_metrics

    if bad := agg.duplicates(df, [*keys, metric]).limit(3).collect():
        raise ValueError(f"rows collide at the mart's grain: {[tuple(r) for r in bad]}")
    return pivot_metrics(df, keys, metric, value, names)


def production_mart(wide: DataFrame, area: str, production: str) -> DataFrame:
    """Adds paired_area and paired_production: both numbers of the rows that count in a ratio of sums, else NULL."""
    ok = F.col(production).isNotNull() & (F.col(area) > 0)
    return wide.withColumns({"paired_area": F.when(ok, F.col(area)), "paired_production": F.when(ok, F.col(production))})


def benchmark_mart(df: DataFrame, by: list[str], month: str, value: str) -> DataFrame:
    """Every month of each series with change and 12-month volatility; months without a row are marked."""
    dense = ts.dense_calendar(df, by, month)
    return ts.log_volatility(ts.pct_change(dense, by, month, value), by, month, value)


def price_reference_mart(df: DataFrame, columns: list[str], condition: str) -> DataFrame:
    return df.filter(condition).select(*columns)


def quote_mart(df: DataFrame, by: list[str], date: str, value: str, floor: float = 0.0) -> DataFrame:
    """Quotes at or over a floor, with days since the series' quote before."""
    return ts.observation_gap(df.filter(F.col(value) >= floor), by, date)


def components_mart(wide: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    return unpivot_metrics(wide, keys, names, "component", "value")


def marketing_year_mart(fact: DataFrame, metrics: DataFrame, on: str) -> DataFrame:
    return fact.join(metrics, on)


def bilateral_trade_mart(wide: DataFrame, quantity: str, amount: str) -> DataFrame:
    """Adds the unit value and the paired numbers that a weighted unit value sums over."""
    ok = F.col(amount).isNotNull() & (F.col(quantity) > 0)
    return wide.withColumns({"unit_value": row_ratio(F.col(amount), F.col(quantity)), "paired_quantity": F.when(ok, F.col(quantity)), "paired_amount": F.when(ok, F.col(amount))})


def verify_mart(df: DataFrame, grain: list[str], presence: dict[str, str] | None = None, ratios: dict[str, tuple[str, str, int]] | None = None, dense: tuple[list[str], str] | None = None, bounds: tuple | None = None, series: dict[str, tuple[str, list[str], str, str]] | None = None, ordered: list[str] = ()) -> DataFrame:
    """(check, violations): the grain is unique; a value without a present cell; a ratio column {name: (numerator,
    denominator, factor)} that is not what its columns give; (series, month) with a month left out; bounds (period, first,
    last) that a row lies outside of, or that no row reaches; series {column: (kind, by, period, value)} of kind change,
    volatility or gap that computing anew does not confirm; ordered: two periods of a series (all but the last column)
    that number alike, so that its order is not total."""
    out = [agg.duplicates(df, grain).agg(F.count("*").alias("violations")).select(F.lit("grain").alias("check"), "violations")]
    counts = [F.count_if(F.col(v).isNotNull() & (F.col(p) == 0)).alias(f"presence:{v}") for v, p in (presence or {}).items()]
    counts += [F.count_if(~F.col(r).eqNullSafe(row_ratio(F.col(n), F.col(d), f))).alias(f"ratio:{r}") for r, (n, d, f) in (ratios or {}).items()]
    if counts:
        row = df.agg(*counts)
        out.append(row.unpivot([], row.columns, "check", "violations"))
    if dense:
        out.append(ts.calendar_gaps(df, *dense).agg(F.coalesce(F.sum("absent"), F.lit(0)).alias("violations")).select(F.lit("dense").alias("check"), "violations"))
    if bounds:
        period, first, last = bounds
        p = F.col(period)
        outside = F.count_if(~F.coalesce(p.between(first, last), F.lit(False))) + F.when(F.min(p) == F.lit(first), 0).otherwise(1) + F.when(F.max(p) == F.lit(last), 0).otherwise(1)
        out.append(df.agg(outside.cast("long").alias("violations")).select(F.lit(f"bounds:{period}").alias("check"), "violations"))
    for column, (kind, by, period, value) in (series or {}).items():
        again = {"change": ts.pct_change, "volatility": ts.log_volatility}[kind](df.withColumn("_was", F.col(column)).drop("change_pct", "volatility_12"), by, period, value) if kind != "gap" else ts.observation_gap(df.withColumn("_was", F.col(column)).drop("gap_days"), by, period)
        new = {"change": "change_pct", "volatility": "volatility_12", "gap": "gap_days"}[kind]
        close = F.col("_was").eqNullSafe(F.col(new)) | (F.abs(F.col("_was") - F.col(new)) <= 1e-9 * F.greatest(F.abs(F.col(new)), F.lit(1.0)))
        out.append(again.agg(F.count_if(~F.coalesce(close, F.lit(False))).alias("violations")).select(F.lit(f"{kind}:{column}").alias("check"), "violations"))
    if ordered:
        out.append(agg.duplicates(df, list(ordered)).agg(F.count("*").alias("violations")).select(F.lit("order").alias("check"), "violations"))
    return reduce(DataFrame.unionByName, out)


def sample_check(mart: DataFrame, fact: DataFrame, keys: list[str], value: str, fraction: float, seed: int = 7) -> DataFrame:
    """Sampled mart rows whose value the fact does not confirm: to be empty."""
    picked = mart.sample(fraction, seed).select(*keys, F.col(value).alias("_mart"))
    return picked.join(fact.select(*keys, F.col(value).alias("_fact")), keys, "left").filter("NOT _mart <=> _fact")


# measures: what a report computes in whatever context `by` spans


def weighted_ratio(mart: DataFrame, by: list[str], num: str, den: str, factor: int = 1) -> DataFrame:
    return agg.paired_ratio(mart, by, num, den, factor)


def level(mart: DataFrame, by: list[str], period: str, value: str, identity: list[str] = ()) -> DataFrame:
    return agg.period_level(mart, by, period, value, identity)


def growth(mart: DataFrame, by: list[str], period: str, value: str) -> DataFrame:
    return agg.endpoints(mart, by, period, value)


def rank_of_ratio(mart: DataFrame, group: str, num: str, den: str, factor: int = 1) -> DataFrame:
    """Groups ranked by their weighted ratio, without gaps between ranks; groups without a ratio have none."""
    r = agg.paired_ratio(mart, [group], num, den, factor).filter("ratio IS NOT NULL")
    return r.withColumn("rank", F.dense_rank().over(Window.orderBy(F.desc("ratio"))))  # one row per group, pre-aggregated


def mart_relationships(marts: dict[str, tuple[DataFrame, str]], dim: DataFrame, pk: str) -> DataFrame:
    """(mart, orphans) of many-to-one relations from marts to a dimension."""
    from quern.operators.joins import fk_orphans

    rows = [fk_orphans(df, col, dim, pk).agg(F.count("*").alias("orphans")).select(F.lit(n).alias("mart"), "orphans") for n, (df, col) in sorted(marts.items())]
    return reduce(DataFrame.unionByName, rows)
