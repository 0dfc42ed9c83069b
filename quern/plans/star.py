"""Star schema: specs, dimensions, facts, their validation and reconciliation, and the guard on sums."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import spark_key
from quern.operators.aggregates import duplicates, label_sets
from quern.operators.match import join_back
from quern.operators.joins import attribution_mismatch, fk_orphans, multiset_diff
from quern.operators.sets import CHUNK, set_chunks

#: Which sums a metric allows. Fixed values.
ADDITIVITY = ("AREA_OR_FLOW_NONOVERLAP", "NEVER_SUM", "NO_SUM_OVER_TIME", "NO_SUM_WITH_COMPONENTS", "SIGNED_FLOW", "MY_FLOW", "TY_FLOW", "TY_SUBSET")


@dataclass(frozen=True)
class TableSpec:
    """A table: columns and types in order, primary key, unique sets, not-null columns, foreign keys {column: (table,
    key)}."""

    name: str
    columns: dict[str, str]
    pk: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    fks: dict[str, tuple[str, str]] = field(default_factory=dict)

    def project(self, df: DataFrame) -> DataFrame:
        if lacking := [c for c in self.columns if c not in df.columns]:
            raise ValueError(f"{self.name} lacks {lacking}")
        return df.select(*(F.col(c).cast(t).alias(c) for c, t in self.columns.items()))


def calendar_dims(bounds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(year, month, date) dimensions without gaps between one row of bounds (first date, last date)."""
    a, b = (F.col(c).cast("date") for c in bounds.columns[:2])
    years = bounds.select(F.explode(F.sequence(F.year(a), F.year(b))).alias("year_key"))
    m = F.col("month_start")
    months = bounds.select(F.explode(F.sequence(F.trunc(a, "year"), F.trunc(b, "month"), F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    months = months.select((F.year(m) * 100 + F.month(m)).alias("month_key"), F.year(m).alias("year_key"), F.month(m).alias("month"), F.quarter(m).alias("quarter"), "month_start")
    d = F.col("full_date")
    dates = bounds.select(F.explode(F.sequence(a, b, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    dates = dates.select((F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"), "full_date", F.year(d).alias("year_key"), (F.year(d) * 100 + F.month(d)).alias("month_key"), (F.weekday(d) + 1).alias("iso_weekday"))
    return years, months, dates


def identity_dim(parts: list[DataFrame], domain: str, natural: list[str], label: str, key: str, role: str | None = None) -> DataFrame:
    """One row per natural identity over all parts: key, identity, sorted distinct labels as JSON."""
    rows = reduce(DataFrame.unionByName, (p.select(*natural, label, *([role] if role else [])) for p in parts))
    labels = label_sets(rows, natural, label, role)
    ids = join_back(rows.select(*natural).distinct(), labels, natural, "left")
    return ids.select(spark_key(domain, *(F.col(c) for c in natural)).alias(key), *natural, F.coalesce("labels_json", F.lit("[]")).alias("labels_json"))


def identity_labels(parts: list[DataFrame], domain: str, natural: list[str], label: str, key: str, size: int = CHUNK) -> DataFrame:
    """(key, natural, chunk, n, items, digest): the labels beside a dimension whose identities may have any number of
    them; `key` is the dimension's own."""
    rows = reduce(DataFrame.unionByName, (p.select(*natural, label) for p in parts))
    return set_chunks(rows, natural, label, size).select(spark_key(domain, *(F.col(c) for c in natural)).alias(key), *natural, "chunk", "n", "items", "digest")


def technical_member(spark: SparkSession, dim: DataFrame, values: dict) -> DataFrame:
    """dim with one more row for what has no identity; columns not named are NULL."""
    row = spark.range(1).select(*(F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema))
    return dim.unionByName(row)


def metric_dim(df: DataFrame, rules: DataFrame, metric: str = "metric", unit: str = "unit") -> DataFrame:
    """Metrics in use with reviewed unit, factor and additivity (rules: metric, unit, unit_to, factor, additivity); a
    metric or unit without a rule is an error."""
    used = df.select(F.col(metric).alias("metric"), F.col(unit).alias("unit")).distinct()
    if bad := used.join(rules, ["metric", "unit"], "left_anti").limit(5).collect():
        raise ValueError(f"metrics without a reviewed rule: {[tuple(r) for r in bad]}")
    return used.join(rules, ["metric", "unit"]).select(spark_key("metric", F.col("metric"), F.col("unit")).alias("metric_key"), "metric", "unit", "unit_to", "factor", "additivity")


def series_dim(df: DataFrame, identity: list[str], attributes: list[str] = ()) -> DataFrame:
    """Distinct series with their key; attributes must follow from the identity, which fd_violations shows."""
    return df.select(*identity, *attributes).distinct().select(spark_key("series", *(F.col(c) for c in identity)).alias("series_key"), *identity, *attributes)


def build_fact(df: DataFrame, spec: TableSpec, columns: dict[str, Column]) -> DataFrame:
    return spec.project(df.select(*(c.alias(n) for n, c in columns.items())))


def validate_table(df: DataFrame, spec: TableSpec, dims: dict[str, DataFrame] | None = None, attribution: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(check, violations) for types, NOT NULL, primary key, unique sets, foreign keys and attributes that a fact
    shares with its dimension {fk: (column, dimension column)}: aggregations and anti joins, nothing collected."""
    spark = df.sparkSession
    wrong = [c for c, t in spec.columns.items() if c not in df.columns or df.schema[c].dataType.simpleString() != t]
    checks = [spark.range(1).select(F.lit("schema").alias("check"), F.lit(len(wrong) + len(set(df.columns) - set(spec.columns))).cast("long").alias("violations"))]
    needed = sorted({*spec.pk, *spec.not_null})
    row = df.agg(*(F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in needed))
    checks.append(row.unpivot([], row.columns, "check", "violations"))
    for name, cols in (("pk", spec.pk), *((f"unique:{','.join(u)}", u) for u in spec.unique)):
        checks.append(duplicates(df, list(cols)).agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations"))
    for c, (table, key) in spec.fks.items():
        dim = (dims or {})[table]
        checks.append(fk_orphans(df, c, dim, key).agg(F.count("*").alias("violations")).select(F.lit(f"fk:{c}").alias("check"), "violations"))
        if attribution and c in attribution:
            col, other = attribution[c]
            checks.append(attribution_mismatch(df, c, dim, key, col, other).agg(F.count("*").alias("violations")).select(F.lit(f"attribution:{c}").alias("check"), "violations"))
    return reduce(DataFrame.unionByName, checks)


def admit(df: DataFrame, columns: dict[str, str], keys: list[str], rules: dict[str, str]) -> DataFrame:
    """One row of violations of an input: schema, NULL keys, repeated keys, each rule; one aggregation by key, then one
    over all."""
    wrong = [c for c, t in columns.items() if c not in df.columns or df.schema[c].dataType.simpleString() != t]
    if wrong:
        raise ValueError(f"input columns differ: {wrong}")
    null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    per = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if(null).alias("_null"), *(F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(f"_r{i}") for i, p in enumerate(rules.values())))
    total = lambda c, n: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n)
    return per.agg(total("_n", "n_rows"), total("_null", "null_keys"), total(F.col("_n") - 1, "duplicate_rows"), *(total(f"_r{i}", n) for i, n in enumerate(rules)))


def reconcile(silver: DataFrame, gold: DataFrame, key: list[str]) -> DataFrame:
    """Keys, with multiplicity, that one layer has and the other lacks: to be empty."""
    return multiset_diff(silver.select(*key), gold.select(*key))


def safe_sum(fact: DataFrame, metrics: DataFrame, by: list[str], time: str, value: str = "value", metric: str = "metric", components: str | None = None) -> DataFrame:
    """Sums by `by` where each metric's rule allows it: NEVER_SUM only over single rows, NO_SUM_OVER_TIME only within one
    `time`, NO_SUM_WITH_COMPONENTS only within one metric. What would break a rule is an error when the result is used,
    never a number."""
    joined = fact.join(metrics.select("metric", "additivity"), fact[metric] == metrics["metric"]).drop(metrics["metric"]) if metric == "metric" else fact.join(metrics, metric)
    g = joined.groupBy(*by).agg(
        F.sum(value).alias("total"), F.count("*").alias("_n"), (F.min(time) != F.max(time)).alias("_times"), (F.min(metric) != F.max(metric)).alias("_metrics"),
        F.count_if(F.col("additivity") == "NEVER_SUM").alias("_never"), F.count_if(F.col("additivity") == "NO_SUM_OVER_TIME").alias("_stock"), F.count_if(F.col("additivity") == "NO_SUM_WITH_COMPONENTS").alias("_whole"),
    )
    broken = ((F.col("_never") > 0) & (F.col("_n") > 1)) | ((F.col("_stock") > 0) & F.coalesce("_times", F.lit(False))) | ((F.col("_whole") > 0) & F.coalesce("_metrics", F.lit(False)))
    where = F.concat_ws(", ", *(F.col(c).cast("string") for c in by)) if by else F.lit("all rows")
    refused = F.raise_error(F.concat(F.lit(f"additivity: no sum by {by} of "), where)).cast(g.schema["total"].dataType)
    return g.select(*by, F.when(broken, refused).otherwise(F.col("total")).alias("total"))
