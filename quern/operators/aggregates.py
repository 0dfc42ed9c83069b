"""Coverage, ratios, levels, endpoints, reconciliation and checksums as single grouped aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.match import join_back
from quern.operators.quantiles import exact_quantiles


def paired_ratio(df: DataFrame, by: list[str], num: str, den: str, factor: int = 1) -> DataFrame:
    """factor * sum(num) / sum(den) over the rows that have both and a positive denominator; no average of ratios."""
    ok = F.col(num).isNotNull() & (F.col(den) > 0)
    n, d = F.sum(F.when(ok, F.col(num))), F.sum(F.when(ok, F.col(den)))
    return df.groupBy(*by).agg(n.alias("num_sum"), d.alias("den_sum"), (F.lit(factor) * n / F.nullif(d, F.lit(0))).cast("double").alias("ratio"))


def period_level(df: DataFrame, by: list[str], period: str, value: str, identity: list[str] = ()) -> DataFrame:
    """The sum of a level, which is defined only for one period and one identity in scope."""
    one = F.min(period) == F.max(period)  # one distinct value, without the expansion that counting distinct ones takes
    for c in identity:
        text = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
        one = one & (F.min(text) == F.max(text))
    return df.groupBy(*by).agg(F.when(one, F.sum(value)).alias("level"))


def coverage(df: DataFrame, value: str, period: str, by: list[str] = ()) -> DataFrame:
    v = F.col(value)
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count(v).alias("numeric_observations"), F.count_if(v.isNull()).alias("missing_observations"), F.count_if(v == 0).alias("genuine_zero"),
        F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count_distinct(period).alias("represented_periods"),
    )


def period_coverage(df: DataFrame, value: str, period: str) -> DataFrame:
    return df.groupBy(period).agg(F.count("*").alias("n_rows"), F.count(value).alias("numeric_observations"), F.count_if(F.col(value).isNull()).alias("missing_observations"))


def catalogue(df: DataFrame, keys: list[str], value: str, period: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count("*").alias("observations"), F.count(value).alias("numeric_observations"))


def category_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("observations"))


def subject_products(df: DataFrame, product: str, value: str, period: str, metric: str) -> DataFrame:
    return df.groupBy(product).agg(
        F.count("*").alias("observations"), F.count(value).alias("numeric_observations"), F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.sort_array(F.collect_set(metric)).alias("metric_codes"),
    )


def reconcile_counts(**flags: Column) -> list[Column]:
    """Counts of flags for one aggregation: prepared = valid + quarantined and so on are then compared as numbers."""
    return [F.count_if(c).alias(n) for n, c in flags.items()]


def audit_table(df: DataFrame, keys: list[str], required: list[str], rules: dict[str, str]) -> DataFrame:
    """One row: rows, keys that repeat, rows with a NULL in required columns, rows that break a rule; by key first, so
    that one pass checks uniqueness and rules."""
    null = F.lit(False)
    for c in required:
        null = null | F.col(c).isNull()
    bad = F.lit(False)
    for predicate in rules.values():
        bad = bad | ~F.coalesce(F.expr(predicate), F.lit(False))
    per = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if(null).alias("_null"), F.count_if(bad).alias("_bad"))
    total = lambda c, n: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n)
    return per.agg(total("_n", "n_rows"), F.count_if(F.col("_n") > 1).alias("duplicate_keys"), total(F.col("_n") - 1, "duplicate_excess"), total("_null", "null_rows"), total("_bad", "invalid_rows"))


def fd_violations(df: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """Keys with more than one combination of attributes, NULL counting as a value: (keys, variants)."""
    return df.groupBy(*keys, *attrs).agg(F.lit(1).alias("_")).groupBy(*keys).agg(F.count("*").alias("variants")).filter("variants > 1")


def assert_fd(df: DataFrame, keys: list[str], attrs: list[str]) -> None:
    if found := fd_violations(df, keys, attrs).limit(5).collect():
        raise ValueError(f"{attrs} do not follow from {keys}: {[tuple(r) for r in found]}")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def label_sets(df: DataFrame, keys: list[str], label: str, role: str | None = None) -> DataFrame:
    """Distinct labels of each identity, sorted, as a JSON array of objects."""
    item = F.struct(*([F.col(role).alias("role")] if role else []), F.col(label).alias("label"))
    return df.filter(F.col(label).isNotNull()).groupBy(*keys).agg(F.to_json(F.sort_array(F.collect_set(item))).alias("labels_json"))


def content_checksum(df: DataFrame) -> DataFrame:
    """(n_rows, checksum) that don't hang on the order; every column is marked NULL or not, so that no shift of values
    between columns goes unseen."""
    cells = [x for c in sorted(df.columns) for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.xxhash64(*cells).cast("decimal(38,0)")), F.lit(0)).alias("checksum"))


def partition_domain(df: DataFrame, period: str, key: str, buckets: int = 4, valid: str = "true") -> DataFrame:
    """Rows and invalid rows by period and hash bucket (first byte of the key's SHA-256): together the whole table."""
    bucket = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 2), 16, 10).cast("int") % buckets
    return df.groupBy(F.col(period).alias("period"), bucket.alias("bucket")).agg(F.count("*").alias("n_rows"), F.count_if(~F.coalesce(F.expr(valid), F.lit(False))).alias("invalid"))


def file_reconcile(df: DataFrame, manifest: DataFrame, file_col: str = "_source_file") -> DataFrame:
    """Rows per source file against an independent count (file, expected); only files that differ."""
    own = df.groupBy(F.col(file_col).alias("file")).agg(F.count("*").alias("n"))
    return own.join(manifest, "file", "full_outer").filter("NOT n <=> expected")


def endpoints(df: DataFrame, by: list[str], period: str, value: str) -> DataFrame:
    """First and last number, change and yearly growth, peak at its earliest, and peak to last, in percent."""
    good = df.filter(F.col(value).isNotNull())
    p, v = F.col(period), F.col(value).cast("double")
    g = good.groupBy(*by).agg(
        F.min(p).alias("first_period"), F.max(p).alias("last_period"), F.min_by(v, p).alias("first_value"), F.max_by(v, p).alias("last_value"),
        F.count("*").alias("numeric_periods"), F.max(v).alias("peak"), F.max_by(p, F.struct(v, -p)).alias("peak_period"),
    )
    span = F.col("last_period") - F.col("first_period")
    lo, hi = F.col("first_value"), F.col("last_value")
    return g.withColumns(
        {
            "change_pct": F.when((span > 0) & (lo > 0), (hi / F.nullif(lo, F.lit(0.0)) - 1) * 100),
            "cagr_pct": F.when((span > 0) & (lo > 0) & (hi > 0), (F.pow(hi / F.nullif(lo, F.lit(0.0)), F.lit(1.0) / F.nullif(span, F.lit(0))) - 1) * 100),
            "peak_to_last_pct": F.when(F.col("peak") > 0, (hi / F.nullif(F.col("peak"), F.lit(0.0)) - 1) * 100),
        }
    )


def distinct_measures(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*(F.count_distinct(c).alias(f"distinct_{c}") for c in cols))


def latest_common_spread(df: DataFrame, series: str, a, b, period: str, value: str) -> DataFrame:
    """One row: the last period in which both series have a number, both numbers, and a minus b."""
    pick = lambda s: F.max(F.when(F.col(series) == s, F.col(value)))
    both = df.filter(F.col(series).isin(a, b)).groupBy(period).agg(pick(a).alias("value_a"), pick(b).alias("value_b")).filter("value_a IS NOT NULL AND value_b IS NOT NULL")
    last = both.agg(F.max_by(F.struct(F.col(period).alias("period"), "value_a", "value_b"), period).alias("r"))
    return last.select("r.*").withColumn("spread", F.col("value_a") - F.col("value_b"))


def index_to_base(df: DataFrame, by: list[str], period: str, value: str, base: int) -> DataFrame:
    """Values as a share of 100 of the group's value in the base period, where that is positive."""
    base_rows = df.filter(F.col(period) == base).groupBy(*by).agg(F.max(value).alias("_base"))
    ratio = F.when(F.col("_base") > 0, F.col(value).cast("double") / F.nullif(F.col("_base").cast("double"), F.lit(0.0)) * 100)
    return df.join(base_rows, by, "left").withColumn("index_100", ratio).drop("_base")


def max_share(df: DataFrame, label: str, part: str, whole: str) -> DataFrame:
    """The label with the greatest part / whole, the first by name among equals."""
    share = F.when(F.col(whole) > 0, F.col(part).cast("double") / F.nullif(F.col(whole), F.lit(0)))
    first = df.select(F.col(label).alias("label"), share.alias("share")).filter("share IS NOT NULL").orderBy(F.desc("share"), "label").limit(1)
    return first


def describe_by(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, deviation, bounds and exact quartiles of each group, of any size."""
    v = F.col(value).cast("double")
    base = df.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    out = join_back(base, exact_quantiles(df, by, value, [0.25, 0.5, 0.75]).drop("n"), by, "left")
    q = [F.col("quantiles")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))]
    return out.select(*by, "n", "mean", "std", "min", *q, "max")


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_a, column_b, corr) of all pairs, from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    row = df.agg(*(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    cells = F.array(*(F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)))
    return row.select(F.explode(cells).alias("c")).select("c.*")


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Values, NULL included, by how often they come; the n most frequent if n is given."""
    out = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(n) if n else out


def null_profile(df: DataFrame) -> DataFrame:
    """(column, n_rows, nulls, null_pct) of every column in one pass."""
    cols = df.columns
    row = df.agg(F.count("*").alias("_n"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(cols)))
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col("_n").alias("n_rows"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(cols)))
    return row.select(F.explode(cells).alias("c")).select("c.*").withColumn("null_pct", F.try_divide(F.col("nulls") * F.lit(100.0), F.col("n_rows")))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_by(df: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The k greatest rows of each group by `order` (columns whose comparison is total), without sorting whole groups."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)  # a group limit runs before the shuffle


def sample_newest(df: DataFrame, period: str, n: int = 20, ties: list[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(period), *ties).limit(n)


def exists(df: DataFrame) -> bool:
    return not df.isEmpty()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
