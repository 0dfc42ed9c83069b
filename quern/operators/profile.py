"""Data profiling: each profile is one or two passes over the table, whatever the number of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.aggregates import duplicates
from quern.operators.match import join_back
from quern.operators.quantiles import exact_quantiles
from quern.operators.sets import CHUNK, set_chunks
from quern.sources.store import scratch_table

NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _cells(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols))).alias("c")).select("c.*")


def schema_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: nulls, numbers, other text, distinct values, numbers with leading zeros, replacement characters."""
    v = F.col("value")
    number = v.rlike(NUMBER)
    return _cells(df, cols or df.columns).groupBy("column").agg(
        F.count("*").alias("n_rows"), F.count_if(v.isNull()).alias("nulls"), F.count_if(number).alias("numeric"), F.count_if(~number).alias("non_numeric"),
        F.count_distinct(v).alias("distinct_values"), F.count_if(v.rlike("^0[0-9]+$")).alias("leading_zeros"), F.count_if(v.contains("�")).alias("encoding_suspects"),
    ).withColumn("inferred", F.when(F.col("numeric") + F.col("non_numeric") == 0, "empty").when(F.col("non_numeric") == 0, "numeric").otherwise("text"))


def header_problems(columns: list[str]) -> list[tuple[str, str]]:
    """(column, problem) of names that are blank, padded, repeated or made up by a reader."""
    out = [(c, "blank") for c in columns if not c.strip()]
    out += [(c, "padded") for c in columns if c.strip() and c != c.strip()]
    out += [(c, "repeated") for c in sorted({c for c in columns if columns.count(c) > 1})]
    return out + [(c, "generated") for c in columns if c.startswith(("_c", "Unnamed"))]


def missing_profile(df: DataFrame, cols: list[str], tokens: tuple[str, ...] = (), by: list[str] = ()) -> DataFrame:
    """Per column (and group): NULL, empty, white space, marker tokens, zeros."""
    v, t = F.col("value"), F.trim("value")
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols))).alias("c")
    token = F.lower(t).isin([x.lower() for x in tokens]) if tokens else F.lit(False)
    return df.select(*by, cells).select(*by, "c.*").groupBy(*by, "column").agg(
        F.count_if(v.isNull()).alias("nulls"), F.count_if(v == "").alias("empty"), F.count_if((v != "") & (t == "")).alias("whitespace"), F.count_if(token).alias("markers"), F.count_if(v.try_cast("double") == 0).alias("zeros"),
    )


def token_profile(df: DataFrame, cols: list[str], tokens: tuple[str, ...], by: list[str] = ()) -> DataFrame:
    """(group, column, token, n): how often each column is one of the tokens that stand for a missing value, in any case and
    with white space around; tokens that don't occur have no row."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lower(F.trim(F.col(c).cast("string"))).alias("token")) for c in cols))).alias("c")
    found = df.select(*by, cells).select(*by, "c.*").filter(F.col("token").isin([t.lower() for t in tokens]))
    return found.groupBy(*by, "column", "token").agg(F.count("*").alias("n"))


def duplicate_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: rows beyond the first of their kind, and rows that have a twin."""
    g = duplicates(df, cols or df.columns)
    zero = F.lit(0).cast("long")
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), zero).alias("excess"), F.coalesce(F.sum("n"), zero).alias("participants"))


def key_profile(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row: rows with a NULL in the key, rows beyond the first of their key, keys with several values, and with
    several rows."""
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    g = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"))  # a count of different values would hold a row for each
    zero = F.lit(0).cast("long")
    return g.agg(F.coalesce(F.sum(F.when(missing, F.col("_n"))), zero).alias("missing_keys"), F.coalesce(F.sum(F.col("_n") - 1), zero).alias("duplicate_excess"), F.count_if(F.col("_n") > 1).alias("duplicate_keys"), F.count_if(F.col("_low") != F.col("_high")).alias("value_conflicts"))


def numeric_profile(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Per group: parse failures, negatives, numbers, quartiles, and outliers beyond 1.5 spreads of them, for groups of
    at least 8 numbers with a positive spread."""
    v = F.col(value).try_cast("double")
    q = df.groupBy(*by).agg(F.count(v).alias("n"), F.count_if(F.col(value).isNotNull() & v.isNull()).alias("parse_failures"), F.count_if(v < 0).alias("negatives"))
    quartiles = exact_quantiles(df, by, v, [0.25, 0.75]).select(*by, F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("q3"))
    q = scratch_table(join_back(q, quartiles, by, "left"), "quartiles")
    spread = F.col("q3") - F.col("q1")
    out = (v < F.col("q1") - 1.5 * spread) | (v > F.col("q3") + 1.5 * spread)
    flagged = join_back(df, q, by).filter((F.col("n") >= 8) & (spread > 0) & out).groupBy(*by).agg(F.count("*").alias("outliers"))
    return join_back(q, flagged, by, "left").select(*by, "n", "parse_failures", "negatives", "q1", "q3", F.coalesce("outliers", F.lit(0)).alias("outliers"))


def precision_histogram(df: DataFrame, value: str) -> DataFrame:
    """(decimals, n) of numbers as text."""
    t = F.trim(F.col(value).cast("string"))
    return df.filter(t.rlike(r"^-?[0-9]+(\.[0-9]+)?$")).groupBy(F.length(F.regexp_extract(t, r"\.([0-9]+)$", 1)).alias("decimals")).agg(F.count("*").alias("n"))


def period_profile(df: DataFrame, period: str, low: int, high: int) -> DataFrame:
    """One row: periods that are no numbers or out of range, first, last, represented, and years without a row."""
    p = F.col(period).try_cast("int")
    ok = p.between(low, high)
    good = F.when(ok, p)
    row = df.agg(F.count_if(~F.coalesce(ok, F.lit(False))).alias("invalid"), F.min(good).alias("first"), F.max(good).alias("last"), F.count_distinct(good).alias("represented"))
    return row.withColumn("absent", (F.col("last") - F.col("first") + 1 - F.col("represented")).cast("long"))


def missing_months(df: DataFrame, by: list[str], date: str) -> DataFrame:
    """(group, month) of the months without a row between a group's first and last; a group's months are made from its two
    bounds, not from its rows."""
    month = F.trunc(date, "month")
    seen = df.filter(F.col(date).isNotNull()).select(*by, month.alias("month")).distinct()
    spine = seen.groupBy(*by).agg(F.min("month").alias("a"), F.max("month").alias("b")).select(*by, F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return spine.join(seen, [*by, "month"], "left_anti")


def pattern_violations(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(column, violations) of identifiers that don't fit their pattern."""
    row = df.agg(*(F.count_if(F.col(c).isNotNull() & ~F.col(c).cast("string").rlike(p)).alias(c) for c, p in patterns.items()))
    return row.unpivot([], list(patterns), "column", "violations")


def layout_groups(headers: DataFrame, file: str, columns: str) -> DataFrame:
    """Files with the same header (array of names): (fingerprint, files, columns)."""
    key = F.sha2(F.to_json(columns), 256)
    return headers.groupBy(key.alias("fingerprint")).agg(F.sort_array(F.collect_set(file)).alias("files"), F.first(columns).alias("columns"))


def layout_chunks(headers: DataFrame, file: str, columns: str, size: int = CHUNK) -> DataFrame:
    """(fingerprint, chunk, n, items, digest): the same for layouts that any number of files have, their names in chunks."""
    return set_chunks(headers.withColumn("_fingerprint", F.sha2(F.to_json(columns), 256)), ["_fingerprint"], file, size).withColumnRenamed("_fingerprint", "fingerprint")


def issue(df: DataFrame, dataset: str, field: str, name: str, example: str, handling: str) -> DataFrame:
    """One ledger row for the rows of df, or none if it has none: count, and the least and the greatest example."""
    e = F.col(example).cast("string")
    row = df.agg(F.count("*").alias("n"), F.min(e).alias("first_example"), F.max(e).alias("last_example"))
    return row.filter("n > 0").select(F.lit(dataset).alias("dataset"), F.lit(field).alias("field"), F.lit(name).alias("issue"), "n", "first_example", "last_example", F.lit(handling).alias("handling"))


def issue_ledger(*issues: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, issues)


def metric_sanity(df: DataFrame, metric: str, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    base = df.groupBy(metric).agg(F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.count_if(v == 0).alias("zeros"), F.count_if(v < 0).alias("negatives"))
    out = join_back(base, exact_quantiles(df, [metric], value, [0.5]).drop("n"), [metric], "left")
    return out.select(metric, "n", "min", "max", "mean", F.col("quantiles")[0].alias("median"), "zeros", "negatives")


def flag_shares(df: DataFrame, by: list[str], flag: str, value: str) -> DataFrame:
    """Rows and signed sums per flag."""
    v = F.col(value)
    return df.groupBy(*by, flag).agg(F.count("*").alias("n"), F.sum(F.when(v >= 0, v)).alias("positive_sum"), F.sum(F.when(v < 0, v)).alias("negative_sum"))
