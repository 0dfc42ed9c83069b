"""Rule engine, quarantine, conflicts. A rule that is UNKNOWN for a row fails."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.match import join_back
from quern.plans.contract import ERROR, Rule

DEAD_LETTER = "id string, dataset string, run_id string, detected_at timestamp, key_hash string, errors array<struct<rule_id:string,error_message:string,failed_column:string>>, payload string"


def _failed(rules: Iterable[Rule]) -> Column:
    made = [F.when(~F.coalesce(F.expr(r.predicate), F.lit(False)), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.message or r.rule_id).alias("error_message"), F.lit(r.column).alias("failed_column"))) for r in rules]
    return F.filter(F.array(*made), lambda e: e.isNotNull()).cast(ERROR) if made else F.array().cast(ERROR)


def evaluate(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Adds dq_errors (rules that quarantine, and cast errors if df has them) and _dq_warnings (rules that only log)."""
    rules = list(rules)
    errors = _failed(r for r in rules if r.action == "QUARANTINE")
    if "_cast_errors" in df.columns:
        errors = F.concat(F.col("_cast_errors"), errors)
    return df.withColumns({"dq_errors": errors, "_dq_warnings": _failed(r for r in rules if r.action == "LOG")})


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): rows without and with blocking errors."""
    judged = evaluate(df, rules)
    return judged.filter(F.size("dq_errors") == 0), judged.filter(F.size("dq_errors") > 0)


def rule_counts(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row of violations per rule, in one pass, however many rules there are."""
    rules = list(rules)
    counts = df.agg(*(F.count_if(~F.coalesce(F.expr(r.predicate), F.lit(False))).alias(r.rule_id) for r in rules))
    return counts.unpivot([], [r.rule_id for r in rules], "rule_id", "violations")


def published_counts(df: DataFrame, value: str, rules: Iterable[Rule] = (), release: str | None = None) -> DataFrame:
    """Counts of a published table by release (if it has such a column): rows, missing values, zeros, and violations of
    each rule; one pass."""
    v = F.col(value)
    bad = [F.count_if(~F.coalesce(F.expr(r.predicate), F.lit(False))).alias(r.rule_id) for r in rules]
    return df.groupBy(*([release] if release else [])).agg(F.count("*").alias("n_rows"), F.count_if(v.isNull()).alias("missing_values"), F.count_if(v == 0).alias("zeros"), *bad)


def key_hash(keys: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*(F.col(k).cast("string").alias(k) for k in keys)), {"ignoreNullFields": "false"}), 256)


def route_quarantine(df: DataFrame, dataset: str, run_id: str, keys: list[str], payload: list[str], at: Column | None = None) -> DataFrame:
    """Dead letters of rows with dq_errors: the id is the hash of dataset and payload, so a replay gives the same rows."""
    body = F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in sorted(payload))), {"ignoreNullFields": "false"})
    made = df.filter(F.size("dq_errors") > 0).select(
        F.sha2(F.concat_ws("\x1f", F.lit(dataset), body), 256).alias("id"), F.lit(dataset).alias("dataset"), F.lit(run_id).alias("run_id"), (at if at is not None else F.current_timestamp()).alias("detected_at"),
        key_hash(keys).alias("key_hash"), F.col("dq_errors").alias("errors"), body.alias("payload"),
    )
    return made.groupBy("id").agg(*(F.min(c).alias(c) for c in made.columns[1:]))


def merge_quarantine(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert of dead letters: a known id keeps its run and time of detection and takes the new errors."""
    t, i = target.alias("t"), incoming.alias("i")
    keep = ("run_id", "detected_at")
    cols = [F.coalesce(*(F.col(f"{s}.{c}") for s in (("t", "i") if c in keep else ("i", "t")))).alias(c) for c in incoming.columns]
    return t.join(i, F.col("t.id") == F.col("i.id"), "full_outer").select(*cols)


def quarantine_mismatch(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Ids that stand for different payloads: to be empty."""
    return target.select("id", "payload").join(incoming.select("id", F.col("payload").alias("new_payload")), "id").filter("NOT payload <=> new_payload")


def structural_rows(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(data, structural): rows whose columns are all NULL, blank or NUL characters go apart."""
    blank = reduce(lambda a, b: a & b, (F.trim(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "\u0000", "")) == "" for c in cols))
    return df.filter(~blank), df.filter(blank)


def flag_conflicts(df: DataFrame, keys: list[str], value: str, eligible: str = "true") -> DataFrame:
    """Adds conflict: the key has more than one distinct value among eligible rows, so every variant is suspect.

    Counted with partial aggregation and joined back, so that a hot key is not sorted in one task."""
    found = df.filter(eligible).groupBy(*keys).agg(F.countDistinct(value).alias("_n")).filter("_n > 1")
    return join_back(df, found, keys, "left").withColumn("conflict", F.col("_n").isNotNull()).drop("_n")


def assert_no_conflicts(df: DataFrame, keys: list[str], cols: list[str], examples: int = 20) -> None:
    """Raises if a key comes with different values of cols, naming a few."""
    found = df.groupBy(*keys).agg(F.countDistinct(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})).alias("n")).filter("n > 1").limit(examples).collect()
    if found:
        raise ValueError(f"conflicting variants of {keys}: {[tuple(r) for r in found]}")


def bounded(df: DataFrame, n: int) -> DataFrame:
    """df if it has at most n rows; more are an error, never a silent cut."""
    if df.limit(n + 1).count() > n:
        raise ValueError(f"the result has over {n} rows")
    return df


def check_calendar(dim: DataFrame, date: str = "date_key") -> DataFrame:
    """Rows of a date dimension whose parts don't follow from the key: to be empty. Year, month and weekday are to be
    there; quarter, month_start and is_leap_year are checked if they are."""
    d = F.to_date(F.col(date).cast("string"), "yyyyMMdd")
    year = F.year(d)
    parts = {"year_key": year, "month_key": year * 100 + F.month(d), "iso_weekday": F.weekday(d) + 1}
    more = {"quarter": F.quarter(d), "month_start": F.trunc(d, "month"), "is_leap_year": (year % 4 == 0) & (year % 100 != 0) | (year % 400 == 0)}
    parts |= {c: v for c, v in more.items() if c in dim.columns}
    right = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(v) for c, v in parts.items()))
    return dim.filter(d.isNull() | ~right)


def validate_params(params: dict, allowed: dict[str, tuple]) -> dict:
    """Parameters of a query template: only those allowed, of the type, within the range (type, least, most)."""
    if unknown := sorted(set(params) - set(allowed)):
        raise ValueError(f"unknown parameters: {unknown}")
    for name, value in params.items():
        kind, least, most = (*allowed[name], None, None)[:3]
        for v in value if isinstance(value, (list, tuple)) else [value]:
            if type(v) is not kind or least is not None and v < least or most is not None and v > most:
                raise ValueError(f"{name}={v!r} is not allowed")
    return params


def param_filter(params: dict, columns: dict[str, tuple[str, str]]) -> Column:
    """Predicate of parameters by {name: (column, operator)}; values become literals, lists an IN."""
    out = F.lit(True)
    for name, value in params.items():
        column, op = columns[name]
        c = F.col(column)
        out = out & (c.isin(list(value)) if isinstance(value, (list, tuple)) else {"=": c == value, ">=": c >= value, "<=": c <= value}[op])
    return out
