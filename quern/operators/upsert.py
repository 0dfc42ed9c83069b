"""Deterministic survivors and freshness-aware upserts, as joins over any file format."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _falling(df: DataFrame, c: str) -> Column | None:
    """A column whose ascending order is c's descending order with NULLs last; None for types that have none."""
    kind, x = df.schema[c].dataType.typeName(), F.col(f"`{c}`")
    if kind in ("byte", "short", "integer", "long"):
        turned = F.bitwise_not(x.cast("long"))  # unlike the minus sign, defined for the least long too
    elif kind == "date":
        turned = F.bitwise_not(F.unix_date(x).cast("long"))
    elif kind in ("timestamp", "timestamp_ntz"):
        turned = F.bitwise_not(F.unix_micros(x.cast("timestamp")))
    elif kind == "decimal":
        turned = -x
    elif kind in ("double", "float"):
        turned = F.struct(~F.isnan(x), -x)
    elif kind == "boolean":
        turned = ~x
    else:
        return None
    return F.struct(x.isNull(), turned)


def deduplicate(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the most recent by `order` (descending, NULLs last), ties by all other columns ascending with
    NULLs first; nested columns count as JSON. One aggregation of the least row in that order over one read of df, so
    that a hot key is reduced before the shuffle rather than sorted in one task (Spark sorts each task's rows by key to
    aggregate structs); only text as `order` needs a window. An empty table gives an empty result."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    nested = lambda c: df.schema[c].dataType.typeName() in ("struct", "array", "map")
    if any(_falling(df, c) is None for c in order):
        return deduplicate_by_window(df, keys, order)
    plain = [F.to_json(f"`{c}`") if nested(c) else F.col(f"`{c}`") for c in rest]
    place = F.struct(*(_falling(df, c) for c in order), *(F.struct(c.isNotNull(), c) for c in plain), F.lit(0))
    by = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
    least = df.groupBy(*by).agg(F.min_by(F.struct(*(f"`{c}`" for c in df.columns)), place).alias("_row"))
    return least.filter("_row is not null").select("_row.*")


def deduplicate_in_phases(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same without a sort of the whole table: for stored tables, above all those with many rows a key.

    A hash aggregation of keys and the first order column says how recent each key's latest row is; a join by both takes
    the latest rows out, so that a hot key's rows are spread by their recency, and only those of keys with several rows
    are reduced by `deduplicate`. df is read three times, so an input that is costly or not deterministic is to be
    written first, and a pass over computed rows is better left to `deduplicate`."""
    if not order or any(_falling(df, c) is None for c in order):
        return deduplicate(df, keys, order)
    free = "_" * (1 + max(len(c) for c in df.columns))  # longer than any name of df
    by = [F.col(f"`{k}`").alias(f"{free}k{i}") for i, k in enumerate(keys)]
    latest = df.groupBy(*by).agg(F.max(f"`{order[0]}`").alias(f"{free}latest"), F.count("*").alias(f"{free}rows"))
    pairs = [(k, f"{free}k{i}") for i, k in enumerate(keys)] + [(order[0], f"{free}latest")]
    same = reduce(lambda a, b: a & b, (F.col(f"`{a}`").eqNullSafe(F.col(b)) for a, b in pairs))
    alone = df.join(latest.filter(F.col(f"{free}rows") == 1), same, "left_semi")
    return alone.unionByName(deduplicate(df.join(latest.filter(F.col(f"{free}rows") > 1), same, "left_semi"), keys, order))


def deduplicate_by_window(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same by row_number: for keys that are known to have few rows each."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    nested = lambda c: df.schema[c].dataType.typeName() in ("struct", "array", "map")
    plain = [F.to_json(c) if nested(c) else F.col(f"`{c}`") for c in rest]
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order), *(c.asc_nulls_first() for c in plain))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], ts: str, ignore: tuple[str, ...] = ("_processed_at",)) -> DataFrame:
    """Target after the upsert: a matched row is replaced if the incoming one is as fresh or fresher and differs in any
    column (null-safe, `ignore` aside); unmatched incoming rows are added; columns that only the target has keep their
    values. Keys with NULL parts match nothing, so required-key rules come first. incoming has one row per key."""
    i = incoming.select(*(F.col(f"`{c}`").alias(f"i_{c}") for c in incoming.columns), F.lit(True).alias("i_there"))
    t = target.withColumn("t_there", F.lit(True))
    on = reduce(lambda a, b: a & b, (F.col(f"`{k}`") == F.col(f"i_{k}") for k in keys))
    compared = [c for c in incoming.columns if c in target.columns and c not in keys and c not in ignore]
    differs = reduce(lambda a, b: a | b, (~F.col(f"`{c}`").eqNullSafe(F.col(f"i_{c}")) for c in compared), F.lit(False))
    fresh = F.coalesce(F.col(f"i_{ts}") >= F.col(ts), F.col(ts).isNull())
    take = F.col("i_there").isNotNull() & (F.col("t_there").isNull() | fresh & differs)
    cols = [F.when(take, F.col(f"i_{c}")).otherwise(F.col(f"`{c}`")).alias(c) if c in incoming.columns else F.col(f"`{c}`") for c in target.columns]
    cols += [F.when(take, F.col(f"i_{c}")).alias(c) for c in incoming.columns if c not in target.columns]
    return t.join(i, on, "full_outer").select(*cols)


def judged(target: DataFrame, incoming: DataFrame, keys: list[str], ts: str, ignore: tuple[str, ...] = ("_processed_at",)) -> DataFrame:
    """Incoming rows with what an upsert would do: _take, whether it would write the row, and _part, the matched row's
    part (NULL for a new key), if the target has that column."""
    compared = [c for c in incoming.columns if c in target.columns and c not in keys and c not in ignore]
    t = target.select(*(F.col(f"`{c}`").alias(f"t_{c}") for c in dict.fromkeys([*keys, *compared, ts])), *([F.col("_part")] if "_part" in target.columns else [F.lit("").alias("_part")]))
    on = reduce(lambda a, b: a & b, (F.col(f"`{k}`") == F.col(f"t_{k}") for k in keys))
    differs = reduce(lambda a, b: a | b, (~F.col(f"`{c}`").eqNullSafe(F.col(f"t_{c}")) for c in compared), F.lit(False))
    fresh = F.coalesce(F.col(f"`{ts}`") >= F.col(f"t_{ts}"), F.col(f"t_{ts}").isNull())
    take = F.col("_part").isNull() | fresh & differs
    return incoming.join(t, on, "left").select(*(F.col(f"`{c}`") for c in incoming.columns), F.coalesce(take, F.lit(False)).alias("_take"), "_part")


def changes(target: DataFrame, incoming: DataFrame, keys: list[str], ts: str, ignore: tuple[str, ...] = ("_processed_at",)) -> DataFrame:
    """Incoming rows that an upsert would write: empty means that no version need be made."""
    return judged(target, incoming, keys, ts, ignore).filter("_take").drop("_take", "_part")
