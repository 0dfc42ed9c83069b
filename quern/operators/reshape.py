"""Between wide and long, keeping absent cells, present NULLs and zeros apart."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_metrics(df: DataFrame, keys: list[str], metric: str, value: str, names: dict[str, str]) -> DataFrame:
    """One row per key: for each metric code its value (the greatest, should it repeat) and present_<code>, how many
    rows the code has, so that a present NULL is not an absent row. One grouped aggregation."""
    cols = []
    for code, name in names.items():
        is_it = F.col(metric) == code
        cols += [F.max(F.when(is_it, F.col(value))).alias(name), F.count_if(is_it).alias(f"present_{code}")]
    return df.groupBy(*keys).agg(*cols)


def unpivot_metrics(wide: DataFrame, keys: list[str], names: dict[str, str], metric: str = "metric", value: str = "value") -> DataFrame:
    """The cells that are present, in one pass over the wide table."""
    cells = F.array(*(F.struct(F.lit(code).alias(metric), F.col(name).alias(value), F.col(f"present_{code}").alias("_n")) for code, name in names.items()))
    return wide.select(*keys, F.explode(F.filter(cells, lambda c: c["_n"] > 0)).alias("_c")).select(*keys, f"_c.{metric}", f"_c.{value}")


def pivot_mismatch(wide: DataFrame, source: DataFrame, keys: list[str], metric: str, value: str, names: dict[str, str]) -> DataFrame:
    """Cells that the pivot and its source do not share, with how often each has them: to be empty."""
    a = unpivot_metrics(wide, keys, names, metric, value).withColumn("_d", F.lit(1))
    b = source.filter(F.col(metric).isin(list(names))).select(*keys, metric, value).withColumn("_d", F.lit(-1))
    cols = [*keys, metric, value]
    both = a.unionByName(b).groupBy(*cols).agg(F.count_if(F.col("_d") == 1).alias("in_pivot"), F.count_if(F.col("_d") == -1).alias("in_source"))
    return both.filter("in_pivot <> in_source")


def unpivot_periods(df: DataFrame, pattern: str = r"^col_([0-9]{4})_([0-9]{4})$", period: str = "market_year", value: str = "value") -> DataFrame:
    """Columns whose names hold two consecutive years become rows: period (the first), crop_year, value as text."""
    found = [(c, m) for c in df.columns if (m := re.match(pattern, c))]
    if wrong := [c for c, m in found if int(m[2]) != int(m[1]) + 1]:
        raise ValueError(f"period columns are not consecutive years: {wrong}")
    if not found:
        raise ValueError("there are no period columns")
    rest = [c for c in df.columns if c not in {c for c, _ in found}]
    cells = F.array(*(F.struct(F.lit(int(m[1])).alias(period), F.lit(f"{m[1]}/{m[2]}").alias("crop_year"), F.col(c).cast("string").alias(value)) for c, m in found))
    return df.select(*rest, F.explode(cells).alias("_c")).select(*rest, "_c.*")


def unpivot_series(df: DataFrame, period: str, units: dict[str, str], synthetic: str = r"^commodity_[0-9]+") -> DataFrame:
    """Columns <name>_<unit suffix> become rows (period, commodity, unit, value as text). Columns of made-up names are
    dropped only if they hold nothing but NULLs, which one aggregation shows; otherwise they are an error."""
    cols = [c for c in df.columns if c != period]
    made_up = [c for c in cols if re.match(synthetic, c)]
    if made_up:
        filled = df.agg(*(F.count(F.col(c)).alias(c) for c in made_up)).first()
        if bad := [c for c in made_up if filled[c]]:
            raise ValueError(f"columns without a name hold values: {bad}")
    cells = []
    for c in (c for c in cols if c not in made_up):
        suffix = next((u for u in sorted(units, key=len, reverse=True) if c.endswith(f"_{u}")), None)
        if suffix is None:
            raise ValueError(f"column {c} has no known unit")
        cells.append(F.struct(F.lit(c[: -len(suffix) - 1]).alias("commodity"), F.lit(units[suffix]).alias("unit"), F.col(c).cast("string").alias("value")))
    return df.select(period, F.explode(F.array(*cells)).alias("_c")).select(period, "_c.*")


def unpivot_layouts(df: DataFrame, file_col: str, layouts: list[dict]) -> DataFrame:
    """Files of different layouts as one long table. A layout: {files: {file: {attribute: text}}, keys: [...], values:
    {column: label}}; the attributes of a file come from the small table of its layout by a join."""
    parts = []
    for layout in layouts:
        rows = [(name, *(str(v) for _, v in sorted(attrs.items()))) for name, attrs in layout["files"].items()]
        names = sorted(next(iter(layout["files"].values())))
        files = df.sparkSession.createDataFrame(rows, ", ".join(f"`{c}` string" for c in (file_col, *names)))
        cells = F.array(*(F.struct(F.lit(label).alias("measure"), F.col(c).cast("string").alias("value")) for c, label in layout["values"].items()))
        part = df.join(F.broadcast(files), file_col).select(file_col, *names, *layout["keys"], F.explode(cells).alias("_c"))
        parts.append(part.select(file_col, *names, *layout["keys"], "_c.*"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def row_ratio(num: Column, den: Column, factor: int | float = 1, kind: str = "double") -> Column:
    """factor * num / den where den is positive and num there, else NULL."""
    return F.when((den > 0) & num.isNotNull(), (F.lit(factor) * num / F.nullif(den, F.lit(0))).cast(kind))


def split_by(df: DataFrame, condition: str) -> tuple[DataFrame, DataFrame]:
    """Two disjoint branches that exhaust df; UNKNOWN goes with the second."""
    yes = F.coalesce(F.expr(condition), F.lit(False))
    return df.filter(yes), df.filter(~yes)


def union_branches(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def replace_branch(table: DataFrame, branch: DataFrame, column: str, source) -> DataFrame:
    """The table with one source's rows replaced and its sibling sources' rows as they are."""
    if not branch.filter(~F.col(column).eqNullSafe(F.lit(source))).isEmpty():
        raise ValueError("the branch holds rows of another source")
    return table.filter(~F.col(column).eqNullSafe(F.lit(source))).unionByName(branch)
