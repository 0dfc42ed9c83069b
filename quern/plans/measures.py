"""Measures in a context: trees of sums, ratios, last values, ranks and years before, evaluated over several sets of
dimensions by one aggregation with grouping sets. Sums that a measure's rule forbids are refused."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.match import join_back


@dataclass(frozen=True)
class Sum:
    """Sum of a column; `never_over`: dimensions that it must not be summed over."""

    column: str
    never_over: tuple[str, ...] = ()


@dataclass(frozen=True)
class Count:
    """Rows with a value in the column."""

    column: str


@dataclass(frozen=True)
class LastNonEmpty:
    """Sum of a column in the last period that has one: a level, which is not summed over time."""

    column: str
    never_over: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ratio:
    """factor * num / den where den is positive."""

    num: object
    den: object
    factor: float = 1.0


@dataclass(frozen=True)
class YearBefore:
    """The measure in the period before, of the sets that have the period."""

    of: object


@dataclass(frozen=True)
class Growth:
    """Change in percent on the period before, where that is positive."""

    of: object


@dataclass(frozen=True)
class Rank:
    """Dense rank by the measure, greatest first, NULLs without one, within the dimensions named."""

    of: object
    within: tuple[str, ...] = ()


def _leaves(m) -> list:
    if isinstance(m, (Sum, Count, LastNonEmpty)):
        return [m]
    if isinstance(m, Ratio):
        return _leaves(m.num) + _leaves(m.den)
    if isinstance(m, (YearBefore, Growth, Rank)):
        return _leaves(m.of)
    raise TypeError(f"{m!r} is no measure")


def _check(name: str, leaves: list, dims: list[str], period: str, sets: list[tuple[str, ...]]) -> None:
    for leaf in leaves:
        for chosen in sets:
            if lost := sorted(set(getattr(leaf, "never_over", ())) & (set(dims) - set(chosen)) - ({period} if isinstance(leaf, LastNonEmpty) else set())):
                raise ValueError(f"additivity: {name} must not be summed over {', '.join(lost)}")


def evaluate(fact: DataFrame, measures: dict[str, object], sets: list[tuple[str, ...]], dims: list[str], period: str) -> DataFrame:
    """(scope, dims, measures): for each set of dimensions its groups, dimensions that are not in it NULL, and scope, their
    names joined by commas. The fact is aggregated once, over the sets with the period added; what follows works on
    these groups. A set over which a measure may not be summed is an error before anything is read."""
    for name, m in measures.items():
        _check(name, _leaves(m), dims, period, sets)
    if unknown := sorted({d for s in sets for d in s} - set(dims)):
        raise ValueError(f"unknown dimensions: {unknown}")
    leaves = list(dict.fromkeys(x for m in measures.values() for x in _leaves(m)))
    order = lambda s: tuple(d for d in dims if d in s)
    sets = list(dict.fromkeys(map(order, sets)))
    fine = list(dict.fromkeys(order({*s, period}) for s in sets))
    column = {leaf: f"_l{i}" for i, leaf in enumerate(leaves)}
    sums = [(F.count(x.column) if isinstance(x, Count) else F.sum(x.column)).alias(column[x]) for x in leaves]
    number = {s: sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s) for s in fine}
    base = fact.groupingSets([list(s) for s in fine], *dims).agg(F.grouping_id(*dims).alias("_id"), *sums)

    # each fine group goes into the sets that it refines: itself, and the one without the period
    targets = [(number[order({*s, period})], ",".join(s), period in s) for s in sets]
    given = F.array(*(F.struct(F.lit(n).alias("id"), F.lit(scope).alias("scope"), F.lit(kept).alias("kept")) for n, scope, kept in targets))
    base = base.withColumn("_t", F.explode(F.filter(given, lambda t: t["id"] == F.col("_id"))))
    base = base.withColumn("_p", F.col(period)).select("_t.scope", "_p", *(F.when(F.col("_t.kept"), F.col(d)).alias(d) if d == period else F.col(d) for d in dims), *column.values())
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("_p", F.col(c).alias("v"))))["v"]
    rolled = base.groupBy("scope", *dims).agg(*(last(column[x]).alias(column[x]) if isinstance(x, LastNonEmpty) else F.sum(column[x]).alias(column[x]) for x in leaves))

    def add(df: DataFrame, m, at: list[int]) -> tuple[DataFrame, Column]:
        if m in column:
            return df, F.col(column[m])
        name = f"_m{at[0]}"
        at[0] += 1
        if isinstance(m, Ratio):
            df, num = add(df, m.num, at)
            df, den = add(df, m.den, at)
            value = F.when(den > 0, F.lit(m.factor) * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)))
            return df.withColumn(name, value), F.col(name)
        df, value = add(df, m.of, at)
        if isinstance(m, Rank):
            w = Window.partitionBy("scope", *m.within).orderBy(value.desc_nulls_last())
            return df.withColumn(name, F.when(value.isNotNull(), F.dense_rank().over(w))), F.col(name)
        before = df.filter(F.col(period).isNotNull()).select("scope", *((F.col(d) + 1).cast(df.schema[d].dataType).alias(d) if d == period else F.col(d) for d in dims), value.alias(name))
        df = join_back(df, before, ["scope", *dims], "left")
        if isinstance(m, YearBefore):
            return df, F.col(name)
        grown = F.when(F.col(name) > 0, (value.cast("double") / F.nullif(F.col(name).cast("double"), F.lit(0.0)) - 1) * 100)
        return df.withColumn(f"{name}g", grown), F.col(f"{name}g")

    counter, out = [0], []
    for name, m in measures.items():
        rolled, value = add(rolled, m, counter)
        out.append(value.alias(name))
    return rolled.select("scope", *dims, *out)
