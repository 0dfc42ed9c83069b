"""Nine facts bound to their dimensions: a shape says which columns of a cleaned source become which keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import spark_key
from quern.operators.match import join_back
from quern.plans.star import TableSpec, identity_dim, technical_member
from quern.sources.store import scratch_table

#: Key of the geography that stands for none.
NO_GEOGRAPHY = "not_geographic"


@dataclass(frozen=True)
class FactShape:
    """A fact's keys: period (year, month or date key) if it has one, the roles of its geographies ("" is the only one),
    whether it has a product, an observation type and a series; direct: columns that are taken as they are, with types;
    value: precision and scale. grain: its primary key, the source's own if empty."""

    name: str
    period: str | None = None
    geographies: tuple[str, ...] = ()
    product: bool = False
    kind: bool = False
    series: tuple[str, ...] = ()
    direct: tuple[tuple[str, str], ...] = ()
    value: tuple[int, int] = (18, 2)


#: The nine. Names, keys and precisions are fixed values.
SHAPES = (
    FactShape("production", "year", ("",), True, True),
    FactShape("supply_use", "year", ("",), True, True),
    FactShape("trade", "year", ("reporter", "partner"), True, True, value=(22, 2)),
    FactShape("balance", None, ("",), True, True, direct=(("market_year", "int"), ("crop_year", "int")), value=(22, 4)),
    FactShape("national_statistics", "year", ("",), direct=(("measure", "string"), ("season", "string"), ("unit", "string")), value=(18, 2)),
    FactShape("price_month", "month", series=("product", "measure"), value=(20, 4)),
    FactShape("price_day", "date", series=("product", "measure"), value=(20, 4)),
    FactShape("price_year", "year", series=("product", "measure"), value=(20, 4)),
    FactShape("price_reference", None, series=("product", "measure"), direct=(("reference_year", "int"), ("reference_period", "string")), value=(20, 4)),
)


def geography_key(namespace: Column, scope: Column, identity: Column) -> Column:
    """Key of a geography; what has no identity is the technical member."""
    return F.when(identity.isNull(), F.lit(NO_GEOGRAPHY)).otherwise(spark_key("geography", namespace, scope, identity))


def geography_dim(spark: SparkSession, sources: list[DataFrame]) -> DataFrame:
    """One row per identity (namespace, scope, identity) of all sources (with role and label): its key, its distinct
    labels by role as JSON, and one technical member for what is not geographic."""
    natural = ["namespace", "scope", "identity"]
    known = [s.filter(F.col("identity").isNotNull()) for s in sources]
    dim = identity_dim(known, "geography", natural, "label", "geography_key", "role")
    return technical_member(spark, dim, {"geography_key": NO_GEOGRAPHY, "namespace": "__technical__", "scope": "not_geographic", "identity": "not_applicable", "labels_json": '[{"role":"technical","label":"not_applicable"}]'})


def period_key(kind: str, day: Column) -> Column:
    """20240131 for a date, 202401 for its month, 2024 for its year."""
    return {"year": F.year(day), "month": F.year(day) * 100 + F.month(day), "date": F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)}[kind]


def shape_spec(shape: FactShape) -> TableSpec:
    columns = {f"{shape.period}_key": "int"} if shape.period else {}
    fks = {}
    for role in shape.geographies:
        name = f"{role}_geography_key" if role else "geography_key"
        columns[name], fks[name] = "string", ("geography", "geography_key")
    columns |= {c: "string" for c, there in (("product_key", shape.product), ("type_key", shape.kind), ("series_key", bool(shape.series))) if there}
    keys = tuple(columns)
    columns |= dict(shape.direct) | {"value": f"decimal({shape.value[0]},{shape.value[1]})"}
    return TableSpec(shape.name, columns, keys, not_null=keys, fks=fks)


def _key_columns(shape: FactShape, namespace: str, scope: str, product: str, kind: str) -> list[tuple[str, tuple[str, ...], Column]]:
    """(key, the source's columns that it is made of, the key made of them) of a shape."""
    out = [(f"{role}_geography_key" if role else "geography_key", (role or "geography",), geography_key(F.lit(namespace), F.lit(scope), F.col(role or "geography"))) for role in shape.geographies]
    if shape.product:
        out.append(("product_key", (product,), spark_key("product", F.lit(namespace), F.col(product))))
    if shape.kind:
        out.append(("type_key", (kind,), spark_key("observation_type", F.lit(namespace), F.col(kind))))
    if shape.series:
        out.append(("series_key", shape.series, spark_key("series", F.lit(namespace), *(F.col(c) for c in shape.series))))
    return out


def bind_facts(df: DataFrame, shapes: Sequence[FactShape], namespace: str, scope: str, day: str = "day", product: str = "product", kind: str = "kind", value: Column | str = "value") -> dict[str, DataFrame]:
    """Projects a cleaned source to its facts, by name. Geographies are identities in columns named by role (`geography` for
    the only one) and may be NULL; series are told apart by the namespace and the shape's columns. A key is made once for
    all rows and facts that share it: of the different values in the source, which is read for it, and joined on them."""
    made: dict[tuple[str, tuple[str, ...]], DataFrame] = {}
    for shape in shapes:
        for name, columns, key in _key_columns(shape, namespace, scope, product, kind):
            if (name, columns) not in made:
                made[name, columns] = scratch_table(df.select(*columns).distinct().select(*columns, key.alias("_made")), "keys")
    facts = {}
    for shape in shapes:
        rows = df.withColumn("_value", F.col(value) if isinstance(value, str) else value)
        out = [period_key(shape.period, F.col(day)).cast("int").alias(f"{shape.period}_key")] if shape.period else []
        for i, (name, columns, _) in enumerate(_key_columns(shape, namespace, scope, product, kind)):
            rows = join_back(rows, made[name, columns].withColumnRenamed("_made", f"_made{i}"), list(columns))
            out.append(F.col(f"_made{i}").alias(name))
        out += [F.col(c) for c, _ in shape.direct]
        facts[shape.name] = shape_spec(shape).project(rows.select(*out, F.col("_value").alias("value")))
    return facts


def bind_fact(df: DataFrame, shape: FactShape, namespace: str, scope: str, day: str = "day", product: str = "product", kind: str = "kind", value: Column | str = "value") -> DataFrame:
    """One fact of a source; see bind_facts."""
    return bind_facts(df, (shape,), namespace, scope, day, product, kind, value)[shape.name]
