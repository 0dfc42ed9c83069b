"""Declarative contracts of cleaned tables, and the projection that applies them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.clean import source_payload

SIMPLE = {"string": "string", "integer": "int", "int": "int", "long": "bigint", "bigint": "bigint", "double": "double", "float": "float", "boolean": "boolean", "date": "date", "timestamp": "timestamp"}
WHOLE = ("int", "bigint")
ERROR = "array<struct<rule_id:string,error_message:string,failed_column:string>>"


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"
    source: str | None = None
    nullable: bool = True
    required: bool = True
    markers: tuple[str, ...] = ()

    @property
    def type(self) -> str:
        if self.kind in SIMPLE:
            return SIMPLE[self.kind]
        if self.kind.startswith("decimal("):
            p, s = (int(x) for x in self.kind[8:-1].split(","))
            if 0 <= s <= p <= 38:
                return f"decimal({p},{s})"
        raise ValueError(f"unknown type {self.kind} of {self.name}")


@dataclass(frozen=True)
class Rule:
    rule_id: str
    predicate: str
    message: str = ""
    column: str = ""
    action: str = "QUARANTINE"  # or LOG, KEEP


@dataclass(frozen=True)
class Contract:
    dataset: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    order: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    checks: dict = field(default_factory=dict)

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.dataset}: columns are named twice")
        if unknown := [k for k in (*self.keys, *self.partitions) if k not in names]:
            raise ValueError(f"{self.dataset}: keys or partitions are no columns: {unknown}")
        if bad := [r.rule_id for r in self.rules if r.action not in ("QUARANTINE", "LOG", "KEEP")]:
            raise ValueError(f"{self.dataset}: unknown actions of rules {bad}")
        [f.type for f in self.fields]

    def required_rules(self) -> tuple[Rule, ...]:
        """NOT NULL rules for keys and columns that may not be NULL."""
        return tuple(Rule(f"required_{f.name}", f"`{f.name}` IS NOT NULL", f"{f.name} is missing", f.name) for f in self.fields if f.name in self.keys or not f.nullable)


def _cast(f: Field, raw: Column) -> tuple[Column, Column]:
    """(value, error): blanks and markers are NULL, whole numbers must be whole, NaN and infinities are errors."""
    text = F.trim(raw.cast("string"))
    if f.type == "string":
        return F.when(text != "", text), F.lit(False)
    empty = (text == "") | (F.lower(text).isin([m.lower() for m in f.markers]) if f.markers else F.lit(False))
    given = F.when(~empty, text)
    if f.type in WHOLE:
        number = given.try_cast("decimal(38,10)")
        value = F.when(number == F.floor(number), number.try_cast(f.type))
    elif f.type in ("double", "float"):
        number = given.try_cast("double")
        value = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number.cast(f.type))
    else:
        value = given.try_cast(f.type)
    return value, given.isNotNull() & value.isNull()


def normalize(df: DataFrame, contract: Contract) -> DataFrame:
    """One projection to the contract's columns, with _cast_errors (array of structs), _payload (JSON of the source row,
    kept for rows with cast errors) and any column of df whose name begins with an underscore.

    An optional column that df lacks becomes a typed NULL; a required one is an error."""
    have = set(df.columns)
    if lacking := [f.source or f.name for f in contract.fields if f.required and (f.source or f.name) not in have]:
        raise ValueError(f"{contract.dataset}: source columns are missing: {lacking}")
    out, errors = [], []
    for f in contract.fields:
        source = f.source or f.name
        if source not in have:
            out.append(F.lit(None).cast(f.type).alias(f.name))
            continue
        value, wrong = _cast(f, F.col(f"`{source}`"))
        out.append(value.alias(f.name))
        errors.append(F.when(wrong, F.struct(F.lit(f"cast_{f.name}").alias("rule_id"), F.lit(f"not a valid {f.kind}").alias("error_message"), F.lit(f.name).alias("failed_column"))))
    found = F.filter(F.array(*errors), lambda e: e.isNotNull()) if errors else F.array().cast(ERROR)
    sources = [c for c in df.columns if not c.startswith("_")]
    extras = [F.col(f"`{c}`") for c in df.columns if c.startswith("_") and c not in {f.name for f in contract.fields}]
    return df.select(*out, found.cast(ERROR).alias("_cast_errors"), source_payload(sources, F.size(found) > 0).alias("_payload"), *extras)
