"""Column functions that clean source text. NULL in gives NULL out; nothing is imputed."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_column(c: Column) -> Column:
    """Trimmed text, blank as NULL."""
    t = F.trim(c.cast("string"))
    return F.when(t != "", t)


def missing_reason(value: Column, tokens: tuple[str, ...] = ()) -> Column:
    """Why a source value is no number: source_null, source_blank or source_marker; NULL if it may be one."""
    t = F.trim(value.cast("string"))
    out = F.when(value.isNull(), "source_null").when(t == "", "source_blank")
    return out.when(F.lower(t).isin([x.lower() for x in tokens]), "source_marker") if tokens else out


def source_values(df: DataFrame, value: str, unit: str | None = None, tokens: tuple[str, ...] = ()) -> DataFrame:
    """Adds value_raw, missing_reason and, with a unit column, unit_raw: the source's text as it came."""
    added = {"value_raw": F.col(value).cast("string"), "missing_reason": missing_reason(F.col(value), tokens)}
    if unit:
        added["unit_raw"] = F.col(unit).cast("string")
    return df.withColumns(added)


def identifier(c: Column) -> Column:
    """Identifier text without leading apostrophes and without a trailing .0, .00, ..."""
    return F.regexp_replace(F.regexp_replace(text_column(c), "^'+", ""), r"\.0+$", "")


def pad_code(c: Column, width: int = 3) -> Column:
    """Numeric codes shorter than width with zeros in front; other text as it is."""
    return F.when(c.rlike(f"^[0-9]{{1,{width}}}$"), F.lpad(c, width, "0")).otherwise(c)


def restore_code(c: Column, known: dict[str, str]) -> Column:
    """Codes whose leading zeros a source lost, by a small table of known ones."""
    out = c
    for short, full in known.items():
        out = F.when(c == short, full).otherwise(out)
    return out


def year4(c: Column) -> Column:
    """Four-digit year, else NULL."""
    t = text_column(c)
    return F.when(t.rlike("^[0-9]{4}$"), t.try_cast("int"))


def negative_flag(c: Column) -> Column:
    """Whether the source number is below zero, before any rounding; false where it is no number."""
    return F.coalesce(c.try_cast("double") < 0, F.lit(False))


def parse_error(raw: Column, parsed: Column) -> Column:
    """Non-empty source text from which no value came."""
    return text_column(raw).isNotNull() & parsed.isNull()


def checked_decimal(c: Column, factor: str | int = 1, precision: int = 18, scale: int = 2) -> tuple[Column, Column]:
    """(value, ok): c times factor as decimal(precision, scale) if that is exact, else NULL and false; NULL is ok."""
    wide = F.try_multiply(c.try_cast("decimal(38,12)"), F.lit(str(factor)).cast("decimal(12,4)"))
    narrow = wide.try_cast(f"decimal({precision},{scale})")
    exact = narrow.isNotNull() & (narrow.cast("decimal(38,12)") == wide)
    return F.when(exact, narrow), c.isNull() | F.coalesce(exact, F.lit(False))


def normalized_value(value: Column, unit: Column, precision: int, scale: int) -> Column:
    """Values in a `1000 X` unit times 1000, as an exact decimal."""
    kind = f"decimal({precision},{scale})"
    return F.when(unit.startswith("1000 "), F.try_multiply(value, F.lit(1000)).try_cast(kind)).otherwise(value.try_cast(kind))


def unit_name(unit: Column) -> Column:
    """The unit that normalized_value leaves: 1000 MT -> tonne and so on."""
    # fixed values: source units and the units that values in them are turned into
    names = {"1000 USD": "USD", "1000 MT": "tonne", "1000 HA": "hectare", "MT/HA": "tonne/hectare"}
    out = unit
    for source, name in names.items():
        out = F.when(unit == source, name).otherwise(out)
    return out


def convert_units(df: DataFrame, rules: DataFrame, element: str, unit: str, value: str, precision: int = 18, scale: int = 2) -> DataFrame:
    """Joins a small rule table (element, unit, factor, unit_to): adds converted, unit_to, unit_known, overflow."""
    small = rules.select(F.col("element").alias("_e"), F.col("unit").alias("_u"), "factor", "unit_to")
    joined = df.join(small, (F.col(element) == F.col("_e")) & (F.col(unit) == F.col("_u")), "left")
    wide = F.try_multiply(F.col(value).cast("decimal(28,8)"), F.col("factor").cast("decimal(9,4)"))
    converted = wide.try_cast(f"decimal({precision},{scale})")
    return joined.withColumns({"converted": converted, "unit_known": F.col("factor").isNotNull(), "overflow": F.col("factor").isNotNull() & F.col(value).isNotNull() & converted.isNull()}).drop("_e", "_u", "factor")


def decode_period(df: DataFrame, code: str) -> DataFrame:
    """Month codes 7001..7012 to months and 7021 to the whole year: adds month and time_grain (monthly, annual)."""
    n = F.col(code).try_cast("int")
    return df.withColumns({"month": F.when(n.between(7001, 7012), n - 7000), "time_grain": F.when(n.between(7001, 7012), "monthly").when(n == 7021, "annual")})


def parse_yyyymm(c: Column) -> Column:
    """struct(year, month, period_date) of text like 1960M01, else NULL."""
    t = text_column(c)
    year, month = F.substring(t, 1, 4).try_cast("int"), F.substring(t, 6, 2).try_cast("int")
    made = F.struct(year.alias("year"), month.alias("month"), F.concat(F.substring(t, 1, 4), F.lit("-"), F.substring(t, 6, 2), F.lit("-01")).try_cast("date").alias("period_date"))
    return F.when(t.rlike("^[0-9]{4}M(0[1-9]|1[0-2])$"), made)


def parse_dates(c: Column, formats: tuple[str, ...] = ("M/d/yyyy h:mm:ss a",)) -> Column:
    """Date by the first format that fits exactly, then ISO; day and month are never guessed."""
    t = text_column(c)
    return F.coalesce(*(F.try_to_timestamp(t, F.lit(f)) for f in formats), F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), t.try_cast("timestamp"))).cast("date")


def parse_grouped_number(c: Column, kind: str = "decimal(18,2)") -> Column:
    """Numbers whose commas, if any, split groups of exactly three digits."""
    t = text_column(c)
    return F.when(t.rlike(r"^-?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.[0-9]+)?$"), F.regexp_replace(t, ",", "").try_cast(kind))


def strict_numeric(c: Column) -> Column:
    """Whether text is a plain non-negative number: no exponent, at most 8 decimals that are not trailing zeros."""
    return F.coalesce(text_column(c).rlike(r"^[0-9]+(\.[0-9]{0,8}0*)?$"), F.lit(False))


def decode_ratio(df: DataFrame, attribute: str, value: str, ratio_attribute: str, divisor: int = 10000) -> DataFrame:
    """Divides the values of one attribute; the divisor stays beside them: adds value_decoded, conversion_factor."""
    is_ratio = F.col(attribute) == ratio_attribute
    v = F.col(value).cast("decimal(28,8)")
    return df.withColumns({"value_decoded": F.when(is_ratio, v / divisor).otherwise(v).cast("decimal(28,8)"), "conversion_factor": F.when(is_ratio, divisor).otherwise(1).cast("int")})


def default_text(c: Column, value: str) -> Column:
    t = text_column(c)
    return F.coalesce(t, F.lit(value))


def lookup(df: DataFrame, table: DataFrame, key: str, status: str = "lookup_status") -> DataFrame:
    """Left join with a table of unique keys; status is known or unknown. Spark broadcasts it if it is small."""
    return df.join(table.withColumn("_hit", F.lit(True)), key, "left").withColumn(status, F.when(F.col("_hit"), "known").otherwise("unknown")).drop("_hit")


def month_key(date: Column) -> Column:
    return F.year(date) * 100 + F.month(date)


def date_key(date: Column) -> Column:
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def sanitize(name: str) -> str:
    """Lower-case name of letters, digits and single underscores, without white space around it; col_ in front of a digit."""
    made = re.sub(r"_+", "_", re.sub(r"[^0-9a-zA-Z]", "_", name.strip())).lower()
    return f"col_{made}" if made[:1].isdigit() else made


def sanitize_columns(df: DataFrame) -> DataFrame:
    names = [sanitize(c) for c in df.columns]
    if clash := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"columns collide once sanitized: {clash}")
    return df.toDF(*names)


def source_payload(columns: list[str], keep: Column | None = None) -> Column:
    """The row as JSON with sorted keys and NULLs, where `keep` holds."""
    made = F.to_json(F.struct(*(F.col(f"`{c}`").cast("string").alias(c) for c in sorted(columns))), {"ignoreNullFields": "false"})
    return F.when(keep, made) if keep is not None else made
