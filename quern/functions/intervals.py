"""Interval values: a number as text stands for all numbers that are written so, half a unit of its last digit to each
side. Intervals are structs (low, high) of double; an unknown one has NULL bounds, and so has all that is made of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"


def _of(low: Column, high: Column) -> Column:
    return F.struct(low.alias("low"), high.alias("high"))


def interval(text: Column) -> Column:
    """'1.20' is 1.195 to 1.205, '7' is 6.5 to 7.5; numbers with an exponent, and what is no number, are unknown."""
    t = F.trim(text.cast("string"))
    point = F.instr(t, ".")  # one regular expression per number is enough
    half = F.pow(F.lit(10.0), F.when(point > 0, point - F.length(t)).otherwise(0)) / 2
    v = F.when(t.rlike(_NUMBER), t.try_cast("double"))
    return _of(v - half, v + half)


def exactly(value: Column) -> Column:
    v = value.cast("double")
    return _of(v, v)


def plus(a: Column, b: Column) -> Column:
    return _of(a["low"] + b["low"], a["high"] + b["high"])


def minus(a: Column, b: Column) -> Column:
    return _of(a["low"] - b["high"], a["high"] - b["low"])


def times(a: Column, b: Column) -> Column:
    corners = [x * y for x in (a["low"], a["high"]) for y in (b["low"], b["high"])]
    return _of(F.least(*corners), F.greatest(*corners))


def scaled(a: Column, factor: float) -> Column:
    ends = [a[c] * F.lit(float(factor)) for c in ("low", "high")]
    return _of(F.least(*ends), F.greatest(*ends))


def hull(a: Column, b: Column) -> Column:
    """The least interval that holds both."""
    known = a["low"].isNotNull() & b["low"].isNotNull()
    return _of(F.when(known, F.least(a["low"], b["low"])), F.when(known, F.greatest(a["high"], b["high"])))


def total(a: Column) -> Column:
    """Sum of a group's intervals."""
    return _of(F.sum(a["low"]), F.sum(a["high"]))


def meets(a: Column, b: Column, slack: float = 1e-9) -> Column:
    """Whether some number lies in both; slack is relative, for rounding."""
    room = slack * F.greatest(F.abs(a["low"]), F.abs(a["high"]), F.abs(b["low"]), F.abs(b["high"]))
    return (a["low"] <= b["high"] + room) & (b["low"] <= a["high"] + room)


def distance(a: Column, b: Column) -> Column:
    """Between the nearest numbers of both; 0 if they meet."""
    return F.greatest(a["low"] - b["high"], b["low"] - a["high"], F.lit(0.0))
