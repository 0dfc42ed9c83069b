"""Joins of a table with an aggregate of itself, NULL keys meeting NULL keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_back(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """df with the further columns of other, which has one row per key."""
    if not keys:
        return df.join(other, F.lit(True), how)  # one row on the other side
    there = other.select(*(F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)), *(f"`{c}`" for c in other.columns if c not in keys))
    on = reduce(lambda a, b: a & b, (F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)))
    return df.join(there, on, how).drop(*(f"_key{i}" for i in range(len(keys))))
