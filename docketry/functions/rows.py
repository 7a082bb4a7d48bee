"""Rows from arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(df: DataFrame, array: Column | str, item: str, pos: str | None = None) -> DataFrame:
    """One row per element, the array computed once.

    A plain explode makes the optimizer add a filter on the array's size, which
    computes a derived array a second time; the outer form with a filter on the
    position does not.
    """
    place = pos or "explode_pos"
    out = df.select("*", F.posexplode_outer(array).alias(place, item)).where(F.col(place).isNotNull())
    return out if pos else out.drop(place)


def bind(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often `use` refers to it."""
    return F.transform(F.array(value), use)[0]
