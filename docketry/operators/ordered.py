"""Joining of many rows' texts into one per key, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def joined_in_order(
    df: DataFrame, keys: list[str], order: str, text: str, separator: str, part_rows: int | None = None
) -> DataFrame:
    """Texts joined in order of `order`: one row per key, with keys and text.

    The result holds a key's whole text in one cell, so that much is in one task's memory. A caller
    who wants less asks for parts of `part_rows` rows each; the rows then also have part_no, and the
    texts of a key's parts joined in order give its whole text.
    """
    if part_rows is not None:
        by = Window.partitionBy(*keys).orderBy(order)
        df = df.withColumn("part_no", F.floor((F.row_number().over(by) - 1) / part_rows).cast("int"))
        keys = [*keys, "part_no"]
    return (
        df.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("x")))).alias("xs"))
        .select(*keys, F.array_join(F.transform("xs", lambda e: e["x"]), separator).alias("text"))
    )
