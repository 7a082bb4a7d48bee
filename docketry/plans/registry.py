"""The registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work that is heavy per text."""
    return spread(table(spark, sf_dir, "documents"))


def stamp(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# ---- pieces of SQL shared by several queries


def sql_trim(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def sql_tokens(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def sql_words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: w <> '')"


def sql_base(path: str) -> str:
    return f"string_split({path}, '/')[-1]"


def sql_distance(a: str, b: str) -> str:
    return f"pow(list_distance({a}::double[], {b}::double[]), 2)"
