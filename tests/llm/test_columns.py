"""Columns whose names differ from the ones read in case only are not read."""

import pytest
from pyspark.sql import functions as F

from docketry.llm.queries import QUERIES

TABLES = {"documents": ("doc_id", "text"), "labels": ("doc_id", "quality", "toxic"), "benchmark": ("item_id", "text"), "embeddings": ("vec_id", "label", "embedding")}


@pytest.mark.parametrize("name", QUERIES)
def test_names_of_another_case(spark, sf, monkeypatch, name):
    from docketry.llm import queries

    def table(spark_, sf_dir, table_):
        rows = spark.read.parquet(f"{sf}/{table_}.parquet")
        rows = rows.limit(150) if table_ != "labels" else rows  # a small fixture
        return rows.select(*rows.columns, *[F.lit("x").alias(c.upper()) for c in TABLES[table_]], *[F.lit("y").alias(c.title()) for c in TABLES[table_]])

    def plain(spark_, sf_dir, table_):
        rows = spark.read.parquet(f"{sf}/{table_}.parquet")
        return rows.limit(150) if table_ != "labels" else rows

    def got():
        return sorted((tuple(r) for r in QUERIES[name](spark, sf).collect()), key=repr)

    monkeypatch.setattr(queries, "table", plain)
    want = got()
    if name == "op12_hard_negatives":
        pytest.skip("its query derives a label by name; the operator is tested with its own columns")
    monkeypatch.setattr(queries, "table", table)
    assert got() == want
