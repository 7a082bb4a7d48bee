"""Payloads kept by string key: element_key, collection, file_name, content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.sources.tables import first_per_key

PAYLOAD_TYPE = "element_key string, collection string, file_name string, content string, put_at long"


def put_payloads(payloads: DataFrame, new: DataFrame) -> DataFrame:
    """Add one or many payloads; the last write of a key wins (`put_at` says which is last)."""
    return first_per_key(payloads.unionByName(new), ["element_key"], [-F.col("put_at")])


def get_payloads(keys: DataFrame, payloads: DataFrame) -> DataFrame:
    """Payload of each asked key, an empty text for a key that is not there."""
    found = payloads.select("element_key", "content")
    return keys.join(found, "element_key", "left").withColumn(
        "content", F.coalesce("content", F.lit(""))
    )


def list_payloads(payloads: DataFrame, prefix: str) -> DataFrame:
    return payloads.where(F.col("element_key").startswith(prefix)).select("element_key")


def delete_payloads(payloads: DataFrame, keys: DataFrame) -> DataFrame:
    return payloads.join(keys.select("element_key").distinct(), "element_key", "left_anti")
