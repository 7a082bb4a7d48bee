"""Citations: what a hit shows to the reader.

Hits have query_id, collection, text, source_id, plain_source, rank, score and
content_metadata struct<type,subtype,page_number,location>.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.text import base_name, element_key
from docketry.sources.payloads import get_payloads

# Kinds a citation may have, and how many pictures a model is shown.
CITED = ("image", "text", "table", "chart", "audio")
PICTURES_TOTAL = 4
PICTURES_OF_QUERY = 1
PICTURES_OF_CONTEXT = 1


def with_pictures(hits: DataFrame, payloads: DataFrame) -> DataFrame:
    """Adds `picture`, the stored content of image and structured hits."""
    meta = F.col("content_metadata")
    visual = F.coalesce(meta["type"].isin("image", "structured"), F.lit(False))
    key = element_key(F.col("collection"), base_name(F.col("source_id")), meta["page_number"], meta["location"])
    # other hits get a key of their own that no payload has; one null key would gather them in one task
    no_picture = F.concat(F.lit("\u0000"), F.xxhash64("query_id", "rank", "text").cast("string"))
    keyed = hits.withColumn("element_key", F.when(visual & key.isNotNull(), key).otherwise(no_picture))
    return get_payloads(keyed, payloads).withColumnRenamed("content", "picture").drop("element_key")


def cite(hits: DataFrame, payloads: DataFrame) -> DataFrame:
    """One citation per hit that has content and a known kind."""
    meta = F.col("content_metadata")
    kind = meta["type"]
    document_type = (
        F.when(kind.isin("text", "audio", "image"), kind)
        .when(kind == "structured", meta["subtype"])
        .when(F.col("plain_source"), "text")
    )
    content = (
        F.when(kind.isin("text", "audio"), F.col("text"))
        .when(kind.isin("image", "structured"), F.col("picture"))
        .when(F.col("plain_source"), F.col("text"))
    )
    visual = kind.isin("image", "structured")
    return (
        with_pictures(hits, payloads)
        .select(
            "query_id",
            "collection",
            "rank",
            content.alias("content"),
            base_name(F.col("source_id")).alias("document_name"),
            document_type.alias("document_type"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
            F.struct(
                F.when(visual, meta["page_number"]).alias("page_number"),
                F.when(visual, meta["location"]).alias("location"),
                F.col("text").alias("description"),
                meta.alias("content_metadata"),
            ).alias("metadata"),
        )
        .where((F.col("content") != "") & F.col("document_type").isin(*CITED))
    )


def citation_counts(citations: DataFrame) -> DataFrame:
    return citations.groupBy("query_id").agg(F.count("*").alias("total_results"))


def visual_hits(hits: DataFrame, payloads: DataFrame) -> DataFrame:
    """Image and structured hits that have a stored picture."""
    visual = hits.where(F.col("content_metadata.type").isin("image", "structured"))
    return with_pictures(visual, payloads).where(F.col("picture") != "")


def pictures_shown(
    asked: DataFrame, found: DataFrame, total: int = PICTURES_TOTAL, of_query: int = PICTURES_OF_QUERY,
    of_context: int = PICTURES_OF_CONTEXT,
) -> DataFrame:
    """Pictures a model is shown per query: the first of the question, then the first found.

    Both sides have query_id, rank, picture; the result adds `origin` and renumbers `rank`.
    """
    if of_query + of_context > total:
        raise ValueError("the limits for question and context exceed the total")
    by = Window.partitionBy("query_id").orderBy("rank")

    def first(df: DataFrame, n: int, origin: str) -> DataFrame:
        numbered = df.select("query_id", "picture", F.row_number().over(by).alias("rank"))
        return numbered.where(F.col("rank") <= n).withColumn("origin", F.lit(origin))

    return first(asked, of_query, "question").unionByName(first(found, of_context, "context"))
