"""Listing, reading and writing of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.text import extension


def list_files(spark: SparkSession, folder: str, extensions: list[str] | None = None) -> DataFrame:
    """Files below a folder with path and length, by lower-cased extension, sorted by path.

    Only the listing is read, not the contents. An empty list of extensions keeps all.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )
    return keep_extensions(found, extensions).orderBy("path")


def keep_extensions(files: DataFrame, extensions: list[str] | None, path: str = "path") -> DataFrame:
    if not extensions:
        return files
    return files.where(extension(F.col(path)).isin([e.lower() for e in extensions]))


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


EVALUATION_TYPE = (
    "question string, answer string, "
    "evidence array<struct<doc_name:string,evidence_page_num:long,evidence_text_full_page:string>>"
)


def read_evaluation(spark: SparkSession, path: str, id_field: str = "id") -> DataFrame:
    """Evaluation questions from JSON lines, under our column names."""
    return spark.read.schema(f"`{id_field}` string, {EVALUATION_TYPE}").json(path).select(
        F.col(id_field).alias("question_id"),
        "question",
        F.col("answer").alias("reference"),
        "evidence",
    )


def write_truth(truth: DataFrame, path: str) -> None:
    """Ground truth pages as JSON lines, one question per line."""
    (
        truth.groupBy(F.col("question_id").alias("original_id"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "filename", "page"))).alias("rows"))
        .select(
            "original_id",
            F.transform("rows", lambda r: F.struct(r["filename"].alias("filename"), r["page"].alias("page"))).alias("contexts"),
        )
        .write.mode("overwrite")
        .json(path)
    )


def write_chunks(chunks: DataFrame, path: str, mode: str = "append", clustered: bool = False) -> None:
    """Chunk rows by collection, sorted by source so that file statistics can skip.

    `clustered` pays one range shuffle for few files per collection; the chunk id is part
    of the range, so a large collection or source is still spread over many tasks.
    """
    laid = chunks.repartitionByRange("collection", "source.source_name", "chunk_id") if clustered else chunks
    (
        laid.sortWithinPartitions("collection", "source.source_name")
        .write.mode(mode)
        .option("maxRecordsPerFile", 1_000_000)
        .partitionBy("collection")
        .parquet(path)
    )


def write_elements(elements: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Extraction results kept on disk per collection; other collections stay untouched."""
    (
        elements.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("collection")
        .parquet(path)
    )
