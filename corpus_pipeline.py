"""A corpus filtered and encoded in five stages, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Stages work on all that the one before kept. Null texts, null numbers, repeated rows and
further columns of docs stay as they are unless a stage's decision concerns them; no rows give no
rows. Further columns may have any name: only doc_id and text are read, by those names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docketry.llm import contain, secrets, simhash, tokens, toxicity
from docketry.llm.common import by_place
from docketry.llm.queries import PATTERN, RANKS, table
from docketry.session import work_path


def without(docs: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is not among the numbers; rows without one stay."""
    gone = numbers.select(F.col("doc_id").alias("number to drop")).where("`number to drop` is not null").distinct()
    names = docs.columns  # by place, as another column's name may differ in case only
    placed = by_place(docs)
    return placed.join(gone, placed[str(names.index("doc_id"))] == F.col("number to drop"), "left_anti").toDF(*names)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose expected severity reaches the limit fitted on the labels of the table.

    Labels are those of `labels`; the model learns from the texts of docs that have one."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"), "toxic")
    return toxicity.below_limit(docs, model)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest number.

    Shingles of four words, up to four differing bits, as the operator's contract has it."""
    found = simhash.near_copies(docs, shingle=4, radius=4)
    return without(docs, found.where("doc_id <> component_id"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold 0.8 or more of the five-word shingles of a benchmark item."""
    return without(docs, contain.contained(docs, table(spark, sf_dir, "benchmark"), 5, 0.8))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by <secret>; every document stays, and n_chars follows the new text."""
    return secrets.with_masked(docs, RANKS, PATTERN)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every document."""
    return tokens.encoded_and_decoded(docs, RANKS, PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("byte_bpe", bpe_stage),
]

#: SQL can say neither the fitted model nor the merges; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
