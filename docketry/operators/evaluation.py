"""Retrieval quality: ground truth pages, recall at k, judged answers."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import DOCUMENT_SUFFIXES
from docketry.operators.tiles import best_pairs
from docketry.session import cut_lineage

# Cuts at which recall is measured.
RECALL_AT = (1, 3, 5, 10)


def page_name(document: Column, page: Column) -> Column:
    return F.concat(document, F.lit("_"), page.cast("string"))


def split_page_name(name: Column) -> Column:
    """struct<filename,page>: cut at the last underscore, no page for a bare document name."""
    bare = F.lit(False)
    for suffix in DOCUMENT_SUFFIXES:
        bare = bare | name.endswith(suffix)
    has_page = ~bare & F.contains(name, F.lit("_"))
    return F.struct(
        F.when(has_page, F.regexp_extract(name, r"(?s)^(.*)_([^_]*)$", 1)).otherwise(name).alias("filename"),
        F.when(has_page, F.regexp_extract(name, r"(?s)^(.*)_([^_]*)$", 2)).otherwise("").alias("page"),
    )


#: Places of a histogram of characters; characters that share one only raise the bound.
CHARACTERS = 512


def histograms(texts: list[str]) -> np.ndarray:
    """How often each character is in each text, by rows."""
    out = np.zeros((len(texts), CHARACTERS), np.int32)
    for row, text in enumerate(texts):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") % CHARACTERS
        out[row] = np.bincount(codes, minlength=CHARACTERS)
    return out


class SimilarText:
    """Similarity ratio of `text` columns, negated so that the smallest is best.

    A match pairs equal characters one to one, so what two texts have in common in their histograms
    bounds the ratio from above. Pages are compared in full from the highest bound down, until the
    bound falls below the best ratio seen; texts with nothing in common are no match."""

    def items(self, batch):
        texts = [text.encode("unicode_escape").decode() for text in batch.column("text").to_pylist()]
        return texts, histograms(texts)

    def queries(self, table):
        texts = table.column("text").to_pylist()
        return texts, histograms(texts)

    def take(self, data, rows):
        return [data[0][i] for i in rows], data[1][rows]

    def rough(self, items, queries, bound):
        (pages, own), (texts, wanted) = items, queries
        scores = np.full((len(pages), len(texts)), np.inf)
        lengths = np.array([len(p) for p in pages])
        for col, asked in enumerate(texts):
            common = np.minimum(own, wanted[col]).sum(axis=1)
            most = 2.0 * common / np.maximum(lengths + len(asked), 1)
            matcher = SequenceMatcher(None, "", asked)
            best = -bound[col] if np.isfinite(bound[col]) else 0.0
            for row in np.argsort(-most, kind="stable").tolist():
                if most[row] < best or most[row] == 0:
                    break
                matcher.set_seq1(pages[row])
                ratio = matcher.ratio()
                if ratio > 0:
                    scores[row, col] = -ratio
                    best = max(best, ratio)
        return scores, 0.0

    def exact(self, items, rows, queries, cols, rough):
        return rough


def best_pages(evidence: DataFrame, pages: DataFrame, **bounds) -> DataFrame:
    """Most similar page of the evidence's document: question_id, pos, page.

    `evidence` has question_id, pos, doc_name, evidence_text; `pages` has doc_name,
    page_no, page_text. The earliest page wins a tie; page 0 if nothing is alike. The
    document is the route by which evidence meets pages, so no pairs are joined.
    """
    numbered = cut_lineage(
        evidence.select("question_id", "pos", "doc_name", "evidence_text").withColumn(
            "query_id", F.monotonically_increasing_id()
        )
    )
    items = pages.select(
        F.col("page_no").cast("long").alias("item_id"),
        F.lit(None).alias("grp"),
        F.col("doc_name").alias("route"),
        F.col("page_text").alias("text"),
    )
    asked = numbered.select("query_id", F.col("doc_name").alias("route"), F.col("evidence_text").alias("text"))
    found = best_pairs(items, asked, SimilarText(), 1, "length(text) * 4", **bounds)
    return numbered.join(found.select("query_id", "item_id"), "query_id", "left").select(
        "question_id", "pos", F.coalesce("item_id", F.lit(0)).cast("int").alias("page")
    )


def ground_truth(questions: DataFrame, pages: DataFrame | None = None, file_ext: str = "") -> DataFrame:
    """Truth rows question_id, pos, filename, page from the evidence lists.

    An explicit page comes first, else the page most like the evidence text, else the
    document alone (page "").
    """
    rows = questions.select("question_id", F.posexplode("evidence").alias("pos", "e")).select(
        "question_id", "pos", "e.*"
    )
    suffixed = F.lit(False)
    for suffix in DOCUMENT_SUFFIXES:
        suffixed = suffixed | F.col("doc_name").endswith(suffix)
    name = F.when(suffixed, F.col("doc_name")).otherwise(F.concat("doc_name", F.lit(file_ext)))
    given = F.col("evidence_page_num").cast("string")
    if pages is None:
        return rows.select(
            "question_id", "pos", name.alias("filename"), F.coalesce(given, F.lit("")).alias("page")
        )
    by_text = rows.where(
        F.col("evidence_page_num").isNull() & (F.coalesce("evidence_text_full_page", F.lit("")) != "")
    ).withColumnRenamed("evidence_text_full_page", "evidence_text")
    matched = best_pages(by_text, pages).select("question_id", "pos", F.col("page").cast("string").alias("alike"))
    return rows.join(matched, ["question_id", "pos"], "left").select(
        "question_id", "pos", name.alias("filename"), F.coalesce(given, "alike", F.lit("")).alias("page")
    )


def recall_by_question(truth: DataFrame, hits: DataFrame, at: tuple[int, ...] = RECALL_AT) -> DataFrame:
    """Recall per question, granularity and k: question_id, granularity, k, recall.

    `truth` has question_id, pos, filename, page; `hits` has question_id, rank, name
    (document_page). Distinct hits that are true, over the length of the truth list.
    Pages count only where the question's first truth row has one; otherwise both
    granularities compare documents. Questions without hits are left out.
    """
    first_page = F.min_by("page", "pos")
    per_question = truth.groupBy("question_id").agg(
        F.count("*").alias("n_truth"), (F.trim(F.coalesce(first_page, F.lit(""))) != "").alias("paged")
    )
    sides = F.explode(F.array(F.lit("page"), F.lit("document"))).alias("granularity")

    def keyed(df: DataFrame, paged_key: Column, plain_key: Column, *more) -> DataFrame:
        return (
            df.join(per_question, "question_id")
            .select("*", sides)
            .select(
                "question_id",
                "granularity",
                F.when(F.col("paged") & (F.col("granularity") == "page"), paged_key).otherwise(plain_key).alias("key"),
                *more,
            )
        )

    truth_keys = keyed(truth, page_name(F.col("filename"), F.col("page")), F.col("filename")).distinct()
    document = F.regexp_replace(F.col("name"), "(?s)_[^_]*$", "")
    best = (
        keyed(hits.where(F.col("rank") <= max(at)), F.col("name"), document, "rank")
        .groupBy("question_id", "granularity", "key")
        .agg(F.min("rank").alias("best"))
    )
    found = best.join(truth_keys.withColumn("true", F.lit(1)), ["question_id", "granularity", "key"], "left")
    counted = found.groupBy("question_id", "granularity").agg(
        *[F.count_if((F.col("best") <= k) & F.col("true").isNotNull()).alias(f"k{k}") for k in at]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("n")) for k in at])).alias("r")
    return (
        counted.join(per_question, "question_id")
        .select("question_id", "granularity", "n_truth", rows)
        .select(
            "question_id",
            "granularity",
            F.col("r.k").alias("k"),
            (F.col("r.n") / F.col("n_truth")).alias("recall"),
        )
    )


def mean_recall(recall: DataFrame, top_k: int, questions: DataFrame | None = None) -> DataFrame:
    """Mean per granularity and k, for k up to top_k.

    Questions without hits do not count, unless `questions` (question_id) is given:
    then they count as 0.
    """
    kept = recall.where(F.col("k") <= top_k).groupBy("granularity", "k")
    sums = kept.agg(F.sum("recall").alias("total"), F.count("*").alias("n_questions"))
    if questions is not None:
        sums = sums.withColumn("n_questions", F.lit(questions.count()).cast("long"))
    return sums.select("granularity", "k", "n_questions", (F.col("total") / F.col("n_questions")).alias("mean_recall"))


def evaluation_set(
    questions: DataFrame, contexts: DataFrame, responses: DataFrame, n: int | None = None
) -> DataFrame:
    """All questions, or the first n, with their contexts in rank order, response and reference.

    `contexts` (question_id, rank, text) is cut to k per question before.
    """
    first = questions.select("question_id", "question", "reference")
    if n is not None:
        first = first.orderBy("question_id").limit(n)
    listed = F.sort_array(F.collect_list(F.struct("rank", "text")))
    per_question = (
        contexts.join(first.select("question_id"), "question_id", "left_semi")
        .groupBy("question_id")
        .agg(F.transform(listed, lambda e: e["text"]).alias("contexts"))
    )
    return (
        first.join(per_question, "question_id", "left")
        .join(responses.select("question_id", "response"), "question_id", "left")
        .withColumn("contexts", F.coalesce("contexts", F.array().cast("array<string>")))
    )


def judged(rows: DataFrame, judges: dict[str, Callable[..., pd.Series]]) -> DataFrame:
    """Adds one 0..1 score column per judge, a function over question, contexts, response, reference."""
    columns = ("question", F.array_join("contexts", "\n"), "response", "reference")
    return rows.withColumns({name: _judge_score(judge)(*columns) for name, judge in judges.items()})


def _judge_score(judge: Callable[..., pd.Series]):
    @F.pandas_udf("double")
    def score(question: pd.Series, context: pd.Series, response: pd.Series, reference: pd.Series) -> pd.Series:
        return pd.Series(judge(question, context, response, reference), dtype="float64")

    return score


def judged_means(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.agg(*[F.avg(n).alias(n) for n in names], F.count("*").alias("n_rows"))
