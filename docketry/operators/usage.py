"""Request metrics as aggregations over an events table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import words

# Upper bounds of the histogram buckets, and the named durations.
BUCKETS = (0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)
DURATIONS = (
    "rag_ttft_ms", "llm_ttft_ms", "context_reranker_time_ms", "retrieval_time_ms", "llm_generation_time_ms",
)

QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
#: Size of a quantile sketch. With this size the rank of an estimate is within RANK_ERROR of the one
#: asked for, with 99 % confidence; up to this many values it is exact.
SKETCH_SIZE, RANK_ERROR = 2_000, 0.002


def bucket_bound(value: Column, bounds=BUCKETS) -> Column:
    """Upper bound of the value's bucket, bounds included; null above the last."""
    out = F.when(value <= bounds[0], F.lit(float(bounds[0])))
    for bound in bounds[1:]:
        out = out.when(value <= bound, F.lit(float(bound)))
    return out


def request_counts(requests: DataFrame) -> DataFrame:
    return requests.groupBy("method", "endpoint").agg(F.count("*").alias("n_requests"))


def token_totals(usage: DataFrame) -> DataFrame:
    """Sums of input and output tokens and of both."""
    return usage.agg(
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
    )


def token_histogram(usage: DataFrame, bounds=BUCKETS) -> DataFrame:
    total = F.col("input_tokens") + F.col("output_tokens")
    return (
        usage.where(total.isNotNull())
        .groupBy(bucket_bound(total, bounds).alias("le"))
        .agg(F.count("*").alias("n"))
    )


def words_per_chunk(chunks: DataFrame, text: str = "text") -> DataFrame:
    return chunks.agg(F.avg(F.size(words(F.col(text)))).alias("avg_words_per_chunk"))


def latency_rows(latencies: DataFrame, durations=DURATIONS) -> DataFrame:
    """One row per given duration: metric, ms. Nulls are left out."""
    return latencies.unpivot([], list(durations), "metric", "ms").where("ms is not null")


def latency_histogram(latencies: DataFrame, durations=DURATIONS, bounds=BUCKETS) -> DataFrame:
    return (
        latency_rows(latencies, durations)
        .groupBy("metric", bucket_bound(F.col("ms"), bounds).alias("le"))
        .agg(F.count("*").alias("n"), F.sum("ms").alias("total_ms"))
    )


def latency_percentiles(latencies: DataFrame, durations=DURATIONS, accuracy: int = 10_000) -> DataFrame:
    return (
        latency_rows(latencies, durations)
        .groupBy("metric")
        .agg(
            F.count("*").alias("n"),
            F.percentile_approx("ms", [0.5, 0.95, 0.99], accuracy).alias("p"),
        )
        .select("metric", "n", *[F.col("p")[i].alias(q) for i, q in enumerate(("p50", "p95", "p99"))])
    )


def latency_sketches(latencies: DataFrame, durations=DURATIONS, size: int = SKETCH_SIZE) -> DataFrame:
    """(metric, n, sketch): a quantile sketch per duration. Sketches of parts can be merged by
    `merged_sketches`, so they also serve as running totals and per day or source."""
    sketch = F.kll_sketch_agg_double(F.col("ms").cast("double"), F.lit(size))
    return latency_rows(latencies, durations).groupBy("metric").agg(F.count("*").alias("n"), sketch.alias("sketch"))


def merged_sketches(sketches: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """One row (metric, n, sketch) per metric from those of several parts."""
    return sketches.groupBy("metric").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, quantiles: dict[str, float] = QUANTILES) -> DataFrame:
    """(metric, n, a column per quantile) of rows (metric, n, sketch): values that occurred, whose rank
    is within the sketch's error of the one asked for."""
    return sketches.select("metric", "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(q).cast("double")).alias(c) for c, q in quantiles.items()])
