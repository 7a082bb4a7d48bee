"""Request metrics kept up to date from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketry.operators.usage import BUCKETS, SKETCH_SIZE, latency_histogram, latency_sketches, request_counts
from docketry.streaming.append import query_id


#: When a batch was written, beside its totals.
WRITTEN = "_written"


def count_requests(stream: DataFrame) -> DataFrame:
    """Running totals since the start, so there is no window and no watermark; state is a row per endpoint."""
    return request_counts(stream)


def latency_buckets(stream: DataFrame, durations, bounds=BUCKETS) -> DataFrame:
    return latency_histogram(stream, durations, bounds)


def latency_quantiles(stream: DataFrame, durations, size: int = SKETCH_SIZE) -> DataFrame:
    """Running totals that `sketch_quantiles` reads; state is a sketch of bounded size per duration."""
    return latency_sketches(stream, durations, size)


def keep_changes(totals: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Write the totals each batch changed, one folder per query and batch id, with the time.

    A replayed batch overwrites its own folder, so nothing is counted twice. With a new checkpoint the
    query has another id, and with it folders of its own.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn(WRITTEN, F.current_timestamp())
        timed.write.mode("overwrite").parquet(f"{path}/query={query_id(batch)}/batch={batch_id}")

    writer = totals.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def current_totals(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The latest total of each key: the one of the highest batch of the query that began last.

    A query with a new checkpoint counts from its start, so what earlier ones counted is not added
    and no longer shown once the new one has written a batch. Null keys count as one."""
    every = spark.read.parquet(path)
    begun = every.groupBy("query").agg(F.min(WRITTEN).alias("begun"))
    newest = begun.orderBy(F.desc("begun"), F.desc("query")).limit(1).select("query")
    rest = [c for c in every.columns if c not in (*keys, "query", "batch", WRITTEN)]
    latest = F.max_by(F.struct(*rest), "batch").alias("latest")
    return every.join(F.broadcast(newest), "query", "left_semi").groupBy(*keys).agg(latest).select(*keys, "latest.*")
