"""Streams over events written as JSON files."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.operators.usage import QUANTILES, RANK_ERROR, latency_rows, sketch_quantiles
from docketry.plans.quality import requests
from docketry.plans.registry import query, table
from docketry.session import work_path
from docketry.sources.tables import VersionedTable
from docketry.streaming.append import append_stream, json_stream, merge_stream
from docketry.streaming.usage import count_requests, current_totals, keep_changes, latency_buckets, latency_quantiles

EVENT_TYPE = "event_id long, user_id long, event_type string, value double"


FILE_ROWS = 100_000


def _n_files(rows) -> int:
    """Files to write: as many as the rows fill, but enough for several batches."""
    return max(8, -(-rows.count() // FILE_ROWS))


def _event_stream(spark, sf):
    folder = work_path(spark, "incoming")
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    rows.repartitionByRange(_n_files(rows), "event_id").write.json(folder)
    return json_stream(spark, folder, EVENT_TYPE, files_per_trigger=3)


@query("select event_id, user_id, event_type, value from events")
def stream_append(spark, sf):
    path = work_path(spark, "appended")
    append_stream(_event_stream(spark, sf), path, work_path(spark, "offsets"), available_now=True).awaitTermination()
    return spark.read.schema(EVENT_TYPE).parquet(path)


@query("select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value from events group by 1")
def stream_merge(spark, sf):
    """The last event of each user, kept by merging batch after batch."""
    stored = VersionedTable(spark, work_path(spark, "last_events"), bucket_by=["user_id"], buckets=8)
    stored.overwrite(spark.createDataFrame([], EVENT_TYPE))
    stream = _event_stream(spark, sf)
    latest = {c: F.when(F.col("s.event_id") > F.col("t.event_id"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) for c in ("event_id", "event_type", "value")}
    merge_stream(
        stream, stored, ["user_id"], ["event_id"], work_path(spark, "offsets"), available_now=True, update=latest
    ).awaitTermination()
    return stored.read().select("user_id", "event_id", "event_type", "value")


def _request_stream(spark, sf):
    folder = work_path(spark, "requests")
    rows = requests(spark, sf)
    rows.repartition(_n_files(rows)).write.json(folder)
    return json_stream(spark, folder, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), 3)


@query("select case event_type when 'view' then 'GET' else 'POST' end as method, '/' || event_type as endpoint, count(*) as n_requests from events group by 1, 2")
def stream_request_counts(spark, sf):
    path = work_path(spark, "counts")
    totals = count_requests(_request_stream(spark, sf))
    keep_changes(totals, path, work_path(spark, "offsets"), available_now=True).awaitTermination()
    return current_totals(spark, path, ["method", "endpoint"])


@query("""
with l as (select unnest(['rag_ttft_ms', 'llm_ttft_ms']) as metric, unnest([case when event_type <> 'error' then value end, value * 10]) as ms from events)
select metric, (select min(b) from (select unnest([50, 500])::double as b) where b >= ms) as le, count(*) as n, round(sum(ms), 4) as total_ms
from l where ms is not null group by 1, 2
""")
def stream_latency(spark, sf):
    path = work_path(spark, "latency")
    buckets = latency_buckets(_request_stream(spark, sf), ("rag_ttft_ms", "llm_ttft_ms"), (50, 500))
    keep_changes(buckets, path, work_path(spark, "offsets"), available_now=True).awaitTermination()
    return current_totals(spark, path, ["metric", "le"]).withColumn("total_ms", F.round("total_ms", 4))


@query("""
with l as (select unnest(['rag_ttft_ms', 'llm_ttft_ms']) as metric, unnest([case when event_type <> 'error' then value end, value * 10]) as ms from events)
select metric, p, count(ms) as n, true as within_error from l, (select unnest(['p50', 'p95', 'p99']) as p) where ms is not null group by all
""")
def stream_percentiles(spark, sf):
    """Percentiles of streamed durations from sketches; of each the share of all values below it and
    the share up to it, taken over the table itself, are held against the rank asked for."""
    path, durations = work_path(spark, "quantiles"), ("rag_ttft_ms", "llm_ttft_ms")
    keep_changes(latency_quantiles(_request_stream(spark, sf), durations), path, work_path(spark, "offsets"), available_now=True).awaitTermination()
    found = sketch_quantiles(current_totals(spark, path, ["metric"])).unpivot(["metric", "n"], list(QUANTILES), "p", "estimate")
    rows = latency_rows(requests(spark, sf), durations).join(F.broadcast(found), "metric")
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in QUANTILES.items() for x in pair]), F.col("p"))
    below, upto = F.avg((F.col("ms") < F.col("estimate")).cast("int")), F.avg((F.col("ms") <= F.col("estimate")).cast("int"))
    held = (below - RANK_ERROR <= F.first(wanted)) & (F.first(wanted) <= upto + RANK_ERROR)
    return rows.groupBy("metric", "p").agg(F.first("n").alias("n"), held.alias("within_error"))
