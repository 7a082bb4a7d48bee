"""Streams of JSON files into tables: append, and merge batch by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketry.sources.tables import VersionedTable

FILES_PER_TRIGGER = 16


def json_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """New JSON files of a folder, schema declared, a bounded number per batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(folder)
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to a Parquet table, each row once: the sink's log follows the checkpoint."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def query_id(batch: DataFrame) -> str:
    """Inside a batch function: the id of the running query. It is kept in the checkpoint, so it is the
    same after a restart and another one with a new checkpoint, also under the same path."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def merge_stream(
    stream: DataFrame, table: VersionedTable, keys: list[str], order: list[str], checkpoint: str,
    available_now: bool = False, update: dict[str, Column] | None = None,
) -> StreamingQuery:
    """Merge each batch into a table; the last row of a key by `order` counts.

    The query's id and the batch's number are kept with the version, so a batch that is played again is
    skipped, and batches of other streams into the same table are not. With a new checkpoint a
    stream is another query and all its batches are merged, old files too; give an `update` that keeps
    the later row if those may be older than what the table has.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        own = (query_id(batch), batch_id)
        newest, played = table.state(*own)
        if played:
            return
        latest = F.max_by(F.struct(*batch.columns), F.struct(*order))
        once = batch.groupBy(*keys).agg(latest.alias("r")).select("r.*").persist()
        try:
            if newest is None:
                table.overwrite(once, own)
            else:
                table.merge(once, keys, update, batch=own, entry=newest)
        finally:
            once.unpersist()

    writer = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
