"""Versioned Parquet tables: snapshots, history, and changes that rewrite touched partitions only.

Rows of version N are in the folders `root/data/version=V[/column=value]` that its
history row under `root/history` names. The history row is written last, so a version
exists once its row does, and a job that dies half way leaves nothing readable behind.
Nothing is ever written over a path being read. One writer per table is assumed.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTORY_TYPE = (
    "version long, timestamp timestamp, operation string, rows_written long, "
    "rows_inserted long, rows_updated long, rows_deleted long, stream string, batch_id long, "
    "folders array<string>, row_type string"
)
MARK = "_mark"
BUCKET = "_bucket"


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


class VersionedTable:
    """A table of snapshots. With `partition_by`, a text column that is never null, a change
    rewrites only the partitions it touches; an append rewrites nothing.

    With `bucket_by`, a list of columns, the partitions are that many `buckets` by a hash of them. A
    merge on these columns reads and rewrites only the buckets its source falls into, which the
    source alone tells. Both settings stay the same for all changes of a table."""

    def __init__(
        self, spark: SparkSession, root: str, partition_by: str | None = None,
        bucket_by: list[str] | None = None, buckets: int = 64,
    ):
        if partition_by and bucket_by:
            raise ValueError("either partition_by or bucket_by")
        self.spark, self.root, self.bucket_by, self.buckets = spark, root.rstrip("/"), bucket_by, buckets
        self.partition_by = BUCKET if bucket_by else partition_by

    def _bucket(self, types: T.StructType) -> Column:
        """The bucket of a row, its columns taken as the table's types so that equal keys agree."""
        keys = [F.col(c).cast(types[c].dataType) for c in self.bucket_by]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("string").alias(BUCKET)

    def history(self) -> DataFrame:
        """One row per version: when, what operation, how many rows."""
        folder = f"{self.root}/history"
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], HISTORY_TYPE)
        return self.spark.read.schema(HISTORY_TYPE).json(folder)

    def latest(self) -> int | None:
        return self.history().agg(F.max("version")).first()[0]

    def _entry(self, version: int | None = None) -> Row | None:
        rows = self.history()
        if version is not None:
            rows = rows.where(F.col("version") == version)
        return rows.orderBy(F.desc("version")).first()

    def state(self, stream: str, batch_id: int) -> tuple[Row | None, bool]:
        """The newest history row, and whether this batch of the stream has a version, in one job."""
        rows = self.history()
        played = F.coalesce((F.col("stream") == stream) & (F.col("batch_id") == batch_id), F.lit(False))
        newest = F.max_by(F.struct(*rows.columns), "version")
        got = rows.agg(newest.alias("newest"), F.max(played).alias("played")).first()
        return got["newest"], bool(got["played"])

    def read(self, version: int | None = None) -> DataFrame:
        """The current table, or version N."""
        return self._rows(self._require(version)).drop(BUCKET)

    def _require(self, version: int | None = None) -> Row:
        entry = self._entry(version)
        if entry is None:
            raise ValueError(f"no such version in {self.root}: {version}")
        return entry

    def _rows(self, entry: Row) -> DataFrame:
        return self._read(entry["folders"], T.StructType.fromJson(json.loads(entry["row_type"])))

    def _read(self, folders: list[str], row_type: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], row_type)
        with_version = T.StructType([*row_type.fields, T.StructField("version", T.LongType())])
        base = f"{self.root}/data"
        return (
            self.spark.read.schema(with_version)
            .option("basePath", base)
            .parquet(*[f"{base}/{folder}" for folder in folders])
            .select(*row_type.names)
        )

    def _folders(self, version: int) -> list[str]:
        """Folders a version wrote, one per partition value, from one listing."""
        name = f"version={version}"
        if not self.partition_by:
            return [name]
        base = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data/{name}")
        found = base.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(base)
        return sorted(f"{name}/{f.getPath().getName()}" for f in found if f.isDirectory())

    def _commit(
        self, entry: Row | None, df: DataFrame, operation: str, marks: dict[str, Column] | None = None,
        kept: list[str] | None = None, batch: tuple[str, int] | None = None,
    ) -> int:
        """Write df as the version after `entry`, beside the `kept` folders of that one; without
        them df is the whole table."""
        version = 0 if entry is None else entry["version"] + 1
        if self.bucket_by:
            # files per bucket do not follow the number of tasks, and a large bucket is split; the
            # counts are taken behind it, where an empty result does not take them away
            df = df.select("*", self._bucket(df.schema)).hint("rebalance", BUCKET)
        counted = Observation()
        sums = [F.coalesce(F.sum(mark.cast("long")), F.lit(0)).alias(n) for n, mark in (marks or {}).items()]
        seen = df.observe(counted, F.count(F.lit(1)).alias("seen"), *sums)
        if MARK in df.columns:
            seen = seen.where(F.col(MARK) != "delete").drop(MARK)
        row_type = T.StructType([T.StructField(f.name, f.dataType, True) for f in seen.schema])
        path = f"{self.root}/data/version={version}"
        writer = seen.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(self.partition_by)
        writer.parquet(path)
        sizes = counted.get
        gone = sizes.get("rows_deleted", 0)
        added = sizes.get("rows_inserted", 0)
        rows = sizes["seen"] if kept is None else entry["rows_written"] + added - gone
        row = (
            version, datetime.now(UTC), operation, rows, added, sizes.get("rows_updated", 0), gone, *(batch or (None, None)),
            [*(kept or []), *self._folders(version)], row_type.json(),
        )
        self.spark.createDataFrame([row], HISTORY_TYPE).coalesce(1).write.mode("append").json(
            f"{self.root}/history"
        )
        return version

    def _change(
        self, entry: Row, touched: DataFrame, change, operation: str, marks: dict[str, Column],
        added=None, batch: tuple[str, int] | None = None,
    ) -> int:
        """Rewrite the partitions of the `touched` rows through `change`, a function of their rows, and
        add the rows that `added`, another such function, gives."""
        current, folders = self._rows(entry), entry["folders"]
        if self.partition_by:
            # one value per partition, so the list is as short as the folder list
            values = {r[0] for r in touched.select(self.partition_by).distinct().collect()}
            names = {f"{self.partition_by}={v}" for v in values} | {
                f"{self.partition_by}={quote(v, safe=' ')}" for v in values
            }
            kept = [f for f in folders if f.split("/", 1)[-1] not in names]
            current = current.where(F.col(self.partition_by).isin(sorted(values)))
        else:
            kept = folders if touched.isEmpty() else []
            current = current.where(F.lit(not kept))
        current = current.drop(BUCKET)
        rows = change(current)
        if added is not None:
            rows = rows.unionByName(added(current))
        return self._commit(entry, rows, operation, marks, kept, batch)

    def overwrite(self, df: DataFrame, batch: tuple[str, int] | None = None) -> int:
        return self._commit(self._entry(), df, "write", batch=batch)

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> int:
        entry = self._require()
        types = T.StructType.fromJson(json.loads(entry["row_type"]))
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in types if f.name != BUCKET]
        return self._commit(
            entry, df.select(*columns), "append", {"rows_inserted": F.lit(1)}, entry["folders"], batch,
        )

    def update(self, condition: Column, values: dict[str, Column]) -> int:
        """Set columns where the condition holds; a null condition leaves the row as it is."""

        def change(rows: DataFrame) -> DataFrame:
            hit = F.when(F.coalesce(condition, F.lit(False)), "update").otherwise("keep")
            return set_where(rows.withColumn(MARK, hit), F.col(MARK) == "update", values)

        entry = self._require()
        return self._change(
            entry, self._rows(entry).where(condition), change, "update", {"rows_updated": F.col(MARK) == "update"}
        )

    def delete(self, condition: Column) -> int:
        """Remove rows where the condition holds."""

        def change(rows: DataFrame) -> DataFrame:
            return rows.withColumn(MARK, F.when(F.coalesce(condition, F.lit(False)), "delete").otherwise("keep"))

        entry = self._require()
        return self._change(
            entry, self._rows(entry).where(condition), change, "delete", {"rows_deleted": F.col(MARK) == "delete"}
        )

    def merge(
        self, source: DataFrame, keys: list[str], update: dict[str, Column] | None = None,
        insert: bool = True, batch: tuple[str, int] | None = None, entry: Row | None = None,
    ) -> int:
        """Update matched rows and insert unmatched ones; see `merge_rows`. `entry` is the newest
        history row, if the caller has read it."""
        entry = entry or self._require()
        target = self._rows(entry)
        if self.bucket_by and set(self.bucket_by) <= set(keys):
            touched = source.select(self._bucket(target.schema))
        else:
            touched = target.join(source.select(*keys), keys, "left_semi")

        def added(rows: DataFrame) -> DataFrame:
            # all rows that match are in touched partitions, so the others need not be read
            return unmatched_rows(rows, source, keys).withColumn(MARK, F.lit("insert"))

        return self._change(
            entry,
            touched,
            lambda rows: matched_rows(rows, source, keys, update),
            "merge",
            {"rows_updated": F.col(MARK) == "update", "rows_inserted": F.col(MARK) == "insert"},
            added if insert else None,
            batch,
        )

    def dedupe(self, keys: list[str], order: list[Column]) -> int:
        """Keep one row per key and write the rest away as a new version."""
        entry = self._require()
        return self._commit(entry, first_per_key(self._rows(entry).drop(BUCKET), keys, order), "dedupe")


def set_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Update as a projection: all new values are taken from the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            F.when(hit, values[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c in values
            else F.col(c)
            for c in df.columns
        ]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the least by `order` and then by the remaining columns.

    A minimum is merged map-side, so a key with very many copies sends one row per
    task and not all of its rows to one.
    """
    rest = [c for c in df.columns if c not in keys]
    ranks = [o.alias(f"o{i}") for i, o in enumerate(order)]
    best = F.min(F.struct(*ranks, *[F.col(c).alias(f"v{i}") for i, c in enumerate(rest)]))
    return (
        df.groupBy(*keys)
        .agg(best.alias("best"))
        .select(*keys, *[F.col(f"best.v{i}").alias(c) for i, c in enumerate(rest)])
        .select(*df.columns)
    )


def matched_rows(
    target: DataFrame, source: DataFrame, keys: list[str], update: dict[str, Column] | None = None
) -> DataFrame:
    """Target rows with matched ones updated, marked `update` or `keep`."""
    if update is None:
        update = {c: F.col(f"s.{c}") for c in target.columns if c in source.columns}
    # one row per source key, so the join cannot multiply target rows; a source small
    # enough for Spark to broadcast leaves the target where it is
    extra = [c for c in source.columns if c not in keys]
    s = (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_one"), *extra)).alias("_v"))
        .select(*keys, "_n", *[F.col(f"_v.`{c}`").alias(c) for c in extra])
    )
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = target.alias("t").join(s.alias("s"), on, "left")
    matched = F.col("s._n").isNotNull()
    action = (
        F.when(F.col("s._n") > 1, F.raise_error(F.lit("two source rows match one target row")).cast("string"))
        .when(matched, "update")
        .otherwise("keep")
    )
    columns = [
        F.when(matched, update[c]).otherwise(F.col(f"t.{c}")).cast(target.schema[c].dataType).alias(c)
        if c in update and c not in keys
        else F.col(f"t.{c}")
        for c in target.columns
    ]
    # the filter keeps the action, and with it the error, in the plan
    return joined.select(*columns, action.alias(MARK)).where(F.col(MARK).isNotNull())


def unmatched_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks, in the target's columns, copies included."""
    present = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    return source.join(present, keys, "left_anti").select(
        *[
            (F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )


def merge_rows(
    target: DataFrame, source: DataFrame, keys: list[str], update: dict[str, Column] | None = None,
    insert: bool = True,
) -> DataFrame:
    """Target after a merge with source on keys.

    Matched rows take `update` (columns over `t` and `s`; by default every other
    source column), unmatched source rows are each inserted, copies included. Two
    source rows for one target row is an error, raised by the job. Null keys match
    nothing.
    """
    out = matched_rows(target, source, keys, update).drop(MARK)
    return out.unionByName(unmatched_rows(target, source, keys)) if insert else out


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Merge that only inserts: target plus the source rows whose key it lacks."""
    return target.unionByName(unmatched_rows(target, source, keys))


def replace_group(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert as delete by key and insert: every target row of a key in `rows` goes."""
    kept = target.join(rows.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(rows)
