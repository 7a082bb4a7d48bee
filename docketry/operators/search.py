"""Vector search over chunk tables for whole tables of queries.

Chunks have `collection`, `chunk_id` and `vector`; queries have `query_id` and
`vector`. Hits have query_id, collection, chunk_id, distance and rank.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.operators.predicates import filter_chunks
from docketry.operators.tiles import SquaredDistance, best_pairs

# Default depths and index sizes.
CANDIDATES = 100
RESULTS = 10
CELLS = 64
CELLS_PROBED = 16
MAX_COLLECTIONS = 5
SEARCH_TYPES = ("dense", "hybrid")
VECTOR_BYTES = "size(vector) * 8"


def search_depth(rerank: bool, candidates: int = CANDIDATES, results: int = RESULTS) -> int:
    """How many candidates to fetch: the wide cut if a reranker follows."""
    if candidates <= 0:
        raise ValueError("candidates must be above 0")
    if results > candidates:
        raise ValueError("results must not exceed candidates")
    return candidates if rerank else results


def check_search(search_type: str, collections: list[str], rerank: bool) -> list[str]:
    """Collections to search, or an error for a request that cannot run."""
    if search_type not in SEARCH_TYPES:
        raise ValueError(f"search type must be one of {SEARCH_TYPES}")
    if not collections:
        raise ValueError("no collection given")
    if len(collections) > MAX_COLLECTIONS:
        raise ValueError(f"at most {MAX_COLLECTIONS} collections can be searched at once")
    if len(collections) > 1 and not rerank:
        raise ValueError("several collections need reranking")
    return collections


def _hits(pairs: DataFrame, chunks: DataFrame) -> DataFrame:
    return pairs.select(
        "query_id",
        F.col("grp").cast(chunks.schema["collection"].dataType).alias("collection"),
        F.col("item_id").alias("chunk_id"),
        F.col("score").alias("distance"),
        "rank",
    )


def vector_top_k(
    chunks: DataFrame, queries: DataFrame, k: int = RESULTS, per_collection: bool = True, **bounds
) -> DataFrame:
    """Exact nearest chunks by squared distance, k from each collection (or k over all)."""
    items = chunks.select(
        F.col("chunk_id").alias("item_id"),
        (F.col("collection") if per_collection else F.lit(None)).alias("grp"),
        F.lit("all").alias("route"),
        "vector",
    )
    asked = queries.select("query_id", F.lit("all").alias("route"), "vector")
    pairs = best_pairs(items, asked, SquaredDistance(), k, VECTOR_BYTES, **bounds)
    if per_collection:
        return _hits(pairs, chunks)
    return pairs.select(
        "query_id", F.col("item_id").alias("chunk_id"), F.col("score").alias("distance"), "rank"
    )


def filtered_top_k(
    chunks: DataFrame, queries: DataFrame, spec, fields, k: int = RESULTS,
    prefix: str = "content_metadata", **options,
) -> DataFrame:
    """The metadata filter comes before the cut to k."""
    return vector_top_k(filter_chunks(chunks, spec, fields, prefix), queries, k, **options)


def in_collection_order(hits: DataFrame, order: list[str]) -> DataFrame:
    """Lists of several collections one after the other: adds `position` from 1."""
    place = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("collection"))
    by = Window.partitionBy("query_id").orderBy(place, "rank")
    return hits.where(F.col("collection").isin(order)).withColumn("position", F.row_number().over(by))


@dataclass(frozen=True)
class Cells:
    """Centroids of the cluster lists: at most a few thousand rows, kept on the driver."""

    centroids: np.ndarray
    model: object

    def assign(self, chunks: DataFrame) -> DataFrame:
        return self.model.transform(
            chunks.withColumn("vector_ml", array_to_vector(F.col("vector").cast("array<double>")))
        ).drop("vector_ml")

    def nearest(self, queries: DataFrame, probes: int) -> DataFrame:
        """One row per query and probed cell."""
        centroids = self.centroids
        n = min(probes, len(centroids))

        @F.pandas_udf("array<int>")
        def cells(vectors: pd.Series) -> pd.Series:
            v = np.stack(vectors.to_list()).astype(np.float64)
            d = (v * v).sum(1)[:, None] + (centroids * centroids).sum(1) - 2 * v @ centroids.T
            return pd.Series(list(np.argsort(d, axis=1, kind="stable")[:, :n]))

        return queries.withColumn("cell", F.explode(cells("vector")))


def train_cells(chunks: DataFrame, cells: int = CELLS, seed: int = 42) -> Cells:
    vectors = chunks.select(array_to_vector(F.col("vector").cast("array<double>")).alias("vector_ml"))
    model = KMeans(
        k=cells, seed=seed, featuresCol="vector_ml", predictionCol="cell", maxIter=10
    ).fit(vectors)
    return Cells(np.asarray(model.clusterCenters()), model)


def write_cells(chunks: DataFrame, cells: Cells, path: str) -> None:
    """Chunks laid out by cell: few files for a small cell, many tasks and files for a large one."""
    laid = cells.assign(chunks).repartitionByRange("cell", "chunk_id")
    laid.write.mode("overwrite").option("maxRecordsPerFile", 1_000_000).partitionBy(
        "cell"
    ).parquet(path)


def cell_top_k(
    celled_chunks: DataFrame, queries: DataFrame, cells: Cells, k: int = RESULTS,
    probes: int = CELLS_PROBED, **bounds,
) -> DataFrame:
    """Approximate nearest chunks: each query looks into its nearest cells only.

    Cells that no query probes are not read where the chunks are laid out by cell."""
    probed = cells.nearest(queries.select("query_id", "vector"), probes)
    wanted = [r["cell"] for r in probed.select("cell").distinct().collect()]  # at most one per centroid
    items = celled_chunks.where(F.col("cell").isin(wanted)).select(
        F.col("chunk_id").alias("item_id"),
        F.col("collection").alias("grp"),
        F.col("cell").alias("route"),
        "vector",
    )
    asked = probed.select("query_id", F.col("cell").alias("route"), "vector")
    pairs = best_pairs(items, asked, SquaredDistance(), k, VECTOR_BYTES, **bounds)
    return _hits(pairs, celled_chunks)
