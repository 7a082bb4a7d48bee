"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosine checks.

In each of several tables a vector's bucket is the list of its quantised projections, floor((a x +
b) / w), on random directions. Vectors at cosine 0.9 or more, at most 0.447 apart when normalised,
share a bucket of at least one table with a chance of 95 % at that border and nearly always above
it. Equal vectors are one node with a count. Buckets of more than a tile's rows are cut into parts
that meet pairwise, so no task gets an unbounded bucket and no pair is lost. A task computes exact
cosines in double precision, counts a pair only in the first table in which it shares a bucket, and
returns sums per vector and a forest of the links, so pairs never leave a task one by one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docketry.llm.common import Forest, components, parts_of, picked
from docketry.session import cut_lineage

TABLES, PROJECTIONS, WIDTH, SEED = 32, 12, 2.0, 20_240_501
TILE = 2_048
GROUP_ROWS = 16_384


def directions(size: int, tables: int, projections: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, size])
    return rng.standard_normal((size, tables * projections)), rng.random(tables * projections) * width


def bucket_keys(vectors: np.ndarray, tables: int, projections: int, width: float) -> np.ndarray:
    """A 64-bit number of each normalised vector's bucket in each table, by rows."""
    a, b = directions(vectors.shape[1], tables, projections, width)
    cell = np.floor((vectors @ a + b) / width).astype(np.int64).view(np.uint64).reshape(len(vectors), tables, projections)
    key = np.broadcast_to(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(vectors.shape[1]), cell.shape[:2]).copy()
    for p in range(projections):
        key = (key ^ cell[:, :, p]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key


def normalised(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def keyed(classes: DataFrame, tables: int, projections: int, width: float) -> DataFrame:
    """(cls, keys) of classes (cls, vector)."""

    def run(batches):
        for b in batches:
            vectors = b.column(1).to_pylist()
            out: list = [None] * len(vectors)
            for size in {len(v) for v in vectors}:
                at = [k for k, v in enumerate(vectors) if len(v) == size]
                keys = bucket_keys(normalised([vectors[k] for k in at]), tables, projections, width).view(np.int64)
                for k, row in zip(at, keys.tolist(), strict=True):
                    out[k] = row
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64()))], ["cls", "keys"])

    return classes.select("cls", "vector").mapInArrow(run, "cls long, keys array<long>")


def compare_group(table: pa.Table, least: float, tables: int, projections: int, width: float) -> pa.Table:
    """Links within the buckets of one group: role 0 rows meet role 1 rows, role 2 rows one another."""
    ids, first, place = np.unique(table["cls"].to_numpy(), return_index=True, return_inverse=True)
    nodes, weight = table["node"].to_numpy()[first], table["many"].to_numpy()[first]
    vectors = table["vector"].to_pylist()
    size = np.array([len(vectors[k]) for k in first])
    x = np.zeros((len(ids), size.max()))
    for s in np.unique(size):
        mine = np.flatnonzero(size == s)
        x[mine, :s] = normalised([vectors[first[k]] for k in mine])
    forest, add = Forest(len(ids)), np.zeros(len(ids), np.int64)
    part, bucket, role, which = (table[c].to_numpy() for c in ("part", "bucket", "role", "tab"))
    order = np.lexsort((role, part, bucket))
    part, bucket, role, place, which = part[order], bucket[order], role[order], place[order], which[order]
    new = np.ones(len(order), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])
    start = np.flatnonzero(new)
    for a, z in zip(start, np.r_[start[1:], len(order)], strict=True):
        own = place[a:z]
        left, right = (own, own) if role[a] == 2 else (own[role[a:z] == 0], own[role[a:z] == 1])
        if not len(left) or not len(right) or role[a] == 2 and z - a < 2:
            continue
        i, j = np.nonzero(x[left] @ x[right].T >= least - 1e-9)
        i, j = left[i], right[j]
        ok = i < j if role[a] == 2 else i != j
        i, j = i[ok], j[ok]
        for at in range(0, len(i), 65_536):
            p, q = i[at : at + 65_536], j[at : at + 65_536]
            keep = (size[p] == size[q]) & (np.einsum("ij,ij->i", x[p], x[q]) >= least)
            p, q = p[keep], q[keep]
            if not len(p):
                continue
            forest.add(p, q)
            if which[a]:  # a pair that shares an earlier table's bucket was counted there
                some, back = np.unique(np.r_[p, q], return_inverse=True)
                keys = np.concatenate([bucket_keys(x[some[k : k + 1024], : size[some[0]]], tables, projections, width)[:, : which[a]] for k in range(0, len(some), 1024)])
                fresh = ~(keys[back[: len(p)]] == keys[back[len(p) :]]).any(axis=1)
                p, q = p[fresh], q[fresh]
            np.add.at(add, p, weight[q])
            np.add.at(add, q, weight[p])
    a, b = forest.links()
    hit = np.flatnonzero(add)
    return pa.table({"a": np.r_[nodes[a], ids[hit]], "b": np.r_[nodes[b], add[hit]], "link": np.r_[np.ones(len(a), bool), np.zeros(len(hit), bool)]})


def near_vectors(rows: DataFrame, least: float = 0.9, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of rows (vec_id, embedding).

    A link is a pair of rows whose vectors have a cosine of `least` or more; copies of a vector are
    linked to one another. n_links counts the other rows linked directly, component_id is the
    smallest vec_id reached, kept says that it is the row's own. A vector that is null, empty or
    zero, or has a null or non-finite component, links with nothing, nor do vectors of different
    sizes. Rows with one vec_id are one item, so what they link to is one component. A row without
    vec_id links with nothing and has no component_id; it is kept. Repeated
    rows are copies. No rows give no rows; other columns are not read."""
    given = picked(rows, "vec_id", "embedding").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    good = given.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    classed = good.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("many"))
    classes = cut_lineage(classed.withColumn("cls", F.monotonically_increasing_id()))
    placed = cut_lineage(keyed(classes, tables, projections, width).select("cls", F.posexplode("keys").alias("tab", "bucket")))
    sizes = placed.groupBy("tab", "bucket").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("tab"), F.bitwise_not(F.bitwise_not("bucket")).alias("bucket"), "n"
    )
    total = placed.count()
    groups = parts_of(total, GROUP_ROWS, 64)
    parts = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64("cls"), "parts").cast("int")
    met = (
        placed.join(sizes, ["tab", "bucket"]).withColumn("parts", parts).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "cls", "tab", "bucket",
            (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).alias("part"),
            F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("role"),
        )
        .withColumn("group", F.pmod(F.xxhash64("tab", "bucket", "part"), F.lit(groups)))
    )
    found = cut_lineage(
        met.join(classes, "cls").groupBy("group").applyInArrow(
            lambda t: compare_group(t, least, tables, projections, width), "a long, b long, link boolean"
        )
    )
    linked = components(found.where("link").select("a", "b")).select(F.col("node").alias("of"), "root")
    counted = found.where("not link").groupBy(F.col("a").alias("counted")).agg(F.sum("b").alias("others"))
    named = (
        classes.join(linked, classes.node == linked.of, "left").join(counted, classes.cls == F.col("counted"), "left")
        .select(
            F.col("vector").alias("class"),
            (F.coalesce("others", F.lit(0)) + F.col("many") - 1).alias("links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    able = usable(given.vector) & given.vec_id.isNotNull()
    return given.join(named, able & (given.vector == F.col("class")), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
