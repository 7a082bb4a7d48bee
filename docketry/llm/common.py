"""What several of the operators share: sizes of inputs, union of linked rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from docketry.session import cut_lineage

#: Sorts after every document number; stands for a null one.
LAST = (1 << 63) - 1


def by_place(df: DataFrame) -> DataFrame:
    """The same columns, named by their places."""
    return df.toDF(*map(str, range(len(df.columns))))


def picked(df: DataFrame, *names: str) -> DataFrame:
    """The columns of just these names. Others are left out, also those whose names differ in case
    only, which a plain select finds ambiguous. Without an exact match the case does not matter."""
    places = [df.columns.index(n) if n in df.columns else [c.lower() for c in df.columns].index(n.lower()) for n in names]
    return by_place(df).select(*[F.col(str(k)).alias(n) for k, n in zip(places, names, strict=True)])


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts, null ones counting nothing."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("n")).first()["n"]


def parts_of(total: int, each: int, least: int) -> int:
    """How many parts of about `each` there are in `total`, `least` at least."""
    return max(least, -(-total // each))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of the numbers 0..n-1 that each of them reaches over the links a-b."""
    p = np.arange(n)
    while len(a):
        ra, rb = p[a], p[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        open_ = low != high
        if not open_.any():
            break
        np.minimum.at(p, high[open_], low[open_])
        while True:
            q = p[p]
            if (q == p).all():
                break
            p = q
    return p


class Forest:
    """Links found so far within one task, kept as one link per reached node at most.

    However many links there are between n nodes, at most n - 1 leave the task."""

    def __init__(self, n: int, most: int = 1_000_000):
        self.n, self.most, self.held = n, most, 0
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.held += len(a)
            if self.held > self.most:
                a, b = self.links()
                self.a, self.b, self.held = [a], [b], 0

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        p = roots(self.n, np.concatenate(self.a), np.concatenate(self.b))
        node = np.flatnonzero(p != np.arange(self.n))
        return p[node], node


def apart(key: str) -> Column:
    """The same number as an expression, so that a join after an aggregate on it gets a shuffle of
    its own: adaptive execution splits skewed partitions of such a join only."""
    return F.bitwise_not(F.bitwise_not(F.col(key)))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest node it reaches.

    Alternates two steps until nothing changes: every node hangs its larger neighbours, then its
    smaller ones, under its smallest neighbour. A step is one minimum per node, merged map-side, and
    one join, in which adaptive execution splits a node with very many links. Each round is
    checkpointed; the driver sees a count and a checksum. Nodes without links are not in the result;
    null ends and links of a node to itself are left out."""
    pair = links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct()
    pair, seen = cut_lineage(pair), None
    for _ in range(rounds):
        both = pair.unionAll(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(apart("u").alias("u"), "m")
        star = (
            both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v")
            .unionAll(least.where("m < u").select(F.col("m").alias("u"), F.col("u").alias("v")))
            .where("u < v").distinct()
        )
        least = star.groupBy("v").agg(F.min("u").alias("m")).select(apart("v").alias("v"), "m")
        hung = (
            star.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
            .unionAll(least.select(F.col("m").alias("u"), "v"))
            .where("u < v").distinct()
        )
        pair = cut_lineage(hung)
        now = pair.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pair.select(F.col("v").alias("node"), F.col("u").alias("root")).unionAll(pair.select("u", "u").distinct().toDF("node", "root"))
