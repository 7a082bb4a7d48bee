"""Benchmark items inside documents, by size-partitioned MinHash and exact shingle containment.

Items are partitioned by their number of shingles, each partition up to twice its lower bound. For
a partition, documents are cut into overlapping windows of twice the upper bound of its items (a
shorter document is one window), so an item is compared with texts of about its own size and the
Jaccard similarity that the containment threshold asks for stays high, however long a document is.
A window and an item that agree in one of the MinHash values are candidates. Besides, each value of
an item's signature comes from one of its shingles; a document that holds enough of those anywhere is
a candidate too, which covers items whose shingles lie scattered. A candidate counts if the share of
the item's distinct shingles that the whole document has reaches the threshold.

The permutations are one-to-one, so a window and an item agree in a value only through a shingle that
the signatures come from. A document without any such shingle has no candidate and is left out before
its windows are looked at."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import picked
from docketry.session import cut_lineage

HASHES = 32
#: Bytes of item texts that are broadcast at once; more are compared in blocks, one scan each.
BLOCK_BYTES = 8 << 20
#: Shingles of a document that are looked at together.
SEGMENT = 1 << 16
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every word shingle, A-Z lower-cased, in order; none if there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < size:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    one = xxhash.xxh64_intdigest
    return np.array([one(joined[a : b - 1]) for a, b in zip([0, *ends], ends[size - 1 :], strict=False)], np.uint64)


def permuted(hashes: np.ndarray) -> np.ndarray:
    """The hashes under each of the permutations, by rows."""
    x = (hashes ^ (hashes >> np.uint64(31)))[None, :] * _SEEDS[:, None]
    x ^= x >> np.uint64(29)
    return x


@dataclass
class Items:
    """Items of one block: distinct shingles of each, by size partition the length of its windows and
    the signature values in order with their items, and the shingles behind the signatures, with
    their items in order of the shingle and as a set."""

    ids: list
    own: list[np.ndarray]
    partitions: list[tuple[int, np.ndarray, np.ndarray]]
    signed: np.ndarray
    signed_by: np.ndarray
    many: np.ndarray
    known: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, np.ndarray]]) -> "Items":
        ids, own = [r[0] for r in rows], [np.unique(r[1]) for r in rows]
        power = np.array([len(x).bit_length() for x in own], int)
        mixed = [permuted(x) for x in own]
        partitions = []
        for p in np.unique(power):
            mine = np.flatnonzero(power == p)
            value, by = np.concatenate([mixed[i].min(axis=1) for i in mine]), np.repeat(mine, HASHES)
            order = np.argsort(value, kind="stable")
            partitions.append((2 << int(p), value[order], by[order]))
        signed = [np.unique(x[m.argmin(axis=1)]) for x, m in zip(own, mixed, strict=True)]
        many = np.array([len(x) for x in signed], int)
        shingle, by = np.concatenate(signed or [np.empty(0, np.uint64)]), np.repeat(np.arange(len(ids)), many)
        order = np.argsort(shingle, kind="stable")
        return cls(ids, own, partitions, shingle[order], by[order], many, np.unique(shingle))

    def touched_by(self, grams: np.ndarray) -> bool:
        """Whether any of the shingles is behind a signature."""
        at = np.searchsorted(self.known, grams)
        at[at == len(self.known)] = 0
        return bool((self.known[at] == grams).any())


def window_least(values: np.ndarray, size: int) -> np.ndarray:
    """By rows, the least in windows of `size` that start at every half of it and reach the end."""
    if values.shape[1] <= size:
        return values.min(axis=1, keepdims=True)
    least = np.minimum.reduceat(values, np.arange(0, values.shape[1], size // 2), axis=1)
    return np.minimum(least[:, :-1], least[:, 1:])


def candidates(grams: np.ndarray, have: np.ndarray, items: Items) -> np.ndarray:
    """Numbers of the items that agree with a window of the shingles in a MinHash value, or of whose
    signature's shingles half are in the document."""
    out = []
    longest = max(size for size, _, _ in items.partitions)
    for at in range(0, max(1, len(grams) - longest // 2), SEGMENT):
        mixed = permuted(grams[at : at + SEGMENT + longest])
        for size, value, by in items.partitions:
            mins = window_least(mixed, size).ravel()
            a, b = np.searchsorted(value, mins), np.searchsorted(value, mins, side="right")
            out += [by[x:z] for x, z in set(zip(a[a < b].tolist(), b[a < b].tolist(), strict=True))]
    found = np.bincount(items.signed_by[np.isin(items.signed, have)], minlength=len(items.ids))
    out.append(np.flatnonzero(2 * found >= items.many))
    return np.unique(np.concatenate(out))


def contained(docs: DataFrame, items: DataFrame, size: int = 5, least: float = 0.8, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every document that holds an item.

    docs are (doc_id, text), items (item_id, text). Held is an item of which the share `least` of its
    distinct shingles of `size` words is in the whole document. Items with fewer words have no
    shingle and are in none. Null texts are empty; null ids stay null. Repeated rows of documents
    give repeated results, repeated items too. No rows on either side give no rows; other columns
    are not read. Items are broadcast in blocks of bounded size, with one scan of the documents
    for each, so neither side is capped."""
    spark = docs.sparkSession
    given = picked(items, "item_id", "text").select(F.col("item_id").cast("long"), F.col("text")).where("text is not null").withColumn("n", F.octet_length("text").cast("long"))
    total = given.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_bytes))
    result = None
    for block in range(blocks):
        some = given if blocks == 1 else given.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = [(r["item_id"], shingles(r["text"], size)) for r in some.orderBy("item_id", "text").collect()]
        shared = spark.sparkContext.broadcast([r for r in rows if len(r[1])])
        found = in_block(docs, shared, size, least)
        if blocks > 1:  # one block of items at a time is held by the executors
            found = cut_lineage(found)
            shared.unpersist()
        result = found if result is None else result.unionAll(found)
    return result


def in_block(docs: DataFrame, shared, size: int, least: float) -> DataFrame:
    names = ["doc_id", "item_id", "n_shingles", "n_shared", "containment"]

    def run(batches):
        items = Items.of(shared.value)
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                grams = shingles(text, size)
                if not len(grams) or not items.ids or not items.touched_by(grams):
                    continue
                have = np.unique(grams)
                for i in candidates(grams, have, items).tolist():
                    n, hit = len(items.own[i]), int(np.isin(items.own[i], have, assume_unique=True).sum())
                    if hit >= least * n:
                        out.append((doc, items.ids[i], n, hit, hit / n))
            cols = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, cols), [pa.int64()] * 4 + [pa.float64()], strict=True)], names)

    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_shared long, containment double")
