"""Ranked lexical search by bit-sliced Bloom signatures, with exact rescoring.

The index has, for blocks of documents with about as many terms, a matrix of bits: a column is a
document's Bloom signature, a row (slice) says for one bit which documents of the block have it. The
and of a term's few slices marks all documents with the term and a few more. Terms that occur 2, 3, 4,
6, 9 times or more are in the signature again under those counts, so the slices also bound how often.
Besides, the index has each document's number of terms and highest count, and in how many documents
of a part each term occurs.

For an item, the sum over the tiers of (weighted slice sum) x (what the tier adds to a term's share) is
an upper bound of a document's score, since every mark can only be too many. The documents with the
highest bounds are rescored from their texts; the k-th of their exact scores is a bound from below.
A document whose upper bound is less is excluded for certain; all others are rescored from their
texts. So the result is that of scoring every document, whatever the signatures mark in vain.

The index is written to the shared folder and read block by block; no task holds more than a block and
the items of one block of items."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docketry.llm.common import picked
from docketry.session import cut_lineage, work_path

#: A term's characters are ASCII letters, digits and all that is not ASCII.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Counts from which on a term is in the signature again; a share is bounded by that of the next one.
TIERS = np.array([1, 2, 3, 4, 6, 9, 14, 22, 36, 60, 100, 200, 500])
#: Slices of a term, the least bits of a signature for one of its entries, and for all.
SLICES, BITS, LEAST_BITS = 3, 12, 512
#: Documents of a block, at least 8 and no more than make so many bits.
BLOCK, MOST_BITS = 1_024, 1 << 23
#: Terms whose names a task remembers, and whose counts it holds before it sends them.
MOST_TERMS = 300_000
#: Bytes of item texts that are searched for at once; more are taken in blocks.
ITEM_BYTES = 4 << 20
#: Documents to rescore that are broadcast as a list of names and items.
MOST_BROADCAST = 500_000
_INDEX = "bits long, keys array<long>, n array<long>, top array<long>, slices binary, terms array<binary>, counts array<long>"
_INDEX_TYPES = pa.schema([("bits", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("keys", "n", "top")), ("slices", pa.binary()), ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


def places(names: np.ndarray, tier: int, bits: int) -> np.ndarray:
    """The slices of each term under a tier, by columns."""
    x = (names ^ np.uint64(0x9E3779B97F4A7C15 * (tier + 1) % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    step = (x >> np.uint64(33)) | np.uint64(1)
    return ((x[None, :] + np.arange(SLICES, dtype=np.uint64)[:, None] * step[None, :]) & np.uint64(bits - 1)).astype(np.int64)


class Names:
    """64-bit names of terms."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, terms) -> np.ndarray:
        known, out = self.known, []
        if len(known) > MOST_TERMS:
            known.clear()
        for t in terms:
            name = known.get(t)
            if name is None:
                name = known[t] = xxhash.xxh64_intdigest(t)
            out.append(name)
        return np.array(out, np.uint64)


class Builder:
    """Signatures of the documents given so far, gathered by their size."""

    def __init__(self):
        self.names, self.held, self.seen = Names(), {}, Counter()

    def add(self, key: int, text: str | None) -> Iterator[tuple]:
        words = terms_of(text)
        if not words:
            return
        counts = Counter(words)
        self.seen.update(counts.keys())
        many = np.fromiter(counts.values(), np.int64, len(counts))
        tiers = np.searchsorted(TIERS, many, side="right")
        bits = max(LEAST_BITS, 1 << (int(tiers.sum()) * BITS - 1).bit_length())
        own = self.held.setdefault(bits, [])
        own.append((key, len(words), int(many.max()), self.names.of(counts), tiers))
        if len(own) >= max(8, min(BLOCK, MOST_BITS // bits)):
            yield self.block(bits)
        if len(self.seen) > MOST_TERMS:
            yield self.counts()

    def block(self, bits: int) -> tuple:
        key, n, top, names, tiers = zip(*self.held.pop(bits), strict=True)
        at = np.repeat(np.arange(len(key)), [len(x) for x in names])
        names, tiers = np.concatenate(names), np.concatenate(tiers)
        marks = np.zeros((bits, -(-len(key) // 8) * 8), np.uint8)
        for tier in range(len(TIERS)):
            own = np.flatnonzero(tiers > tier)
            for row in places(names[own], tier, bits):
                marks[row, at[own]] = 1
        return bits, key, n, top, np.packbits(marks, axis=1).tobytes(), None, None

    def counts(self) -> tuple:
        seen, self.seen = self.seen, Counter()
        return None, None, None, None, None, list(seen), list(seen.values())

    def rest(self) -> Iterator[tuple]:
        for bits in list(self.held):
            yield self.block(bits)
        if self.seen:
            yield self.counts()


def with_key(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key); rows with one key are the same to the search until they are rescored."""
    given = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.withColumn("key", F.xxhash64("doc_id", "text"))


def written_index(docs: DataFrame) -> DataFrame:
    """The index of docs (doc_id, text), written to a new folder in the shared one."""

    def run(batches):
        builder = Builder()
        row = lambda r: pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(r, _INDEX_TYPES, strict=True)], schema=_INDEX_TYPES)
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                yield from map(row, builder.add(key, text.as_py()))
        yield from map(row, builder.rest())

    path = work_path(docs.sparkSession, "lexical-index")
    with_key(docs).select("key", "text").mapInArrow(run, _INDEX).write.parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


def norm(n: int, docs: int, total: int) -> int:
    """What the length of a document with n terms counts, 100 for the mean."""
    return 100 - 50 + (50 * n * docs) // total


def share(count, length):
    """A term's share by its count in a document, in millionths; grows with the count."""
    return (1_000_000_000 * count) // (1_000 * count + 20 * length)


class Items:
    """Items of a block: terms with weights above 0, as rows into the list of all their terms."""

    def __init__(self, items: list[tuple], docs: int, total: int):
        """items are (item_id, [(term, weight)])."""
        self.docs, self.total = docs, total
        self.ids = [i for i, _ in items]
        self.terms = [dict(t) for _, t in items]
        every = sorted({t for own in self.terms for t in own})
        row = {t: k for k, t in enumerate(every)}
        self.names = Names().of(every)
        self.rows = [np.array([row[t] for t in own], np.int64) for own in self.terms]
        self.weights = [np.array(list(own.values()), np.float64) for own in self.terms]

    def bounds(self, bits: int, n: list[int], top: list[int], slices: bytes) -> np.ndarray:
        """Upper bounds of the scores of a block's documents, by items and documents."""
        length = np.array([norm(x, self.docs, self.total) for x in n], np.int64)
        highest = np.array(top, np.int64)
        marks = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        out = np.zeros((len(self.ids), len(n)), np.int64)
        have, before = None, np.zeros(len(n), np.int64)
        for tier in range(len(TIERS)):
            if tier and not (highest >= TIERS[tier]).any():
                break
            have = self.having(marks, tier, bits, have)
            if not have.any():
                break
            most = highest if tier == len(TIERS) - 1 else np.minimum(TIERS[tier + 1] - 1, highest)
            reached = share(most, length)
            adds, before = np.maximum(reached - before, 0), np.maximum(reached, before)
            some = have.any(axis=1)
            for k, (rows, weights) in enumerate(zip(self.rows, self.weights, strict=True)):
                own = some[rows]
                if own.any():
                    on = np.unpackbits(have[rows[own]], axis=1, count=len(n))
                    out[k] += (weights[own] @ on).astype(np.int64) * adds
        return out

    def having(self, marks: np.ndarray, tier: int, bits: int, before: np.ndarray | None) -> np.ndarray:
        """By terms, packed: the documents that may have the term as often as the tier says."""
        out = np.zeros((len(self.names), marks.shape[1]), np.uint8)
        rows = np.arange(len(self.names)) if before is None else np.flatnonzero(before.any(axis=1))
        for at in range(0, len(rows), 4_096):
            some = rows[at : at + 4_096]
            first, *more = places(self.names[some], tier, bits)
            found = marks[first]
            for place in more:
                found &= marks[place]
            out[some] = found if before is None else found & before[some]
        return out

    def score(self, item: int, counts: Counter, length: int) -> int:
        return sum(w * share(counts[t], length) for t, w in self.terms[item].items() if t in counts)


def highest_bounds(index: DataFrame, shared, most: int) -> DataFrame:
    """(item, key, bound): of each item the documents of each part with the highest bounds."""

    def run(batches):
        items: Items = shared.value
        keys, bounds = [np.empty(0, np.int64)] * len(items.ids), [np.empty(0, np.int64)] * len(items.ids)
        for key, found in blocks(batches, items):
            for k in np.flatnonzero(found.any(axis=1)):
                bound, own = np.r_[bounds[k], found[k]], np.r_[keys[k], key]
                if len(bound) > most:
                    best = np.argpartition(-bound, most)[:most]
                    bound, own = bound[best], own[best]
                bounds[k], keys[k] = bound[bound > 0], own[bound > 0]
        item = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
        flat = [np.concatenate([np.empty(0, np.int64), *x]) for x in (keys, bounds)]
        for at in range(0, len(item), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 10_000], pa.int64()) for x in (item, *flat)], ["item", "key", "bound"])

    sent = index.where("bits is not null").select("bits", "keys", "n", "top", "slices").mapInArrow(run, "item long, key long, bound long")
    order = Window.partitionBy("item").orderBy(F.col("bound").desc(), "key")
    return sent.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).select("item", "key")


def not_excluded(index: DataFrame, shared, least) -> DataFrame:
    """(item, key) of all documents whose bound is not below the item's least."""

    def run(batches):
        items, low = shared.value, least.value
        for key, found in blocks(batches, items):
            item, doc = np.nonzero(found >= low[:, None])
            for at in range(0, len(item), 100_000):
                some = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(item[some], pa.int64()), pa.array(key[doc[some]], pa.int64())], ["item", "key"])

    return index.where("bits is not null").select("bits", "keys", "n", "top", "slices").mapInArrow(run, "item long, key long")


def blocks(batches, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in batches:
        for i in range(b.num_rows):
            bits, keys, n, top, slices = (b.column(c)[i] for c in range(5))
            yield keys.values.to_numpy(), items.bounds(bits.as_py(), n.as_py(), top.as_py(), slices.as_py())


def rescored(docs: DataFrame, wanted: DataFrame, shared) -> DataFrame:
    """(item, item_id, doc_id, score) of the documents and items of wanted (item, key), scores above 0."""
    listed = cut_lineage(wanted.groupBy("key").agg(F.collect_set("item").alias("items")))
    # a name and its items are a few bytes: below this many pairs the list is small enough for all
    pairs = listed.agg(F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("n")).first()["n"]
    listed = F.broadcast(listed) if pairs <= MOST_BROADCAST else listed

    def run(batches):
        items: Items = shared.value
        for b in batches:
            out = []
            for doc, text, some in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                words = terms_of(text.as_py())
                counts, length = Counter(words), norm(len(words), items.docs, items.total)
                scores = ((k, items.score(k, counts, length)) for k in some)
                out += [(k, items.ids[k], doc, s) for k, s in scores if s > 0]
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["item", "item_id", "doc_id", "score"])

    return with_key(docs).join(listed, "key").select("doc_id", "text", "items").mapInArrow(run, "item long, item_id long, doc_id long, score long")


def weighted(index: DataFrame, items: list[tuple], docs: int, total: int) -> Items:
    """The items' terms with the weights that all documents of the index give them."""
    spark = index.sparkSession
    own = [(i, sorted(set(terms_of(text)))) for i, text in items]
    every = spark.createDataFrame([(t,) for t in sorted({t for _, ts in own for t in ts})], "term binary")
    listed = index.where("terms is not null").select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    counted = listed.select(F.col("x.terms").alias("term"), F.col("x.counts").alias("n")).join(F.broadcast(every), "term").groupBy("term").agg(F.sum("n").alias("n"))
    weight = {bytes(r["term"]): math.floor(1000 * math.log((2 * docs + 2) / (2 * r["n"] + 1))) for r in counted.collect()}
    return Items([(i, [(t, weight[t]) for t in ts if weight.get(t, 0) > 0]) for i, ts in own], docs, total)


def searched(spark: SparkSession, index: DataFrame, docs: DataFrame, items: Items, most: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of the items of one block."""
    shared = spark.sparkContext.broadcast(items)
    # twice as many, since some of the highest bounds may be of documents that hardly match
    likely = rescored(docs, highest_bounds(index, shared, 2 * most), shared)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    kth = likely.withColumn("r", F.row_number().over(order)).where(F.col("r") == most).select("item", "score").collect()
    least = np.ones(len(items.ids), np.int64)  # a score above 0
    for r in kth:
        least[r["item"]] = r["score"]
    found = rescored(docs, not_excluded(index, shared, spark.sparkContext.broadcast(least)), shared)
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, most: int = 50, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of items (item_id, text) its best rows of docs (doc_id, text).

    Terms are the longest runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower
    case. N documents have a term, L terms in all; a document has n. A term in df of them weighs
    floor(1000 ln((2N+2)/(2df+1))), and with tf occurrences in a document adds its weight times (10**9 tf) div
    (1000 tf + 20 m), m being 50 + (50 n N) div L. An item's terms count once each. The `most` highest
    scores above 0 are ranked from 1, equal ones by rising doc_id, a null one last.

    A null text has no terms; it is neither found nor counted. Every row of docs is a document of its
    own, every row of items an item of its own, also if repeated; null ids stay null. Items without
    terms, no items or no documents give no rows; other columns are not read. The distinct terms of a
    block of items (4 MB of text) are held by the driver and each task; the documents are in the
    index once, whatever the number of blocks."""
    spark = docs.sparkSession
    index = written_index(docs)
    n = index.where("bits is not null").agg(F.sum(F.size("n")).alias("docs"), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total")).first()
    given = picked(items, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    held = given.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    parts, result = max(1, -(-held // item_bytes)), None
    for part in range(parts if n["docs"] else 0):
        some = given if parts == 1 else given.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        rows = [(r["item_id"], r["text"]) for r in some.orderBy("item_id", "text").collect()]
        if rows:
            found = searched(spark, index, docs, weighted(index, rows, n["docs"], n["total"]), most)
            result = found if result is None else result.unionAll(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if result is None else result
