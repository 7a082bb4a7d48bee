"""Keyword search over a written index of postings in blocks with upper bounds.

Chunks are dealt into segments by a hash, so all postings of a chunk lie in one. The index has, by
segment, term and collection, blocks of postings (chunk, count, length), each with the highest count and
the least length in it, from which follows the most that a posting of the block can score, for any k1 and
b. Postings of a frequent term are put into blocks by levels of what they score, so the bounds of most of
them are low.

A search reads the blocks' bounds of its terms first. The best blocks of each term give scores from
below, and the k-th of these a threshold. Then a query's levels are skipped from the lowest bound up, as
long as the bounds of its terms' skipped levels together stay under the threshold: a chunk that is in
skipped levels only cannot be among the best. The blocks of the other levels move once, to the task of
their segment, and so do the chunks' terms that any query asks for. There they are summed per chunk, and
chunks that could not reach the threshold, or the k-th sum of the segment, with all that was skipped are
left out. The rest, a few per query, are scored from their terms, and the best k leave the task. So the
result is that of scoring every chunk, no row is made per query and posting, and what a search moves
follows the terms asked for and not the number of queries."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.functions.rows import exploded
from docketry.functions.text import tokens
from docketry.operators.keyword import B, K1, query_terms, split_chunks
from docketry.session import cut_lineage

#: Postings of a block at most, or nearly so.
BLOCK = 1_024
#: A term's postings in a segment that are one block, whatever they score.
FEW = 32
#: Levels of score that the postings of a frequent term are dealt into.
LEVELS = 16
FOLDERS = 64
#: Words of the chunks for each segment, and for each of the first sixteen.
PIECE = 6_000_000
LEAST_PIECE = 200_000
#: Blocks of a term, at most, that give the threshold.
BEST_BLOCKS = 32
#: Rows of terms or levels that are broadcast; of more, queries are dealt into parts.
SMALL_ROWS = 2_000_000
#: Room for the rounding of sums that are compared with a bound.
SLACK = 1e-9
_LEVEL = ["collection", "term", "level"]
_BLOCK_ID = ["segment", *_LEVEL, "part"]


@dataclass(frozen=True)
class PostingIndex:
    """`blocks` has folder, segment, term, collection, level, part, n, max_tf, min_len and the postings; `terms`
    has collection, chunk_id, doc_len, terms, tfs; `totals` has collection, n_docs, mean_len."""

    blocks: DataFrame
    terms: DataFrame
    totals: DataFrame


def _share(tf: Column, length: Column, mean: Column, k1: float, b: float) -> Column:
    """What a posting adds to a score per unit of its term's weight; grows with tf, falls with length."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))


def _folder(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(FOLDERS)).cast("int")


def write_postings(chunks: DataFrame, path: str, tokenize=tokens, block: int = BLOCK) -> PostingIndex:
    """Write the index of chunks (collection, chunk_id, text).

    A term in a third of all chunks is dealt into as many blocks as it needs, so no group is large."""
    spark = chunks.sparkSession
    split_chunks(chunks, tokenize).write.mode("overwrite").parquet(f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    terms.groupBy("collection").agg(F.count("*").alias("n_docs"), F.avg("doc_len").alias("mean_len")).write.mode("overwrite").parquet(f"{path}/totals")
    totals = spark.read.parquet(f"{path}/totals")
    segments = _segments(totals)
    # chunks move once, with their terms as lists; all that follows stays in the segment's task
    dealt = _alone(terms).withColumn("segment", _segment(segments)).repartition(2 * segments, "segment")
    placed = _postings(dealt).join(F.broadcast(totals), "collection")
    share = _share(F.col("tf"), F.col("doc_len"), F.col("mean_len"), K1, B) / (K1 + 1)
    placed = placed.withColumn("own", F.floor(share * LEVELS).cast("int"))
    of_term = Window.partitionBy("segment", "collection", "term")
    placed = placed.withColumns({"df": F.count("*").over(of_term), "top": F.max("own").over(of_term)})
    frequent = F.col("df") > min(FEW, block)
    placed = placed.withColumns({
        "level": F.when(frequent, F.col("own")).otherwise(F.col("top")),
        "part": F.when(frequent, F.pmod(F.xxhash64("chunk_id"), F.ceil(F.col("df") / block))).otherwise(0).cast("int"),
    })
    blocks = placed.groupBy(*_BLOCK_ID).agg(
        F.count("*").alias("n"), F.max("tf").alias("max_tf"), F.min("doc_len").alias("min_len"), F.collect_list(F.struct("chunk_id", "tf", "doc_len", "alone")).alias("postings")
    )
    blocks = blocks.withColumn("folder", _folder(F.col("term")))
    blocks.sortWithinPartitions("folder", "term").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/blocks")
    return read_postings(spark, path)


def _segments(totals: DataFrame) -> int:
    words = totals.agg(F.sum(F.round(F.col("n_docs") * F.col("mean_len")).cast("long"))).first()[0] or 0
    return 1 + max(words // PIECE, min(words // LEAST_PIECE, 16))


def _segment(segments: int) -> Column:
    return F.pmod(F.xxhash64("collection", "chunk_id"), F.lit(segments)).cast("int")


def _alone(terms: DataFrame) -> DataFrame:
    """Whether no other row has a chunk's collection and chunk_id."""
    several = cut_lineage(terms.groupBy("collection", "chunk_id").count().where("count > 1").drop("count"))
    if several.isEmpty():
        return terms.withColumn("alone", F.lit(True))
    several = several.select(F.col("collection").alias("its_collection"), F.col("chunk_id").alias("its_chunk"), F.lit(False).alias("alone"))
    same = F.col("collection").eqNullSafe(F.col("its_collection")) & F.col("chunk_id").eqNullSafe(F.col("its_chunk"))
    return terms.join(several, same, "left").select(*terms.columns, F.coalesce("alone", F.lit(True)).alias("alone"))


def _postings(terms: DataFrame) -> DataFrame:
    """(collection, term, chunk_id, tf, doc_len), and segment and alone if there are, from a chunk's row
    where it lies. Rows that share their collection and chunk_id lie in one segment and have one posting a
    term; with the sum of counts and the least length it bounds what each of them scores."""
    own = [c for c in terms.columns if c in ("segment", "alone")]
    found = exploded(terms.select(*own, "collection", "chunk_id", "doc_len", F.arrays_zip("terms", "tfs").alias("each")), "each", "x")
    found = found.select(*own, "collection", F.col("x.terms").alias("term"), "chunk_id", F.col("x.tfs").alias("tf"), "doc_len")
    several = terms.where("not alone") if "alone" in own else terms.groupBy("collection", "chunk_id").count().where("count > 1")
    if several.isEmpty():
        return found
    return found.groupBy(*own, "collection", "term", "chunk_id").agg(F.sum("tf").cast("int").alias("tf"), F.min("doc_len").alias("doc_len"))


def read_postings(spark: SparkSession, path: str) -> PostingIndex:
    return PostingIndex(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/totals"))


def _asked_blocks(index: PostingIndex, asked: DataFrame) -> DataFrame:
    """Blocks of the query terms. The terms are few beside the index, so the join reads by folder and
    keeps the index where it is."""
    wanted = asked.select("term").distinct()
    folders = wanted.groupBy(_folder(F.col("term")).alias("folder")).count().collect()  # FOLDERS at most
    few = sum(r["count"] for r in folders) <= SMALL_ROWS
    return index.blocks.where(F.col("folder").isin([r["folder"] for r in folders])).join(F.broadcast(wanted) if few else wanted, "term", "left_semi")


def _small(rows: DataFrame) -> DataFrame:
    """The rows, to be broadcast if they are few; Spark does not know their number beforehand."""
    held = cut_lineage(rows)
    return F.broadcast(held) if held.count() <= SMALL_ROWS else held


def _kth(scored: DataFrame, k: int, name: str) -> DataFrame:
    order = Window.partitionBy("query_id", "collection").orderBy(F.desc("score"))
    return scored.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select("query_id", "collection", (F.col("score") * (1 - SLACK)).alias(name))


def chosen_blocks(index: PostingIndex, queries: DataFrame, k: int, k1: float = K1, b: float = B, tokenize=tokens) -> tuple[DataFrame, DataFrame]:
    """All levels of the queries' terms with the number of postings in their blocks, weight, bound, least
    (the threshold, null if there is none) and whether they are skipped; and the weights by query and collection."""
    asked = cut_lineage(query_terms(queries, tokenize))
    totals = F.broadcast(index.totals)
    share = _share(F.col("max_tf"), F.col("min_len"), F.col("mean_len"), k1, b)
    blocks = _asked_blocks(index, asked).join(totals, "collection").withColumn("share", share)
    heads = cut_lineage(blocks.select(*_BLOCK_ID, "n", "share"))
    levels = cut_lineage(heads.groupBy(*_LEVEL).agg(F.sum("n").alias("n"), F.max("share").alias("share")))
    df = levels.groupBy("collection", "term").agg(F.sum("n").alias("df"))
    weights = asked.join(df, "term").join(totals, "collection").withColumn(
        "weight", F.col("uses") * F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    )
    weights = cut_lineage(weights.select("query_id", "collection", "term", "weight", "mean_len"))
    bounded = weights.join(levels, ["collection", "term"]).withColumn("bound", F.col("weight") * F.col("share"))
    # a term's best blocks are the same for all queries; they are told by the share and segment of the last
    falling = Window.partitionBy("collection", "term").orderBy(F.desc("share"), "segment", "level", "part")
    best = heads.withColumns({"r": F.row_number().over(falling), "before": F.sum("n").over(falling.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")})
    best = best.where((F.col("r") <= BEST_BLOCKS) & (F.col("before") < BLOCK))
    last = best.groupBy("collection", "term").agg(F.min(F.struct("share", (-F.col("segment")).alias("place"))).alias("last"))
    first = blocks.join(_small(last), ["collection", "term"]).where(F.struct("share", (-F.col("segment")).alias("place")) >= F.col("last"))
    # rows that share a posting score less than it each, so it gives no threshold
    rows = _block_rows(first.withColumns({"level": F.lit(-1), "postings": F.filter("postings", lambda x: x["alone"])}))
    plan = _plan_rows(weights.withColumns({"level": F.lit(-1), "off": F.lit(0.0), "left_out": F.lit(0.0), "least": F.lit(None).cast("double")}))
    least = _kth(_by_segment(rows, plan, index, k, k1, b, False), k, "least")
    by_term = Window.partitionBy("query_id", "collection", "term").orderBy("bound", "level")
    by_query = Window.partitionBy("query_id", "collection").orderBy("bound", "term", "level").rowsBetween(Window.unboundedPreceding, 0)
    rising = bounded.withColumn("adds", F.col("bound") - F.coalesce(F.lag("bound").over(by_term), F.lit(0.0)))
    summed = rising.withColumn("all_skipped", F.sum("adds").over(by_query)).join(least, ["query_id", "collection"], "left")
    return cut_lineage(summed.withColumn("skipped", F.coalesce(F.col("all_skipped") < F.col("least"), F.lit(False)))), weights


def posting_top_k(index: PostingIndex, queries: DataFrame, k: int = 10, k1: float = K1, b: float = B, tokenize=tokens) -> DataFrame:
    """Best k chunks per query and collection by BM25, as `keyword_top_k` gives them.

    Result: query_id, collection, chunk_id, score (six places), rank; ties go to the lower chunk_id."""
    every, weights = chosen_blocks(index, queries, k, k1, b, tokenize)
    keys = ["query_id", "collection"]
    off = every.where("skipped").groupBy(*keys, "term").agg(F.max("bound").alias("off"))
    ends = every.groupBy(*keys).agg(F.first("least").alias("least")).join(off.groupBy(*keys).agg(F.sum("off").alias("left_out")), keys, "left")
    kept = every.where("not skipped").select(*keys, "term", "weight", "mean_len", "level")
    plan = weights.withColumn("level", F.lit(-1)).unionByName(kept).join(off, [*keys, "term"], "left").join(ends, keys, "left")
    plan = _plan_rows(plan.withColumns({"off": F.coalesce("off", F.lit(0.0)), "left_out": F.coalesce("left_out", F.lit(0.0))}))
    read = _asked_blocks(index, weights).join(_small(kept.select(*_LEVEL).distinct()), _LEVEL, "left_semi")
    exact = _by_segment(_block_rows(read), plan, index, k, k1, b, True)
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "chunk_id")
    return exact.withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "collection", "chunk_id", "score", "rank")


def _block_rows(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        "segment", "collection", "term", "level", F.col("postings.chunk_id").alias("ids"), F.col("postings.tf").alias("tfs"),
        F.col("postings.doc_len").alias("lens"), F.lit(None).cast("array<int>").alias("codes"),
    )


def _plan_rows(rows: DataFrame) -> DataFrame:
    """What a query wants of a term: a row of level -1, and one for each level that is read."""
    return cut_lineage(rows.select("query_id", "collection", "term", "level", "weight", "off", "mean_len", "left_out", "least"))


def _by_segment(blocks: DataFrame, plan: DataFrame, index: PostingIndex, k: int, k1: float, b: float, exact: bool) -> DataFrame:
    """(query_id, chunk_id, collection, score) of the best k chunks of each segment, query and collection: if
    exact, those that can be among the best k of all, scored from their terms; else by what the blocks give."""
    sc = plan.sparkSession.sparkContext
    kind = index.terms.schema["collection"].dataType.simpleString()
    result = f"query_id long, chunk_id long, collection {kind}, score double"
    vocabulary = sc.broadcast(plan.select("term").distinct().toArrow()["term"].combine_chunks())  # the queries' distinct words
    rows = blocks
    if exact:
        chunks = index.terms.select(_segment(_segments(index.totals)).alias("segment"), "collection", "chunk_id", "doc_len", "terms", "tfs")
        shape = f"segment int, collection {kind}, term string, level int, ids array<long>, tfs array<int>, lens array<int>, codes array<int>"
        rows = rows.unionByName(chunks.mapInArrow(lambda batches: _asked_terms(batches, vocabulary.value), shape))
    if (size := plan.count()) <= SMALL_ROWS:
        asked = sc.broadcast(Asked(plan.toArrow(), vocabulary.value))
        return rows.groupBy("segment").applyInArrow(lambda table: _best(table, asked.value, k, k1, b, exact), result)
    parts = -(-size // max(SMALL_ROWS, 1)) if SMALL_ROWS else 2
    own = plan.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    own = own.crossJoin(plan.sparkSession.range(_segments(index.totals)).select(F.col("id").cast("int").alias("segment")))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(int(parts) - 1))))
    own, keys = own.toDF(*own.columns), ["segment", "part"]
    return rows.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInArrow(lambda table, mine: _best(table, Asked(mine, vocabulary.value), k, k1, b, exact), result)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _ranges(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges first..stop, end exclusive, and the range of each."""
    many = stop - first
    of = np.repeat(np.arange(len(first)), many)
    return np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + first[of], of


def _share_of(tf: np.ndarray, length: np.ndarray, mean: float, k1: float, b: float) -> np.ndarray:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))


def _asked_terms(batches, vocabulary: pa.Array):
    """Of each chunk the terms that any query asks for, by their places in the vocabulary."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column("chunk_id")))
        lists = batch.column("terms")
        row = np.repeat(np.arange(len(batch)), _numbers(pc.fill_null(pc.list_value_length(lists), 0)))
        code = pc.index_in(lists.flatten(), value_set=vocabulary)
        hit = np.flatnonzero(_numbers(pc.is_valid(code)))
        many = np.bincount(row[hit], minlength=len(batch))
        rows = np.flatnonzero(many)
        starts = pa.array(np.r_[0, np.cumsum(many[rows])], pa.int32())
        single = pa.array(np.arange(len(rows) + 1), pa.int32())
        held, at = batch.take(pa.array(rows)), pa.array(hit)
        yield pa.RecordBatch.from_arrays(
            [
                held.column("segment"), held.column("collection"), pa.nulls(len(rows), pa.string()), pa.array(np.full(len(rows), -1), pa.int32()),
                pa.ListArray.from_arrays(single, held.column("chunk_id")), pa.ListArray.from_arrays(starts, batch.column("tfs").flatten().take(at)),
                pa.ListArray.from_arrays(single, held.column("doc_len")), pa.ListArray.from_arrays(starts, code.take(at)),
            ],
            ["segment", "collection", "term", "level", "ids", "tfs", "lens", "codes"],
        )


class Asked:
    """What the queries want, by collection: the mean length, and per query its id, bounds, the blocks it
    reads with weights and skipped bounds, and the weights of all its terms."""

    def __init__(self, plan: pa.Table, vocabulary: pa.Array):
        self.vocabulary, self.of = vocabulary, {}
        for name in plan["collection"].unique().to_pylist():
            own = plan.filter(pc.equal(plan["collection"], name)).sort_by("query_id")
            query, level, weight, off, left_out = (_numbers(own[c]) for c in ("query_id", "level", "weight", "off", "left_out"))
            least = _numbers(pc.fill_null(own["least"], -np.inf))
            code = _numbers(pc.index_in(own["term"], value_set=vocabulary)).astype(np.int64)
            queries = []
            for rows in np.split(np.arange(len(query)), np.flatnonzero(np.diff(query)) + 1):
                whole, part = rows[level[rows] < 0], rows[level[rows] >= 0]
                queries.append((int(query[rows[0]]), left_out[rows[0]], least[rows[0]], code[part] * 64 + level[part] + 1, weight[part], off[part], code[whole], weight[whole]))
            self.of[name] = own["mean_len"][0].as_py(), queries


def _best(table: pa.Table, asked: Asked, k: int, k1: float, b: float, exact: bool) -> pa.Table:
    out = [[], [], [], []]
    for name in table["collection"].unique().to_pylist():
        if name not in asked.of:
            continue
        own = table.filter(pc.equal(table["collection"], name))
        found = _best_of(own, asked.of[name], asked.vocabulary, k, k1, b, exact)
        for x, y in zip(out, [*found[:2], [name] * len(found[0]), found[2]], strict=True):
            x.extend(y)
    types = [pa.int64(), pa.int64(), table.schema.field("collection").type, pa.float64()]
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], ["query_id", "chunk_id", "collection", "score"])


def _best_of(own: pa.Table, wants: tuple, vocabulary: pa.Array, k: int, k1: float, b: float, exact: bool) -> tuple[list, list, list]:
    mean, queries = wants
    is_block = pc.is_valid(own["term"])
    blocks, docs = own.filter(is_block).combine_chunks(), own.filter(pc.invert(is_block)).combine_chunks()
    code = _numbers(pc.index_in(blocks["term"], value_set=vocabulary)).astype(np.int64)
    key = np.repeat(code * 64 + _numbers(blocks["level"]) + 1, _numbers(pc.list_value_length(blocks["ids"])))
    ids = pc.list_flatten(blocks["ids"])
    known = np.flatnonzero(_numbers(pc.is_valid(ids)))
    order = known[np.argsort(key[known], kind="stable")]
    key, chunk = key[order], _numbers(pc.fill_null(ids, 0))[order]
    share = _share_of(_numbers(pc.list_flatten(blocks["tfs"]))[order].astype(float), _numbers(pc.list_flatten(blocks["lens"]))[order], mean, k1, b)
    if exact:
        doc = _numbers(pc.list_flatten(docs["ids"]))
        every = np.unique(doc)
        by_id = np.argsort(doc, kind="stable")
        doc_first, doc_stop = np.searchsorted(doc[by_id], every), np.searchsorted(doc[by_id], every, "right")
        many = _numbers(pc.list_value_length(docs["codes"])).astype(np.int64)
        entry_stop = np.cumsum(many)
        row, entry = np.repeat(np.arange(len(doc)), many), _numbers(pc.list_flatten(docs["codes"]))
        # equal chunks add up their terms in one order
        sorted_ = np.lexsort((entry, row))
        entry = entry[sorted_]
        entry_share = _share_of(_numbers(pc.list_flatten(docs["tfs"]))[sorted_].astype(float), _numbers(pc.list_flatten(docs["lens"]))[row], mean, k1, b)
    else:
        every = np.unique(chunk)
    place = np.searchsorted(every, chunk)
    weight_of = np.zeros(len(vocabulary))
    out = [], [], []
    for query, left_out, least, keys, weight, off, codes, weights in queries:
        if not exact:
            keys, weight, off = codes * 64, weights, np.zeros(len(codes))
        at, of = _ranges(np.searchsorted(key, keys), np.searchsorted(key, keys, "right"))
        if not len(at):
            continue
        adds, where = share[at] * weight[of], place[at]
        score = np.bincount(where, adds, len(every))
        near = np.unique(where)
        alone = near[doc_stop[near] - doc_first[near] == 1] if exact else near
        if len(alone) >= k:
            least = max(least, np.partition(score[alone], -k)[-k] * (1 - SLACK))
        if exact:
            above = np.bincount(where, adds - off[of], len(every))[near]
            near = near[above + left_out >= least - SLACK * abs(least)] if least > -np.inf else near
            rows = by_id[_ranges(doc_first[near], doc_stop[near])[0]]
            entries, of = _ranges(entry_stop[rows] - many[rows], entry_stop[rows])
            weight_of[codes] = weights
            score = np.bincount(of, weight_of[entry[entries]] * entry_share[entries], len(rows))
            weight_of[codes] = 0
            chunks = doc[rows]
        else:
            chunks, score = every[near], score[near]
        best = np.lexsort((chunks, -np.round(score, 6)))[:k]
        out[0].extend([query] * len(best))
        out[1].extend(chunks[best].tolist())
        out[2].extend(score[best].tolist())
    return out
