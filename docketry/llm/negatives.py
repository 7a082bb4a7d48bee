"""Hard negatives for anchors, by a secondary-sort shuffle.

An anchor's rows are looked at in the order of their score, highest first. A row of its label opens a
window of scores; rows of other labels that come while a window is open are its negatives. So the
rows are dealt out by anchor and sorted by the packed key (anchor, falling score, kind, id) within the
partitions, and an iterator streams over them: it holds the open windows of one anchor, at most as
many as there are positives, and never an anchor's rows.

Scores are matrix products of the anchors with batches of rows. Two passes keep what is shuffled
small and lose nothing. The first sends, per batch and anchor, the batch's best rows of the same
label; their best over all batches are the positives. The second knows the windows and sends, per
batch, anchor and window, the batch's best rows of other labels. Every row meets every anchor, in
batches: anchors below a checked size are broadcast and rows stay where they are; above it anchors
and rows are dealt into a grid of tiles, and each tile of anchors meets each tile of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docketry.llm.common import parts_of, picked
from docketry.session import cut_lineage

#: Bytes of anchors that are broadcast; of a tile of anchors or rows if there are more.
TILE_BYTES = 32 << 20
#: Rows of a batch, and scores that are held at once.
ROWS, CELLS = 4_096, 1 << 21
_SENT = "anchor long, down long, kind int, id long"
_OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vector: Column, label: Column) -> Column:
    """Whether there is a label and a vector whose components are all finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & fine, F.lit(False))


def numbers(vector: Column) -> Column:
    """floor(256 x) of each component x, as double."""
    return F.transform(vector, lambda x: F.floor(x * 256))


def matrix(vectors: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return np.asarray(flat.flatten(), np.float64 if flat.type.value_type == pa.float64() else np.int64).reshape(len(flat), size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and of b; an error if one does not fit 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = max(-int(a.min()), int(a.max())) * max(-int(b.min()), int(b.max())) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    if most >= 1 << 63 and max(abs(int(exact.max())), abs(int(exact.min()))) >= 1 << 63:
        raise ValueError("a score does not fit 64 bits")
    return exact.astype(np.int64)


class Rows:
    """Rows of one length by rising id, each distinct (id, label, vector) once."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((labels, ids))
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        if (ids[1:] == ids[:-1]).any():
            _, first = np.unique(np.column_stack([ids, labels, vectors]), axis=0, return_index=True)
            first.sort()
            ids, labels, vectors = ids[first], labels[first], vectors[first]
        self.ids, self.labels, self.vectors = ids, labels, vectors

    @classmethod
    def by_length(cls, table: pa.Table) -> Iterator["Rows"]:
        size = table["vector"].combine_chunks().value_lengths().to_numpy()
        for s in np.unique(size):
            own = table.filter(pa.array(size == s))
            yield cls(own["id"].to_numpy(), own["label"].to_numpy(), matrix(own["vector"], int(s)))


def first_of(score: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """Of places in order of their ids, the first by falling score."""
    if len(at) > 4 * most:
        edge = np.partition(score[at], len(at) - most)[len(at) - most]
        at = at[score[at] >= edge]
    return at[np.argsort(-score[at], kind="stable")][:most]


def least_in(positive: int, low: tuple[int, int]) -> int:
    """The least score s with low[0] * positive <= low[1] * s, or 64 bits' largest if that is less."""
    return min(-(-low[0] * positive // low[1]), (1 << 63) - 1)


class Anchors:
    """Anchors of one length, with their windows if these are known."""

    def __init__(self, rows: Rows, windows: dict[int, list[int]]):
        self.rows, self.windows = rows, windows

    def best(self, rows: Rows, positives: int, negatives: int, low: tuple[int, int], first: bool) -> list[tuple[int, int, int, int]]:
        """What a batch sends, as (anchor, -score, kind, id): kind 0 are rows of the anchor's label,
        kind 1 rows of other labels within a window of it."""
        out = []
        step = max(1, CELLS // max(1, len(rows.ids)))
        for at in range(0, len(self.rows.ids), step):
            some = slice(at, at + step)
            scores = products(self.rows.vectors[some], rows.vectors)
            for anchor, label, score in zip(self.rows.ids[some].tolist(), self.rows.labels[some].tolist(), scores, strict=True):
                if first:
                    found = [first_of(score, np.flatnonzero((rows.labels == label) & (rows.ids != anchor)), positives)]
                else:
                    found = []
                    windows = self.windows.get(anchor, [])
                    if windows:
                        ends = [least_in(w, low) for w in windows]
                        open_ = np.flatnonzero((score <= max(windows)) & (score >= min(ends)) & (rows.labels != label))
                        own = score[open_]
                        found = [open_[first_of(own, np.flatnonzero((own <= w) & (own >= end)), negatives)] for w, end in zip(windows, ends, strict=True)]
                places = np.unique(np.concatenate(found)) if found else ()
                out += [(anchor, -int(score[p]), int(not first), int(rows.ids[p])) for p in places]
        return out


def sent(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.int32(), pa.int64()], strict=True)], ["anchor", "down", "kind", "id"])


def meet(rows: pa.Table, anchors: list[Anchors], **how) -> pa.RecordBatch:
    out = []
    for some in Rows.by_length(rows):
        for a in anchors:
            if a.rows.vectors.shape[1] == some.vectors.shape[1]:
                out += a.best(some, **how)
    return sent(out)


def anchors_of(table: pa.Table) -> list[Anchors]:
    windows = {a: w for a, w in zip(table["id"].to_pylist(), table["windows"].to_pylist(), strict=True) if w}
    return [Anchors(rows, windows) for rows in Rows.by_length(table)]


def met(rows: DataFrame, anchors: DataFrame, tile_bytes: int, **how) -> DataFrame:
    """What batches of rows (id, label, vector) send for anchors (id, label, vector, windows)."""
    size = lambda df: df.agg(F.coalesce(F.sum(8 * F.size("vector").cast("long") + 64), F.lit(0)).alias("n")).first()["n"]
    held = size(anchors)
    if held <= tile_bytes:
        table = anchors.select("id", "label", "vector", "windows").toArrow()
        shared = rows.sparkSession.sparkContext.broadcast(table)

        def run(batches):
            own = anchors_of(shared.value)
            for b in batches:
                for at in range(0, b.num_rows, ROWS):
                    yield meet(pa.Table.from_batches([b.slice(at, ROWS)]), own, **how)

        return rows.select("id", "label", "vector").mapInArrow(run, _SENT)
    across, down = parts_of(held, tile_bytes, 1), parts_of(size(rows), tile_bytes, 1)
    tile = lambda of, n: F.pmod(F.xxhash64("id", "vector"), F.lit(n)).alias(of)
    each = lambda of, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>")).alias(of)
    left = rows.select("id", "label", "vector", tile("y", down), each("x", across)).groupBy("x", "y")
    right = anchors.select("id", "label", "vector", "windows", tile("x", across), each("y", down)).groupBy("x", "y")

    def grid(some: pa.Table, own: pa.Table) -> pa.Table:
        anchors = anchors_of(own)
        return pa.Table.from_batches([sent([]), *(meet(some.slice(at, ROWS), anchors, **how) for at in range(0, some.num_rows, ROWS))])

    return left.cogroup(right).applyInArrow(grid, _SENT)


def streamed(batches: Iterator[pa.RecordBatch], positives: int, negatives: int, low: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Negatives from rows sorted by (anchor, down, kind, id)."""
    last, open_, opened = None, [], 0
    for b in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row == last:  # a repeated row
                continue
            anchor, down, kind, id_ = row
            if last is None or anchor != last[0]:
                open_, opened = [], 0
            last, score = row, -down
            if kind == 0:
                if opened < positives:
                    opened += 1
                    open_.append([id_, score, 0])
                continue
            open_ = [w for w in open_ if w[2] < negatives and low[0] * w[1] <= low[1] * score]
            for w in open_:
                w[2] += 1
                out.append((anchor, w[0], w[2], id_, w[1], score))
        columns = zip(*out, strict=True) if out else [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in _OUT.split(", ")])


def hard_negatives(rows: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 5, low: tuple[int, int] = (80, 100), tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of anchors and positives.

    rows are (vec_id, label, embedding); is_anchor says which ids are anchors. A score is the inner product of
    two vectors whose components are floor(256 x). An anchor's positives are its first `positives`
    other rows of the same label, by falling score, then rising vec_id. For each of them the first
    `negatives` rows of other labels with a score s are given for which low[0] p <= low[1] s and s <= p,
    p being the positive's score, ranked from 1 in the same order. An anchor or a positive without
    such rows gives none.

    Rows with a null vec_id, label or vector or a null or non-finite component take no part. Vectors
    of different lengths have no score. Another row is one with another vec_id; a row that is repeated
    with equal vec_id, label and vector counts once, and if an anchor's vec_id has several rows, the
    one with the least label, then vector is the anchor. A score beyond 64 bits is an error. No rows
    give no rows; other columns are not read."""
    vector = F.col("embedding").cast("array<double>")
    given = picked(rows, "vec_id", "label", "embedding").where(usable(vector, F.col("label"))).select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), numbers(vector).alias("vector")).where("id is not null")
    chosen = given.where(is_anchor(F.col("id"))).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("own"))
    anchors = cut_lineage(chosen.select("id", "own.label", "own.vector"))
    how = {"positives": positives, "negatives": negatives, "low": low}
    bare = anchors.withColumn("windows", F.array().cast("array<long>"))
    order = Window.partitionBy("anchor").orderBy("down", "id")
    same = met(given, bare, tile_bytes, first=True, **how).distinct()
    best = cut_lineage(same.withColumn("r", F.row_number().over(order)).where(F.col("r") <= positives).drop("r"))
    windows = best.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(-F.col("down")).alias("windows"))
    others = met(given, anchors.join(windows, "id"), tile_bytes, first=False, **how)
    # the secondary sort: dealt out by anchor, sorted by the whole key within the partitions
    keyed = best.unionAll(others).repartition("anchor").sortWithinPartitions("anchor", "down", "kind", "id")
    return keyed.mapInArrow(lambda b: streamed(b, positives, negatives, low), _OUT)
