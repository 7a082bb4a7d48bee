"""Severity of toxic text by cumulative-link ordinal regression.

P(grade <= k) = logistic(cut k - w x): one weight per feature for all grades, and ascending cuts
between them. The result is the expected severity, the sum over k of P(grade > k). Features are
which character strings of 4 to 6 bytes and which whole words a text has, each taken within one
lower-cased word and marked if it begins the word, so that inflected forms share features. They are
hashed to a fixed number of places; those that tell the grades apart best are kept."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import by_place, picked
from docketry.session import cut_lineage

#: At most so many labelled rows, those first by a hash of their number.
SAMPLE = 20_000
PLACES = 1 << 20
KEPT = 2_048
STEPS = 300
#: Least chi-square statistic of a kept place, one in a hundred thousand by chance.
CHI = 20.0

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14), *b".,;:!?\"()"]] = True


def feature_places(text: str | None) -> np.ndarray:
    """Sorted places of the features of a whole text; none for a null or empty one."""
    data = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "surrogatepass") + b" ", np.uint8)
    space = _SPACE[data]
    if space.all():
        return np.empty(0, np.int64)
    data = np.where(space, np.uint8(32), data)
    byte = data.astype(np.uint64) + np.uint64(1)
    gap = np.flatnonzero(space)
    until = gap[np.searchsorted(gap, np.arange(len(data)), side="right").clip(max=len(gap) - 1)]
    room = until - np.arange(len(data))  # bytes to the next separator, from here or from after it
    inside = ~space
    first = np.r_[False, space[:-1]] & inside
    out, name = [], byte.copy()
    for size in range(2, 7):
        if len(name) < 2:
            break
        name = (name[:-1] * _MIX) ^ (name[:-1] >> np.uint64(29))
        name += byte[size - 1 : size - 1 + len(name)] * np.uint64(0xD6E8FEB86659FD93)
        if size >= 4:
            ok = inside[: len(name)] & (room[: len(name)] >= size)
            mark = first[: len(name)][ok].astype(np.uint64) + np.uint64(2 * size)
            out.append(_place(name[ok], mark))
    begin = np.flatnonzero(first)
    if len(begin):  # whole words by a polynomial over their bytes
        end = until[begin]
        power = np.cumprod(np.full(int((end - begin).max()), _MIX))
        long_ = end - begin
        of = np.repeat(np.arange(len(begin)), long_)
        at = np.arange(len(of)) - np.repeat(np.cumsum(long_) - long_, long_)
        out.append(_place(np.add.reduceat(byte[begin[of] + at] * power[at], np.cumsum(long_) - long_), np.full(len(begin), 1, np.uint64)))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)


def _place(name: np.ndarray, mark: np.ndarray) -> np.ndarray:
    name = (name ^ (mark * np.uint64(0xBF58476D1CE4E5B9))) * _MIX
    return ((name ^ (name >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(44)).astype(np.int64) % PLACES


@dataclass
class Severity:
    """Weights of the kept places, zero elsewhere, and the cuts between the grades."""

    place: np.ndarray
    weight: np.ndarray
    cuts: np.ndarray
    limit: float

    def table(self) -> np.ndarray:
        full = np.zeros(PLACES, np.float32)
        full[self.place] = self.weight
        return full

    def severity(self, strength: np.ndarray) -> np.ndarray:
        return logistic(strength[:, None] - self.cuts[None, :]).sum(axis=1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def by_chance(both, above, n_both: float, n_above: float):
    """Chi-square statistic of a place that `both` of n_both documents have, `above` of n_above of
    them above the lowest grade; numbers, arrays or columns."""
    expected = both * n_above / n_both
    return (above - expected) * (above - expected) / (expected * (1 - both / n_both) + 1e-9)


def kept_places(sets: list[np.ndarray], grade: np.ndarray, kept: int = KEPT) -> np.ndarray:
    """Places that documents above the lowest grade have most clearly more often than the others.

    Of a million places some thousand pass a weaker test by chance and then raise clean documents."""
    high = grade > grade.min()
    count = [np.bincount(np.concatenate([np.empty(0, np.int64), *some]), minlength=PLACES) for some in (sets, [s for s, h in zip(sets, high, strict=True) if h])]
    both, above = count[0].astype(float), count[1].astype(float)
    chi = np.where((both >= 3) & (above * len(sets) > both * high.sum()), by_chance(both, above, len(sets), high.sum()), 0)
    best = np.argsort(-chi, kind="stable")[:kept]
    return np.sort(best[chi[best] > CHI])


def fit_severity(sets: list[np.ndarray], grade: np.ndarray, place: np.ndarray | None = None, steps: int = STEPS, penalty: float = 2e-4, rate: float = 0.05) -> Severity:
    """Weights and cuts of the least ordinal loss, by Adam steps over all rows.

    place: the places to use; else those kept_places() gives. The limit is the severity that tells
    the lowest grade from the others with the best F1 on the rows. Rows of one grade only give no
    weights, and a limit that no document reaches."""
    levels = np.unique(grade) if len(grade) else np.array([0])
    if len(levels) < 2:
        return Severity(np.empty(0, np.int64), np.empty(0), np.zeros(1), np.inf)
    level = np.searchsorted(levels, grade)
    place = kept_places(sets, grade) if place is None else place
    at = [np.searchsorted(place, s[np.isin(s, place)]) for s in sets]
    row = np.repeat(np.arange(len(sets)), [len(a) for a in at])
    col = np.concatenate(at).astype(np.int64)
    n, k = len(sets), len(levels) - 1
    above = level[:, None] > np.arange(k)[None, :]
    share = np.clip(above.mean(axis=0), 1e-6, 1 - 1e-6)
    first, gaps = -np.log(share[0] / (1 - share[0])), np.log(np.maximum(np.diff(-np.log(share / (1 - share))), 1e-3))
    theta = np.r_[np.zeros(len(place)), first, gaps]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(n)
    for t in range(1, steps + 1):
        w, cuts = theta[: len(place)], cuts_of(theta[len(place) :])
        s = np.bincount(row, w[col], n)
        upper = np.c_[np.ones(n), logistic(s[:, None] - cuts), np.zeros(n)]  # P(level >= j)
        p = np.maximum(upper[rows, level] - upper[rows, level + 1], 1e-12)
        slope = upper * (1 - upper)  # of each bound by the strength
        ds = -(slope[rows, level] - slope[rows, level + 1]) / p / n
        dc = np.zeros(k)
        np.add.at(dc, np.maximum(level - 1, 0), np.where(level > 0, slope[rows, level] / p / n, 0))
        np.add.at(dc, np.minimum(level, k - 1), np.where(level < k, -slope[rows, level + 1] / p / n, 0))
        grad = np.r_[np.bincount(col, ds[row], len(place)) + penalty * w, dc.sum(), np.cumsum(dc[::-1])[::-1][1:] * np.exp(theta[len(place) + 1 :])]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model = Severity(place, theta[: len(place)], cuts_of(theta[len(place) :]), 0.0)
    got = model.severity(np.bincount(row, model.weight[col], n))
    model.limit = best_limit(got, level > 0)
    return model


def cuts_of(theta: np.ndarray) -> np.ndarray:
    """Ascending cuts: the first, and the logarithms of the gaps."""
    return np.cumsum(np.r_[theta[0], np.exp(theta[1:])])


def best_limit(severity: np.ndarray, toxic: np.ndarray) -> float:
    order = np.argsort(-severity, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    k = int(np.argmax(f1))
    low = severity[order[k + 1]] if k + 1 < len(order) else 0.0
    return float((severity[order[k]] + low) / 2)


def fitted(docs: DataFrame, labels: DataFrame, grade: str, sample: int = SAMPLE) -> Severity:
    """Fitted on the labelled documents with a grade; of more than `sample` those first by a hash.

    The sample's numbers are broadcast. Places are counted and chosen in Spark; the driver gets the
    kept places and which of them each document of the sample has."""
    known = picked(labels, "doc_id", grade).where(F.col(grade).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.max(grade).cast("long").alias("grade"))
    first = F.broadcast(known.orderBy(F.xxhash64("of"), "of").limit(sample))

    def run(batches):
        for b in batches:
            sets = pa.array([feature_places(t).astype(np.int32) for t in b.column(2).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), sets], ["doc_id", "grade", "places"])

    own = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").join(first, F.col("doc_id") == F.col("of"))
    told = own.select("doc_id", "grade", "text").mapInArrow(run, "doc_id long, grade long, places array<int>")
    told = cut_lineage(told.groupBy("doc_id", "grade").agg(F.min("places").alias("places")))  # repeated rows count once
    low, n = told.agg(F.min("grade"), F.count("*")).first()
    if not n:
        return fit_severity([], np.empty(0, np.int64))
    n_above = told.where(F.col("grade") > low).count()
    counted = told.select((F.col("grade") > low).cast("int").alias("high"), F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("both"), F.sum("high").alias("above"))
    chi = by_chance(F.col("both"), F.col("above"), n, n_above)
    clear = counted.where((F.col("both") >= 3) & (F.col("above") * n > F.col("both") * n_above) & (chi > CHI))
    place = np.sort(np.array([r["place"] for r in clear.orderBy(chi.desc(), "place").limit(KEPT).collect()], np.int64))
    has = F.array_intersect("places", F.array(*map(F.lit, place.tolist())).cast("array<int>")) if len(place) else F.array().cast("array<int>")
    rows = told.select("doc_id", "grade", has.alias("has")).orderBy("doc_id").collect()
    return fit_severity([np.sort(np.array(r["has"], np.int64)) for r in rows], np.array([r["grade"] for r in rows]), place)


def scorer(docs: DataFrame, model: Severity):
    """A function for tasks that gives texts' severities; the weights, of fixed number, are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((model.table(), model.cuts))

    def score(texts: list) -> np.ndarray:
        weight, cuts = shared.value
        strength = np.array([weight[feature_places(t)].sum(dtype=np.float64) for t in texts], np.float64)
        return logistic(strength[:, None] - cuts[None, :]).sum(axis=1)

    return score


def severities(docs: DataFrame, model: Severity) -> DataFrame:
    """(doc_id, severity, toxic) of every row of docs (doc_id, text)."""
    score, limit = scorer(docs, model), model.limit

    def run(batches):
        for b in batches:
            got = score(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64()), pa.array(got >= limit)], ["doc_id", "severity", "toxic"])

    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, severity double, toxic boolean")


def below_limit(docs: DataFrame, model: Severity) -> DataFrame:
    """The rows of docs, all columns, whose severity is below the model's limit."""
    score, limit, at = scorer(docs, model), model.limit, docs.columns.index("text")
    placed = by_place(docs)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(score(b.column(at).to_pylist()) < limit))

    return placed.mapInArrow(run, placed.schema).toDF(*docs.columns)


def graded(docs: DataFrame, labels: DataFrame, grade: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, severity, toxic) of every row of docs (doc_id, text).

    labels are (doc_id, `grade`), the grade an integer, higher for worse, of any number of levels;
    null grades and doc_ids are not used and of repeated ones the larger counts. severity is 0 to
    the number of levels less one, toxic says whether it reaches the fitted limit. Null and empty
    texts have no features and get the severity of the cuts alone. With labels of one level or none
    nothing is toxic. Repeated rows stay repeated, a null doc_id stays null, no rows give no rows,
    other columns are not read."""
    return severities(docs, fitted(docs, labels, grade, sample))
