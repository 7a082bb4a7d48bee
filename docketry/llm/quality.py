"""Quality scores by Bradley-Terry ranking.

A document labelled good is preferred to one labelled bad. The strength of a document is linear in
the features of its text, and the weights are those that make the preferences of sampled pairs most
likely: logistic loss on differences of features. The strength at the quantile of the bad documents'
share is the threshold; scores are logistic in the strength and are 0.3 at the threshold."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import picked

#: At most so many labelled rows, those first by a hash of their number, and so many pairs of them.
SAMPLE, PAIRS = 20_000, 100_000
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "upper", "digit", "mark", "bar", "odd_mark", "non_ascii", "break", "word_length",
    "long_word", "repeat_next", "distinct", "upper_words", "mark_words", "line_repeat", "stop", "bang",
)

_KIND = np.zeros((256, 8), np.float64)
for _c in range(256):
    _s = chr(_c)
    _KIND[_c] = [
        _s.isascii() and _s.isupper(), _s.isascii() and _s.isdigit(), 33 <= _c < 127 and not _s.isalnum(), _s == "|",
        _s in "#$%&*@^~<>{}[]\\=_+", _c > 127, _s in "\r\n", _s == "!",
    ]
_ENDS_ODD = b"#$%&*@^~|!"


def features(text: str | None) -> list[float]:
    """The features of one whole text; all are 0 for a null or empty one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    upper, digit, mark, bar, odd, other, breaks, bang = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _KIND / len(data)
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        np.log1p(len(data)), upper, digit, mark, bar, odd, other, breaks, np.log(sum(map(len, words)) / n),
        sum(len(w) > 24 for w in words) / n, sum(map(bytes.__eq__, words, words[1:])) / n, np.log1p(n) - np.log1p(len(set(words))),
        sum(map(bytes.isupper, words)) / n, sum(w[-1] in _ENDS_ODD for w in words) / n, 1 - len(set(lines)) / len(lines),
        sum(len(w) <= 3 for w in words) / n, bang,
    ]


def with_features(docs: DataFrame, weights: "Ranking | None" = None) -> DataFrame:
    """(doc_id, features) or, given a fitted ranking, (doc_id, strength)."""

    def run(batches):
        for b in batches:
            x = [features(t) for t in b.column(1).to_pylist()]
            if weights is None:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "features"])
            else:
                got = weights.strength(np.array(x, np.float64).reshape(-1, len(FEATURES)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], ["doc_id", "strength"])

    kind = "features array<double>" if weights is None else "strength double"
    return picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, {kind}")


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    border: float = 0.0
    slope: float = 1.0

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * (self.strength(x) - self.border) + np.log(THRESHOLD / (1 - THRESHOLD)))))


def fit_ranking(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, penalty: float = 1e-3, rounds: int = 60, seed: int = 7) -> Ranking:
    """Weights from `pairs` preferences of a good row over a bad one, by Newton steps.

    Labels of one kind only give no preference: all strengths are then 0 and the border is such that
    the one kind is predicted."""
    mean, scale = x.mean(axis=0) if len(x) else np.zeros(len(FEATURES)), x.std(axis=0) + 1e-9 if len(x) else np.ones(len(FEATURES))
    model = Ranking(mean, scale, np.zeros(len(mean)))
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):
        model.border = 0.0 if len(up) or not len(x) else 1.0
        return model
    rng = np.random.default_rng(seed)
    z = np.clip((x - mean) / scale, -8, 8)
    gap = z[rng.choice(up, pairs)] - z[rng.choice(down, pairs)]
    w = model.weight
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(gap @ w, -30, 30)))
        step = np.linalg.solve((gap * (p * (1 - p))[:, None]).T @ gap / pairs + penalty * np.eye(len(w)), gap.T @ (1 - p) / pairs - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    model.weight = w
    s = model.strength(x)
    share = len(down) / len(x)
    # the border lies between the strengths on both sides of the quantile
    at = int(round(share * len(s)))
    order = np.sort(s)
    model.border = float((order[max(at - 1, 0)] + order[min(at, len(s) - 1)]) / 2)
    model.slope = float(4 / max(np.median(s[up]) - np.median(s[down]), 1e-9))
    return model


def ranked(docs: DataFrame, labels: DataFrame, learn_from, sample: int = SAMPLE) -> tuple[Ranking, int]:
    """A ranking fitted on the labelled documents for which the column `learn_from` holds, and how many.

    Of more than `sample` such documents those first by a hash of their number are taken."""
    known = picked(labels, "doc_id", "quality").where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.max("quality").alias("good"))
    first = known.withColumnRenamed("of", "doc_id").where(learn_from).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "of")
    own = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").join(F.broadcast(first), F.col("doc_id") == F.col("of"))
    told = with_features(own.select("doc_id", "text")).groupBy("doc_id").agg(F.min("features").alias("features"))  # repeated rows count once
    rows = told.join(F.broadcast(first), F.col("doc_id") == F.col("of")).orderBy("doc_id").collect()
    x = np.array([r["features"] for r in rows], np.float64).reshape(-1, len(FEATURES))
    return fit_ranking(x, np.array([r["good"] == 1 for r in rows], bool)), len(rows)


def quality_scores(docs: DataFrame, labels: DataFrame, learn_from, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score, predicted) of every row of docs (doc_id, text).

    labels are (doc_id, quality 0 or 1); rows with another quality or no doc_id are not used, and of
    repeated ones the larger label counts. `learn_from` is a condition on doc_id; only labelled
    documents that fulfil it are learned from, at most `sample`. score is 0 to 1, higher for better
    text, and predicted is 1 from 0.3 on. Null and empty texts have all features 0 and get a score
    too. Without labels of both kinds all documents get one score. Repeated rows stay repeated, a
    null doc_id stays null, no rows give no rows, other columns are not read."""
    model, _ = ranked(docs, labels, learn_from, sample)
    shift = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    margin = model.slope * (F.col("strength") - model.border) + shift
    # at the border itself the logistic function can round to just below the threshold
    score = F.when(F.col("strength") == model.border, THRESHOLD).otherwise(1 / (1 + F.exp(-F.greatest(F.least(margin, F.lit(700.0)), F.lit(-700.0)))))
    return with_features(docs, model).select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
