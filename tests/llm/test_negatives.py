"""Hard negatives beside brute force."""

import math
import random

import pytest

from docketry.llm import negatives
from docketry.llm.negatives import hard_negatives

KINDS = "vec_id long, label int, embedding array<float>, id string, score string, anchor string"


def brute(rows, step=3, positives=5, least=5, low=(80, 100)):
    """By scoring every anchor with every row."""
    fine = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    own = sorted({(i, y, tuple(math.floor(256 * float(x)) for x in v)) for i, y, v in rows if i is not None and y is not None and fine(v)})
    anchors = {}
    for i, y, v in own:
        if i % step == 0:
            anchors.setdefault(i, (y, v))
    out = []
    for a, (label, v) in anchors.items():
        score = [(-sum(p * q for p, q in zip(v, w, strict=True)), i, y) for i, y, w in own if i != a and len(w) == len(v)]
        score = sorted({(s, i, y == label) for s, i, y in score})
        for s, p in [(s, i) for s, i, same in score if same][:positives]:
            hit = [(n, i) for n, i, same in score if not same and low[0] * -s <= low[1] * -n and -n <= -s]
            hit = list(dict.fromkeys(hit))
            out += [(a, p, r, i, -s, -n) for r, (n, i) in enumerate(hit[:least], 1)]
    return sorted(out)


def vectors(seed, n=200, size=6, labels=4):
    rng = random.Random(seed)
    of = [rng.choice([0.0, 0.25, -0.5, 0.125, 1.0]) for _ in range(size * 7)]
    rows = []
    for i in range(n):
        v = [rng.choice(of) + rng.choice([0.0, 0.0, rng.gauss(0, 0.1)]) for _ in range(size)]
        rows.append((i, rng.randrange(labels) if rng.random() < 0.6 else 0, v))
    # round as the table's type does
    return [(i, y, [float(x) for x in __import__("numpy").array(v, "f4")]) for i, y, v in rows]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], KINDS).repartition(parts)


def result(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert df.columns == names
    return sorted(tuple(r) for r in df.collect())


# one broadcast, and grids of a few and of many tiles
@pytest.mark.parametrize("tile_bytes", [negatives.TILE_BYTES, 6_000, 1_500])
@pytest.mark.parametrize("rows_at_once", [negatives.ROWS, 17])
def test_agrees_with_brute_force(spark, monkeypatch, tile_bytes, rows_at_once):
    monkeypatch.setattr(negatives, "ROWS", rows_at_once)
    rows = vectors(1)
    want = brute(rows)
    assert len(want) > 300
    assert result(hard_negatives(frame(spark, rows), lambda i: i % 3 == 0, tile_bytes=tile_bytes)) == want


@pytest.mark.parametrize("seed", range(3))
def test_other_numbers(spark, seed):
    rows = vectors(10 + seed, n=90, size=3, labels=2)
    got = hard_negatives(frame(spark, rows), lambda i: i % 3 == 0, positives=2, negatives=7, low=(50, 100))
    assert result(got) == brute(rows, positives=2, least=7, low=(50, 100))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *vectors(3, n=40, size=2), (0, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (300, 1, None), (303, 1, [1.0, None]), (306, 1, [nan, 1.0]), (309, 0, [inf, 1.0]),
        (312, 1, []), (315, 2, []), (318, 0, [2.0, 1.0, 1.0]), (319, 0, [2.0, 1.0, 1.0]), (320, 1, [2.0, 1.0, 0.75]), (321, 1, [0.0, 0.0]), (322, 0, [0.0, 0.0]),
    ]
    repeated = [*rows, *rows[:25], (6, 3, [0.5, 0.5]), (7, 0, [0.5, 0.75])]
    assert any(r[0] == 318 for r in brute(rows))
    assert result(hard_negatives(frame(spark, rows), lambda i: i % 3 == 0)) == brute(rows)
    assert result(hard_negatives(frame(spark, repeated), lambda i: i % 3 == 0)) == brute(repeated)
    assert result(hard_negatives(frame(spark, []), lambda i: i % 3 == 0)) == []
    assert result(hard_negatives(frame(spark, rows), lambda i: i < 0)) == []


def test_large_numbers_are_exact_or_an_error(spark):
    rows = [(0, 0, [2.0**22, 1.0]), (1, 0, [2.0**22, 2.0**-8]), (2, 1, [2.0**22, 0.0]), (3, 1, [2.0**21, 0.0])]
    assert result(hard_negatives(frame(spark, rows), lambda i: i == 0)) == brute(rows, step=100)
    huge = [(0, 0, [2.0**30, 1.0]), (1, 0, [2.0**30, 1.0])]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        hard_negatives(frame(spark, huge), lambda i: i == 0).collect()


def test_one_label_holds_all_but_a_few(spark):
    rows = [(i, 0 if i % 50 else 1, v) for i, _, v in vectors(5, n=600, size=4)]
    assert result(hard_negatives(frame(spark, rows), lambda i: i % 100 == 0)) == brute(rows, step=100)


def test_plan_sorts_within_partitions_and_joins_nothing_crosswise(spark, sf):
    from docketry.llm.queries import QUERIES

    plan = QUERIES["op12_hard_negatives"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [anchor" in plan and "hashpartitioning(anchor" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
