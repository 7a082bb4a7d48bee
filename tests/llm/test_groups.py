"""Components, SimHash groups, embedding groups and sharding beside brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docketry.llm import pstable, sharding, simhash
from docketry.llm.common import Forest, components, roots
from docketry.llm.queries import QUERIES, SHARDS, SLOTS


def reach(nodes, links):
    """The smallest node each one reaches, by flooding."""
    near = {n: set() for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n not in out:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = n
                    todo += near[x]
    return out


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(0, 400)],
    [(0, i) for i in range(1, 300)] + [(400, i) for i in range(401, 500)] + [(299, 450)],
    [(7, 7), (None, 3), (1, 2), (2, 1), (1, 2)],
    [],
])
def test_components(spark, links):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == reach({x for e in real for x in e}, real)


def test_random_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(10**6), rng.randrange(10**6)) for _ in range(300)]
    links += [(rng.choice(links)[0], rng.choice(links)[1]) for _ in range(150)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == reach({x for e in links for x in e if e[0] != e[1]}, [e for e in links if e[0] != e[1]])


def test_forest_keeps_what_is_connected():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 50, 400), rng.integers(0, 50, 400)
    f = Forest(50, most=40)
    for k in range(0, 400, 10):
        f.add(a[k : k + 10], b[k : k + 10])
    x, y = f.links()
    assert len(x) < 50 and (roots(50, x, y) == roots(50, a, b)).all()


def print_of(text):
    """The fingerprint by its definition."""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def by_simhash(rows):
    prints = {t: print_of(t) for _, t in rows}
    fps = sorted({prints[t] for d, t in rows if d is not None})
    links = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    first = {}
    links += [(first.setdefault(d, prints[t]), prints[t]) for d, t in rows if d is not None]
    root, least = reach(fps, links), {}
    for d, t in rows:
        if d is not None:
            r = root[prints[t]]
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{prints[t]:016x}", None if d is None else least[root[prints[t]]]) for d, t in rows), key=repr)


def near_texts(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(40):
        words = [rng.choice("ALPHA beta Gamma delta eps zeta eta theta iota".split()) + str(rng.randrange(50)) for _ in range(rng.randrange(1, 300))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.randrange(3)):
            w = list(words)
            w[rng.randrange(len(w))] = "changed"
            rows.append((len(rows) * 7 % 1000, "\t".join(w)))
    return rows


def groups(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


@pytest.mark.parametrize("tile", [simhash.TILE, 5])
def test_simhash_agrees_with_brute_force(docs_of, tile):
    rows = near_texts(4)
    want = by_simhash(rows)
    assert len({w[2] for w in want}) < len(want)
    assert groups(simhash.near_copies(docs_of(rows), tile=tile)) == want


def test_simhash_ragged_rows(docs_of, ragged):
    assert groups(simhash.near_copies(docs_of(ragged, clashing=True))) == by_simhash(ragged)
    assert groups(simhash.near_copies(docs_of([]))) == []
    assert groups(simhash.near_copies(docs_of([(None, "a")]))) == by_simhash([(None, "a")])


def test_simhash_near_links_of_any_prints(spark):
    """Random prints with planted neighbours; the tiles must lose none."""
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:60]:
        for _ in range(2):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))))
    prints = sorted(prints | {0, 1, (1 << 64) - 1})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame(list(enumerate(signed)), "node long, fp long")
    want = reach(range(len(prints)), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    for tile in (3, 1000):
        got = {r["node"]: r["root"] for r in components(simhash.near_links(nodes, 4, tile)).collect()}
        assert {n: got.get(n, n) for n in want} == want


def test_simhash_query_beside_brute_force(spark, tmp_path, docs_of):
    rows = near_texts(9)
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert groups(QUERIES["op5_simhash"](spark, str(tmp_path))) == by_simhash(rows)


def by_cosine(rows, least=0.9):
    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    unit = [np.array(v, float) / np.linalg.norm(v) if good(v) and i is not None else None for i, v in rows]
    links = [(a, b) for a in range(n) for b in range(n) if a != b and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least]
    same = [(a, b) for a in range(n) for b in range(a) if rows[a][0] == rows[b][0] and unit[a] is not None and unit[b] is not None]
    root, low = reach(range(n), links + same), {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root[k]] = min(low.get(root[k], i), i)
    many = [0] * n
    for a, _ in links:
        many[a] += 1
    return sorted(((i, many[k], low.get(root[k]), i is None or low[root[k]] == i) for k, (i, _) in enumerate(rows)), key=repr)


def vectors(seed=3, n=60, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        v = rng.standard_normal(size)
        rows.append((int(len(rows) * 13 % 1009), v.astype(np.float32).tolist()))
        for _ in range(rng.integers(0, 4)):
            rows.append((int(len(rows) * 13 % 1009), (v * rng.choice([1, 3]) + rng.standard_normal(size) * rng.choice([0, 0.05])).astype(np.float32).tolist()))
    return rows


def linked(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("tile", [pstable.TILE, 3])
def test_vectors_agree_with_brute_force(spark, tile):
    rows = vectors()
    got = linked(pstable.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), tile=tile))
    assert got == by_cosine(rows)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (4, v), (4, v), (2, [2.0, 4.0, 6.0]), (2, [0.0, 0.0, 5.0]), (9, None), (8, []), (7, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]),
        (3, [float("inf"), 1.0, 1.0]), (None, v), (1, [1.0, 2.0]), (11, [3.0, -1.0, 0.0]), (12, [1e-30, 2e-30, 3e-30]), (13, [1e30, 2e30, 3e30]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("bucket", F.lit(1)).withColumn("node", F.lit("x"))
    assert linked(pstable.near_vectors(df)) == by_cosine(rows)
    assert linked(pstable.near_vectors(df.where("vec_id > 100"))) == []


def test_recall_at_the_border():
    """Of pairs at a cosine of exactly 0.9 at least nine in ten share a bucket."""
    rng = np.random.default_rng(12)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    keys = [pstable.bucket_keys(x, pstable.TABLES, pstable.PROJECTIONS, pstable.WIDTH) for x in (a, b)]
    assert (keys[0] == keys[1]).any(axis=1).mean() >= 0.9


def test_embedding_query_finds_all_links(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert linked(QUERIES["op8_embeddings"](spark, sf)) == by_cosine(rows)


def fill_by_turns(shards, slots):
    """The table as described, with whole preference lists."""
    prefer = []
    for s in shards:
        at, skip = sharding.digest(f"{s}/offset") % slots, sharding.digest(f"{s}/skip") % (slots - 1) + 1
        prefer.append(iter([(at + j * skip) % slots for j in range(slots)]))
    owner = {}
    while len(owner) < slots:
        for k in range(len(shards)):
            if len(owner) < slots:
                owner[next(x for x in prefer[k] if x not in owner)] = k
    return [owner[i] for i in range(slots)]


@pytest.mark.parametrize("n, slots", [(1, 2), (3, 7), (10, 101), (64, 997)])
def test_slots_are_claimed_by_turns(n, slots):
    shards = [f"s{i}" for i in range(n)]
    got = sharding.lookup_slots(shards, slots)
    assert got == fill_by_turns(shards, slots)
    many = np.bincount(got, minlength=n)
    assert many.max() - many.min() <= 1


def test_few_keys_move_with_a_shard_less():
    before = sharding.lookup_slots(SHARDS, SLOTS)
    after = sharding.lookup_slots(SHARDS[:-1], SLOTS)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a < len(SHARDS) - 1)
    assert moved < 0.25 * SLOTS


@pytest.mark.parametrize("shards, slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2), (["a"], 10**9 + 7)])
def test_bad_tables(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_slots(shards, slots)


def test_placement(spark, docs_of, ragged):
    got = sharding.place(docs_of(ragged, clashing=True), "doc_id", ["a", "b", "c"], 31)
    owner = sharding.lookup_slots(["a", "b", "c"], 31)
    want = [(d, s := sharding.digest("" if d is None else str(d)) % 31, owner[s], "abc"[owner[s]]) for d, _ in ragged]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert sharding.place(docs_of([]), "doc_id", ["a"], 31).count() == 0
