import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docketry.operators import keyword, search, tiles
from docketry.session import work_path

CHUNKS = "collection string, chunk_id long, vector array<float>"
QUERIES = "query_id long, vector array<float>"


def vectors(n, d=6, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    out = rng.integers(-3, 4, size=(n, d)).astype("float32")
    if copies:
        out[:copies] = out[0]
    return out


def make(spark, n, q, copies=0):
    cv, qv = vectors(n, copies=copies), vectors(q, seed=2)
    chunks = spark.createDataFrame([("ab"[i % 3 == 0], i, cv[i].tolist()) for i in range(n)], CHUNKS)
    queries = spark.createDataFrame([(i, qv[i].tolist()) for i in range(q)], QUERIES)
    return chunks, queries, cv, qv


def brute(cv, qv, k, per_collection=True):
    out = set()
    for q, v in enumerate(qv):
        d = ((cv.astype(float) - v.astype(float)) ** 2).sum(1)
        groups = {"b": [i for i in range(len(cv)) if i % 3 == 0], "a": [i for i in range(len(cv)) if i % 3]}
        if not per_collection:
            groups = {None: range(len(cv))}
        for g, ids in groups.items():
            for rank, i in enumerate(sorted(ids, key=lambda i: (d[i], i))[:k], 1):
                out.add((q, g, i, d[i], rank))
    return out


@pytest.mark.parametrize("bounds", [{}, {"broadcast_bytes": 0, "tile_rows": 7}, {"broadcast_bytes": 0, "tile_rows": 1000}])
@pytest.mark.parametrize("n, k, copies", [(90, 4, 0), (90, 5, 40), (5, 9, 0)])
def test_exact_search_is_brute_force(spark, bounds, n, k, copies):
    chunks, queries, cv, qv = make(spark, n, 11, copies)
    hits = search.vector_top_k(chunks.repartition(3), queries, k, **bounds)
    got = {tuple(r) for r in hits.select("query_id", "collection", "chunk_id", "distance", "rank").collect()}
    assert got == brute(cv, qv, k)
    overall = search.vector_top_k(chunks, queries, k, per_collection=False, **bounds)
    got = {(r.query_id, None, r.chunk_id, r.distance, r.rank) for r in overall.collect()}
    assert got == brute(cv, qv, k, per_collection=False)


def test_many_small_batches(spark):
    chunks, queries, cv, qv = make(spark, 200, 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        hits = search.vector_top_k(chunks.coalesce(1), queries, 3)
        got = {tuple(r) for r in hits.select("query_id", "collection", "chunk_id", "distance", "rank").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(cv, qv, 3)


@pytest.mark.parametrize("bounds", [{}, {"broadcast_bytes": 0, "tile_rows": 16}])
def test_cells(spark, bounds):
    chunks, queries, cv, qv = make(spark, 120, 20)
    cells = search.train_cells(chunks, cells=6)
    celled = cells.assign(chunks)
    every = search.cell_top_k(celled, queries, cells, 3, probes=6, **bounds)
    got = {tuple(r) for r in every.select("query_id", "collection", "chunk_id", "distance", "rank").collect()}
    assert got == brute(cv, qv, 3)
    some = search.cell_top_k(celled, queries, cells, 3, probes=3, **bounds).collect()
    # what is found is the best of the probed cells
    cell_of = {r.chunk_id: r.cell for r in celled.collect()}
    probed = {}
    for r in cells.nearest(queries, 3).collect():
        probed.setdefault(r.query_id, set()).add(r.cell)
    want = set()
    for q, v in enumerate(qv):
        d = ((cv.astype(float) - v.astype(float)) ** 2).sum(1)
        for g in (0, 1):
            ids = [i for i in range(len(cv)) if (i % 3 == 0) == bool(g) and cell_of[i] in probed[q]]
            want |= {(q, i) for i in sorted(ids, key=lambda i: (d[i], i))[:3]}
    assert {(r.query_id, r.chunk_id) for r in some} == want


def test_blocks_of_queries(spark, monkeypatch):
    """Passes over the items, a block of queries each, find what one pass finds."""
    monkeypatch.setattr(tiles, "MOST_COPIES", 0)
    chunks, queries, cv, qv = make(spark, 90, 11, 40)
    hits = search.vector_top_k(chunks.repartition(3), queries, 4, broadcast_bytes=200)
    assert "CoGroup" not in hits._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in hits.select("query_id", "collection", "chunk_id", "distance", "rank").collect()} == brute(cv, qv, 4)
    overall = search.vector_top_k(chunks, queries, 4, per_collection=False, broadcast_bytes=200).collect()
    assert {(r.query_id, None, r.chunk_id, r.distance, r.rank) for r in overall} == brute(cv, qv, 4, per_collection=False)
    # a query has several routes into one group
    cells = search.train_cells(chunks, cells=6)
    every = search.cell_top_k(cells.assign(chunks), queries, cells, 3, probes=6, broadcast_bytes=900)
    assert {tuple(r) for r in every.select("query_id", "collection", "chunk_id", "distance", "rank").collect()} == brute(cv, qv, 3)
    docs = spark.createDataFrame(DOCS, "collection string, chunk_id long, text string")
    asked = spark.createDataFrame(ASKED, "query_id long, text string")
    for searched in (docs, keyword.write_index(docs, work_path(spark, "index"))):
        got = keyword.keyword_top_k(searched, asked, 3, broadcast_bytes=100)
        assert {(r.query_id, r.collection, r.chunk_id, r["rank"]) for r in got.collect()} == bm25(DOCS, ASKED, 3)


def test_rows_do_not_go_to_many_tiles(spark):
    """Items and queries of one route stay where they are if each would go to more tiles than MOST_COPIES."""
    many, one = ([[f"c{i % n}", i, [float(i), 0.0]] for i in range(120)] for n in (120, 1))
    plans = []
    for rows in (many, one):
        items = spark.createDataFrame(rows, "route string, item_id long, vector array<float>").withColumn("grp", F.lit("a"))
        asked = spark.createDataFrame(rows, "route string, query_id long, vector array<float>")
        found = tiles.best_pairs(items, asked, tiles.SquaredDistance(), 1, "8", broadcast_bytes=2_000, tile_rows=10)
        assert {(r.query_id, r.item_id, r.score) for r in found.collect()} == {(i, i, 0.0) for i in range(120)}
        plans.append("CoGroup" in found._jdf.queryExecution().optimizedPlan().toString())
    assert plans == [True, False]


def test_vectors_of_two_lengths_are_refused(spark):
    chunks = spark.createDataFrame([("a", 1, [1.0]), ("a", 2, [1.0, 2.0])], CHUNKS)
    queries = spark.createDataFrame([(1, [1.0])], QUERIES)
    with pytest.raises(Exception, match="one length"):
        search.vector_top_k(chunks.coalesce(1), queries, 1).collect()


def test_empty_sides(spark):
    chunks, queries, *_ = make(spark, 10, 3)
    assert search.vector_top_k(chunks.limit(0), queries, 2).count() == 0
    assert search.vector_top_k(chunks, queries.limit(0), 2).count() == 0


def test_depths_and_checks():
    assert search.search_depth(rerank=True) == 100
    assert search.search_depth(rerank=False) == 10
    for bad in ((0, 10), (5, 10)):
        with pytest.raises(ValueError):
            search.search_depth(True, *bad)
    assert search.check_search("dense", ["a", "b"], rerank=True) == ["a", "b"]
    for args in (("sparse", ["a"], True), ("dense", [], True), ("dense", ["a", "b"], False), ("dense", list("abcdef"), True)):
        with pytest.raises(ValueError):
            search.check_search(*args)


# ---------------------------------------------------------------- keyword


def split(text):
    return [t for t in re.split(r"[^\w]+|_", text.lower()) if t]


def bm25(docs, asked, k):
    out = set()
    for g in {d[0] for d in docs}:
        own = [(i, split(t)) for c, i, t in docs if c == g]
        mean = sum(len(t) for _, t in own) / len(own)
        df = Counter(w for _, t in own for w in set(t))
        for q, text in asked:
            scores = []
            for i, t in own:
                tf = Counter(t)
                s = sum(
                    uses * math.log(1 + (len(own) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2
                    / (tf[w] + 1.2 * (0.25 + 0.75 * len(t) / mean))
                    for w, uses in Counter(split(text)).items() if tf[w]
                )
                if s > 0:
                    scores.append((-round(s, 6), i))
            out |= {(q, g, i, rank) for rank, (_, i) in enumerate(sorted(scores)[:k], 1)}
    return out


DOCS = [
    ("a", 1, "the cat sat on the mat"), ("a", 2, "a dog and a cat"), ("a", 3, "cat cat cat"), ("a", 4, "nothing here"),
    ("b", 5, "the the the the"), ("b", 6, "dog eats dog"), ("b", 7, ""), ("a", 8, "the cat sat on the mat"),
]
ASKED = [(1, "the cat"), (2, "dog dog mat"), (3, "unknown words"), (4, "it's \\ 'quoted'")]


@pytest.mark.parametrize("bounds", [{}, {"vocabulary_limit": 1}, {"broadcast_bytes": 0, "tile_rows": 2}, {"vocabulary_limit": 1, "broadcast_bytes": 0, "tile_rows": 3}])
def test_keyword_scores(spark, bounds):
    docs = spark.createDataFrame(DOCS, "collection string, chunk_id long, text string")
    asked = spark.createDataFrame(ASKED, "query_id long, text string")
    want = bm25(DOCS, ASKED, 3)
    for searched in (docs, keyword.write_index(docs, work_path(spark, "index"))):
        got = keyword.keyword_top_k(searched, asked, 3, **bounds)
        assert {(r.query_id, r.collection, r.chunk_id, r["rank"]) for r in got.collect()} == want


@pytest.mark.parametrize("shared, block", [(0.0, 7), (0.02, 7), (2.0, 7), (0.02, 1_000)])
def test_keyword_scores_in_blocks(monkeypatch, shared, block):
    """Terms of a matrix product and terms added pair by pair give the same best chunks, block after block."""
    import random

    import pyarrow as pa

    rng = random.Random(3)
    some = lambda n: [f"w{min(60, int(rng.paretovariate(0.5)))}" for _ in range(n)]
    texts = [" ".join(some(rng.choice([1, 5, 30]))) for _ in range(90)] + [""]
    asked = [(i, " ".join(some(rng.choice([1, 4, 9])))) for i in range(25)]
    monkeypatch.setattr(tiles, "ITEM_BLOCK", block)
    monkeypatch.setattr(tiles, "QUERY_BLOCK", 10)
    monkeypatch.setattr(tiles, "PRODUCT", 3)
    monkeypatch.setattr(tiles, "SPAN", 20)
    monkeypatch.setattr(tiles.TermWeights, "shared", shared)
    once = [Counter(t.split()) for t in texts]
    df = Counter(w for own in once for w in own)
    weights = [{w: n * math.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5)) for w, n in Counter(q.split()).items() if df[w]} for _, q in asked]
    queries = pa.table({"query_id": [q for q, _ in asked], "route": ["a"] * 25, "terms": [list(w) for w in weights], "weights": [list(w.values()) for w in weights], "mean_len": [sum(map(sum, (c.values() for c in once))) / len(texts)] * 25})
    fixed = {"item_id": range(len(texts)), "grp": ["a"] * len(texts), "route": ["a"] * len(texts), "doc_len": [sum(c.values()) for c in once]}
    for own in ({"terms": [t.split() for t in texts]}, {"terms": [list(c) for c in once], "tfs": [list(c.values()) for c in once]}):
        items = pa.table(fixed | own, pa.schema([("item_id", pa.int64()), ("grp", pa.string()), ("route", pa.string()), ("doc_len", pa.int32()), ("terms", pa.list_(pa.string())), *([("tfs", pa.list_(pa.int32()))] if "tfs" in own else [])]))
        out = pa.Table.from_batches(list(tiles._score_batches(items.to_batches(), queries, tiles.TermWeights(1.2, 0.75), 4))).to_pylist()
        got = {(r["query_id"], "a", r["item_id"], rank) for q, _ in asked for rank, r in enumerate(sorted((r for r in out if r["query_id"] == q), key=lambda r: (r["score"], r["item_id"])), 1)}
        assert got == bm25([("a", i, t) for i, t in enumerate(texts)], asked, 4)


def test_index_has_a_word_of_a_chunk_once(spark):
    docs = spark.createDataFrame([*DOCS, ("a", 9, None)], "collection string, chunk_id long, text string")
    rows = {r.chunk_id: r for r in keyword.write_index(docs, work_path(spark, "index")).terms.collect()}
    assert {i: (rows[i].doc_len, dict(zip(rows[i].terms, rows[i].tfs, strict=True))) for i in (1, 3, 7, 9)} == {
        1: (6, {"the": 2, "cat": 1, "sat": 1, "on": 1, "mat": 1}), 3: (3, {"cat": 3}), 7: (0, {}), 9: (None, {}),
    }


def test_one_hot_term(spark):
    """A word in nearly every document, and many copies of one text."""
    rows = [("a", i, "common word") if i % 3 else ("a", i, f"common rare{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "collection string, chunk_id long, text string").repartition(5)
    asked = spark.createDataFrame([(1, "common"), (2, "rare6 common")], "query_id long, text string")
    got = {(r.query_id, r.collection, r.chunk_id, r["rank"]) for r in keyword.keyword_top_k(docs, asked, 4).collect()}
    assert got == bm25(rows, [(1, "common"), (2, "rare6 common")], 4)


def test_fused_ranks(spark):
    cols = "query_id long, collection string, chunk_id long, rank int"
    dense = spark.createDataFrame([(1, "a", 10, 1), (1, "a", 11, 2)], cols)
    sparse = spark.createDataFrame([(1, "a", 11, 1), (1, "a", 12, 2)], cols)
    got = keyword.fuse_ranks(dense, sparse, 3).orderBy("rank").collect()
    assert [r.chunk_id for r in got] == [11, 10, 12]
    assert got[0].score == 1 / 62 + 1 / 61 and got[1].sparse_rank is None
    assert pd.notna(got[2].sparse_rank)


def test_filter_comes_before_the_cut(spark):
    rows = [("a", 1, [0.0], ("x",)), ("a", 2, [1.0], ("y",)), ("a", 3, [5.0], ("y",))]
    chunks = spark.createDataFrame(rows, CHUNKS + ", content_metadata struct<kind:string>")
    queries = spark.createDataFrame([(1, [0.0])], QUERIES)
    from docketry.operators.metadata import Field

    hits = search.filtered_top_k(chunks, queries, {"op": "==", "field": "kind", "value": "Y"}, [Field("kind", "string")], 1)
    assert [r.chunk_id for r in hits.collect()] == [2]
    assert hits.select(F.col("distance")).first()[0] == 1.0


def test_a_word_in_every_chunk_is_a_hit(spark):
    """Its weight is too small to show in the score."""
    chunks = spark.createDataFrame([("c", i, "the " + "x " * 3000) for i in range(40)], "collection string, chunk_id long, text string")
    asked = spark.createDataFrame([(1, "the")], "query_id long, text string")
    got = keyword.keyword_top_k(chunks, asked, 10, k1=1e-7).collect()
    assert sorted(r.chunk_id for r in got) == list(range(10))


def test_tiles_stay_within_their_bound(spark):
    """Ten pages a document and one hot document: page numbers and hot routes make no tile large."""
    pages = spark.range(20_000).select(
        (F.col("id") % 10).alias("item_id"), F.lit(None).cast("string").alias("grp"), (F.col("id") / 10).cast("long").cast("string").alias("route")
    )
    hot = spark.range(20_000).select(F.col("id").alias("item_id"), F.lit(None).cast("string").alias("grp"), F.lit("hot").alias("route"))
    cut = tiles.with_tiles(pages.union(hot), "8", ["route", "grp", "item_id"], "item_tile", 100, 400)
    found = cut.groupBy("bucket", "item_tile").count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
    assert found[0] < 2 * 400 and found[1] == 40_000 and found[2] >= 100


def test_last_cut_in_two_steps(spark):
    pairs = spark.range(5_000).select(
        (F.col("id") % 3).alias("query_id"), F.lit(None).cast("string").alias("grp"), F.col("id").alias("item_id"), (F.col("id") % 7).cast("double").alias("score")
    )
    got = {(r.query_id, r.rank): r.item_id for r in tiles._cut(pairs, 40).collect()}
    for q in range(3):
        want = sorted(range(q, 5_000, 3), key=lambda i: (i % 7, i))[:40]
        assert [got[q, n] for n in range(1, 41)] == want


def test_cells_read_only_probed_folders(spark):
    chunks, queries, _, _ = make(spark, 120, 1)
    cells = search.train_cells(chunks, cells=6)
    path = work_path(spark, "few cells")
    search.write_cells(chunks, cells, path)
    hits = search.cell_top_k(spark.read.parquet(path), queries, cells, 3, probes=2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


@pytest.mark.parametrize("most", [1, 40, 10_000])
def test_what_a_task_holds_is_bounded(monkeypatch, most):
    """Groups that come and go in a task: states leave early, and the best of all that left stay the same."""
    import numpy as np
    import pyarrow as pa

    from docketry.operators import tiles

    rng = np.random.default_rng(1)
    routes = np.array(["a", "b", "c"])
    queries = pa.table({"query_id": range(30), "route": routes[np.arange(30) % 3], "vector": list(rng.normal(size=(30, 4)))})
    n = 600
    grp, vectors = rng.integers(0, 12, n), rng.normal(size=(n, 4))
    items = pa.table({"item_id": range(n), "grp": [f"g{g}" for g in grp], "route": routes[grp % 3], "vector": list(vectors)})
    monkeypatch.setattr(tiles, "MOST_HELD", most)
    monkeypatch.setattr(tiles, "ITEM_BLOCK", 50)
    held, real = [], tiles._States.of

    def of(self, key):
        yield from real(self, key)
        held.append((self.held, len(self.states)))

    monkeypatch.setattr(tiles._States, "of", of)
    out = pa.Table.from_batches(list(tiles._score_batches(items.to_batches(), queries, tiles.SquaredDistance(), 3)), tiles._PAIR_ARROW).to_pylist()
    assert all(h <= most or s == 1 for h, s in held) and max(h for h, _ in held) <= max(most, 30)
    best = {}
    for r in out:
        best.setdefault((r["query_id"], r["grp"]), []).append((r["score"], r["item_id"]))
    assert len(out) == (360 if most > 400 else len(out)) and len(best) == 120
    asked = np.stack(queries["vector"].to_pylist())
    for (q, g), hits in best.items():
        own = np.flatnonzero(grp == int(g[1:]))
        want = sorted((float(((vectors[i] - asked[q]) ** 2).sum()), int(i)) for i in own)[:3]
        assert [i for _, i in sorted(hits)[:3]] == [i for _, i in want]


def test_a_tile_holds_one_route_and_one_state(spark, monkeypatch):
    """Rows of a tile come in any order; states and queries are held one after the other all the same."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    n = 400
    routes = np.array(["a", "b", None, "none asks"], dtype=object)[rng.integers(0, 4, n)]
    groups = np.array(["x", "y", None], dtype=object)[rng.integers(0, 3, n)]
    rows = rng.normal(size=(n, 4))
    items = pa.table({"item_id": range(n), "grp": pa.array(groups, pa.string()), "route": pa.array(routes, pa.string()), "vector": list(rows)})
    asked = pa.table({"query_id": range(30), "route": pa.array(["a", "b", None] * 10, pa.string()), "vector": list(rng.normal(size=(30, 4)))})
    held, real = [], tiles._States.of

    def of(self, key):
        yield from real(self, key)
        held.append((len(self.ids), len(self.states)))

    monkeypatch.setattr(tiles._States, "of", of)
    own = dict(tiles._by_route(asked, ["route"]))
    out = [r for route, part in tiles._by_route(items, ["route", "grp"]) if route in own for b in tiles._score_batches(part.to_batches(), own[route], tiles.SquaredDistance(), 3, 0) for r in b.to_pylist()]
    assert set(held) == {(1, 1)} and len(held) == 9
    vectors_asked = np.stack(asked["vector"].to_pylist())
    want = set()
    for q in range(30):
        for g in ("x", "y", None):
            near = [i for i in range(n) if routes[i] == ["a", "b", None][q % 3] and groups[i] == g]
            want |= {(q, g, i) for i in sorted(near, key=lambda i: ((rows[i] - vectors_asked[q]) ** 2).sum())[:3]}
    assert {(r["query_id"], r["grp"], r["item_id"]) for r in out} == want and len(out) == len(want)


@pytest.fixture(scope="module")
def posted(spark):
    """Chunks of words with very uneven frequencies, an index of small blocks, and queries."""
    import random

    from docketry.operators import postings

    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    some = lambda n: " ".join(vocabulary[min(299, int(rng.paretovariate(0.6)) - 1)] for _ in range(n))
    rows = [(("a", "b")[i % 3 == 0], i, some(rng.choice([3, 20, 20, 60]))) for i in range(1_500)] + [("a", 2_000 + i, "w250 w251 w0") for i in range(30)]
    chunks = spark.createDataFrame(rows, "collection string, chunk_id long, text string").persist()
    queries = spark.createDataFrame([(i, some(rng.choice([1, 3, 8, 20]))) for i in range(20)] + [(90, "w250 w0 w1"), (91, "nothing known"), (92, "")], "query_id long, text string")
    return chunks, postings.write_postings(chunks, work_path(spark, "postings"), block=64), queries


@pytest.mark.parametrize("k, k1, b", [(1, 1.2, 0.75), (10, 1.2, 0.75), (5, 2.0, 0.1)])
def test_postings_give_what_scoring_every_chunk_gives(posted, k, k1, b):
    from docketry.operators.postings import posting_top_k

    chunks, index, queries = posted
    columns = ["query_id", "collection", "chunk_id", "score", "rank"]
    got = sorted(tuple(r) for r in posting_top_k(index, queries, k, k1, b).select(*columns).collect())
    want = sorted(tuple(r) for r in keyword.keyword_top_k(chunks, queries, k, k1, b).select(*columns).collect())
    assert got == want and len(got) > 20 * k


def test_most_blocks_of_common_words_are_skipped(posted):
    from docketry.operators.postings import chosen_blocks

    _, index, queries = posted
    every, _ = chosen_blocks(index, queries, 3)
    common = every.where("term in ('w0', 'w1', 'w2')").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("skipped"), F.col("n"))).alias("skipped")).first()
    assert common.skipped > 0.5 * common.n
    assert every.where("skipped and least is null").isEmpty()


def test_a_search_reads_the_folders_of_its_terms(spark, posted):
    """Folders that hold no asked term are not read, and no block is large."""
    from docketry.operators import postings

    _, index, _ = posted
    one = postings._asked_blocks(index, spark.createDataFrame([("w250",)], "term string"))
    one.collect()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "PartitionFilters: [folder" in plan
    assert one.select("folder").distinct().count() == 1
    assert index.blocks.select("folder").distinct().count() > 30
    assert index.blocks.agg(F.max("n")).first()[0] <= 2 * 64


def test_postings_stay_with_their_chunk(spark):
    """Only rows with one and the same chunk_id are moved to be counted together."""
    from docketry.operators import postings

    def found(rows):
        return postings._postings(keyword.split_chunks(spark.createDataFrame(rows, "collection string, chunk_id long, text string")))

    plain = found([("a", 1, "x y x"), ("b", 1, "x"), ("a", None, "z")])
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r)[1:] for r in plain.where("chunk_id = 1").collect()) == [("x", 1, 1, 1), ("x", 1, 2, 3), ("y", 1, 1, 3)]
    twice = found([("a", 1, "x y x"), ("a", 1, "x y x"), ("a", 2, "x"), ("a", None, "z"), ("a", None, "z")])
    assert sorted((r.term, r.chunk_id or 0, r.tf) for r in twice.collect()) == [("x", 1, 4), ("x", 2, 1), ("y", 1, 2), ("z", 0, 2)]


@pytest.fixture
def dealt(spark, posted, monkeypatch):
    """The chunks of `posted` with an index of seven segments."""
    from docketry.operators import postings

    monkeypatch.setattr(postings, "_segments", lambda totals: 7)
    chunks, _, queries = posted
    return chunks, postings.write_postings(chunks, work_path(spark, "postings"), block=64), queries


def test_a_chunk_lies_in_one_segment(dealt):
    """So a search adds up what a chunk scores where its postings are, and a query's plan does not grow with them."""
    from docketry.operators import postings

    _, index, queries = dealt
    of_chunk = index.blocks.select("segment", "collection", F.explode("postings.chunk_id").alias("chunk_id")).groupBy("collection", "chunk_id")
    assert of_chunk.agg(F.countDistinct("segment").alias("n")).agg(F.max("n")).first()[0] == 1
    assert index.blocks.select("segment").distinct().count() == 7
    every, _ = postings.chosen_blocks(index, queries, 3)
    assert every.groupBy("query_id", "collection", "term").count().agg(F.max("count")).first()[0] <= postings.LEVELS
    assert every.groupBy("query_id", "collection", "term", "level").count().where("count > 1").isEmpty()
    assert index.blocks.count() > 3 * every.select("collection", "term", "level").distinct().count()


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_segments_give_what_scoring_every_chunk_gives(dealt, monkeypatch, most):
    """Also if the queries are too many to be broadcast."""
    from docketry.operators import postings

    monkeypatch.setattr(postings, "SMALL_ROWS", most)
    chunks, index, queries = dealt
    columns = ["query_id", "collection", "chunk_id", "score", "rank"]
    got = sorted(tuple(r) for r in postings.posting_top_k(index, queries, 5).select(*columns).collect())
    assert got == sorted(tuple(r) for r in keyword.keyword_top_k(chunks, queries, 5).select(*columns).collect())


def test_a_search_moves_no_row_per_query_and_posting(dealt):
    """Blocks go to their segments once, however many queries read them."""
    from docketry.operators import postings

    _, index, queries = dealt
    many = queries.union(queries.selectExpr("query_id + 1000", "text"))
    plan = postings.posting_top_k(index, many, 5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Generate" not in plan and "SortMergeJoin" not in plan


def test_rows_that_share_a_chunk_give_no_threshold(spark):
    """What they score together no single one of them does, so others are not left out for it."""
    from docketry.operators import postings

    rows = [("a", 1, "x y z"), ("a", 1, "x y z u v w"), ("a", 1, "x z y r s t q p o n m l")] + [("a", 2, "x y z y h")] + [("a", i, f"x n{i} m{i}") for i in range(3, 90)]
    rows += [("b", 1, "x y"), ("b", None, "x y z x y z"), ("b", None, "x"), ("b", 3, "y z g h")]
    index = postings.write_postings(spark.createDataFrame(rows, "collection string, chunk_id long, text string"), work_path(spark, "postings"), block=4)
    queries = spark.createDataFrame([(1, "x y z"), (2, "z"), (3, "y u x")], "query_id long, text string")
    every = sorted(tuple(r) for r in postings.posting_top_k(index, queries, 1_000).collect())
    assert len(every) > 150
    for k in (1, 2, 3, 4):
        assert sorted(tuple(r) for r in postings.posting_top_k(index, queries, k).collect()) == [r for r in every if r[4] <= k]
