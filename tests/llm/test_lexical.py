"""Ranked lexical search beside scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from docketry.llm import lexical
from docketry.llm.lexical import Items, TIERS, ranked_search, terms_of, weighted, written_index
from docketry.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, most=50):
    """(item number, rank, doc_id, score) by scoring every document; equal rows have equal ranks' scores."""
    counted = [(d, Counter(ts), len(ts)) for d, t in docs if (ts := split(t))]
    n, total = len(counted), sum(x for _, _, x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for i, text in items:
        own = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(split(text)) if df[t]}
        scores = []
        for d, c, size in counted:
            m = 100 - 50 + (50 * size * n) // total
            s = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t, w in own.items() if c[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:most], 1)]
    return sorted(out, key=repr)


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, key string, score string")


def corpus(seed, n=400):
    """Texts of words with very uneven frequencies, some long, with groups of copies."""
    rng = random.Random(seed)
    words = [f"{rng.choice(['', 'é', 'X', '中'])}w{i}" for i in range(900)]
    some = lambda k: [words[min(899, int(rng.paretovariate(0.7)) - 1)] for _ in range(k)]
    docs = [(i, rng.choice([" ", ", ", "-"]).join(some(rng.choice([0, 1, 5, 40, 40, 200, 3000 if i % 40 == 0 else 60])))) for i in range(n)]
    docs += [(n + i, docs[50][1]) for i in range(120)] + [(2 * n + i, docs[51][1].upper()) for i in range(60)]
    items = [(i, " ".join(some(rng.choice([1, 3, 12, 60])))) for i in range(25)] + [(90, docs[50][1]), (91, docs[7][1])]
    return docs, items


def test_terms():
    odd = "don't STOP_it é’s A1b2\x7fc\x80dK İ [x]{y}`z` \U0001f600@me 0:9;"
    assert [t.decode() for t in terms_of(odd)] == split(odd)
    assert terms_of(None) == terms_of(" \t--") == []


@pytest.mark.parametrize("item_bytes", [lexical.ITEM_BYTES, 600])
def test_agrees_with_scoring_everything(spark, docs_of, item_bytes):
    docs, items = corpus(1)
    want = brute(docs, items)
    assert len(want) > 600
    assert result(ranked_search(docs_of(docs, clashing=True), items_of(spark, items), item_bytes=item_bytes)) == want


@pytest.mark.parametrize("most, bits", [(1, 10), (7, 1)])
def test_any_number_and_crowded_signatures(spark, docs_of, monkeypatch, most, bits):
    monkeypatch.setattr(lexical, "BITS", bits)
    docs, items = corpus(2)
    assert result(ranked_search(docs_of(docs), items_of(spark, items), most=most)) == brute(docs, items, most)


def test_without_broadcast(spark, docs_of, monkeypatch):
    monkeypatch.setattr(lexical, "MOST_BROADCAST", -1)
    docs, items = corpus(3, n=150)
    assert result(ranked_search(docs_of(docs), items_of(spark, items))) == brute(docs, items)


def test_ragged_rows(spark, docs_of, ragged):
    items = [(1, ragged[0][1]), (1, ragged[0][1]), (2, None), (None, "wolf dog"), (3, ""), (4, "no such term"), (5, "w1 W4 one a"), (6, ragged[10][1])]
    assert result(ranked_search(docs_of(ragged, clashing=True), items_of(spark, items))) == brute(ragged, items)
    assert result(ranked_search(docs_of([]), items_of(spark, items))) == []
    assert result(ranked_search(docs_of([(1, None), (2, " ")]), items_of(spark, items))) == []
    assert result(ranked_search(docs_of(ragged), items_of(spark, []))) == []


def test_bounds_are_never_too_low_and_exclude_most(spark, docs_of):
    docs, items = corpus(4)
    index = written_index(docs_of(docs))
    sizes = [len(split(t)) for _, t in docs if split(t)]
    own: Items = weighted(index, items, len(sizes), sum(sizes))
    exact = {}
    for d, t in docs:
        words = terms_of(t)
        counts, length = Counter(words), lexical.norm(len(words), own.docs, own.total)
        exact[d] = [own.score(k, counts, length) for k in range(len(items))]
    keyed = {r["key"]: r["doc_id"] for r in lexical.with_key(docs_of(docs)).collect()}
    above, pairs = 0, 0
    for r in index.where("bits is not null").collect():
        bounds = own.bounds(r["bits"], r["n"], r["top"], bytes(r["slices"]))
        want = np.array([exact[keyed[k]] for k in r["keys"]]).T
        assert (bounds >= want).all()
        kth = np.array([sorted((x[k] for x in exact.values()), reverse=True)[49] for k in range(len(items))])
        above += int(((bounds >= kth[:, None]) & (want < kth[:, None])).sum())
        pairs += want.size
    assert above < 0.1 * pairs


def test_blocks_are_bounded(monkeypatch):
    monkeypatch.setattr(lexical, "MOST_BITS", 1 << 16)
    monkeypatch.setattr(lexical, "MOST_TERMS", 500)
    builder, rows = lexical.Builder(), []
    for i in range(300):
        rows += builder.add(i, " ".join(f"t{i}x{j}" for j in range(i % 40 * 20)))
    rows += builder.rest()
    for bits, keys, *_, slices, terms, _counts in rows:
        if bits is None:
            assert len(terms) < 500 + 800
        else:
            assert len(keys) <= max(8, (1 << 16) // bits) and len(slices) == bits * -(-len(keys) // 8)
    assert sorted(k for r in rows if r[0] for k in r[1]) == [i for i in range(300) if i % 40]
    assert list(TIERS) == sorted(TIERS)


def test_query_beside_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert result(QUERIES["op13_ranked_search"](spark, sf)) == brute(docs, items)
