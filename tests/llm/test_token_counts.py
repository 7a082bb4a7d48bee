"""Token counts beside the library, with chunks small enough that every seam matters."""

import random
from pathlib import Path

import pytest

from docketry.llm import token_counts as T
from docketry.llm.queries import COUNTED, QUERIES

DATA = Path(COUNTED).read_text()


@pytest.fixture(scope="module")
def tokenizer():
    return T.loaded(DATA)


def mixed(rng, n):
    """Words, contractions, long runs of a sign, long words, other scripts, whole and cut added tokens."""
    out = []
    while sum(map(len, out)) < n:
        kind = rng.random()
        if kind < 0.15:
            out.append(rng.choice("abcdefgh =-_#\n\t.") * rng.randrange(1, 300))
        elif kind < 0.3:
            out.append("<|endoftext|>"[: rng.choice([13, 13, 7])])
        elif kind < 0.4:
            out.append("".join(rng.choice("éß中文\U0001f600\U0001f468‍عرب") for _ in range(rng.randrange(60))))
        elif kind < 0.5:
            out.append("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(500))))
        elif kind < 0.6:
            out.append(rng.choice(["don't", "we'll  ", "it'd've", " \r\n\r\n  x", "   "]) * rng.randrange(9))
        else:
            out.append(" ".join("".join(rng.choice("etaoinshrdlu'") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(30))))
    return "".join(out)


RUNS = ["a" * 5_000, "=" * 3_001 + "x" * 2_999, "abc" * 1_500, "中" * 2_000, " " * 3_000 + "x", "'" * 3_000, "\U0001f600" * 900, "'ll" * 1_200, "<|endoftext|>" * 200, "1" * 4_000, "x" + "-" * 4_000 + "y"]


def library(tokenizer, rows, limit=1024):
    many = [(d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    return sorted(((*r, r[2] > limit) for r in many), key=repr)


def result(df):
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_common_border_is_right(tokenizer):
    """Each border that two pieces share, not only the first, gives the whole text's tokens."""
    rng, near, seen = random.Random(1), T.margin(DATA), 0
    for _ in range(150):
        text = mixed(rng, 1_500)
        want = len(tokenizer.encode(text, add_special_tokens=False).ids)
        cut = rng.randrange(400, 900)
        left, right = T.Piece.of(tokenizer, text[: cut + 200], 0), T.Piece.of(tokenizer, text[cut:], cut)
        a, b = left.between(cut + near, left.stop - near), right.between(cut + near, left.stop - near)
        before, after = dict(zip(left.mark[a].tolist(), (left.at[a] + 1).tolist())), dict(zip(right.mark[b].tolist(), (right.n - 1 - right.at[b]).tolist()))
        for mark in before.keys() & after.keys():
            assert before[mark] + after[mark] == want
            seen += 1
    assert seen > 2_000


@pytest.mark.parametrize("chunk, overlap", [(170, 84), (600, 100)])
def test_pieces_one_after_the_other(tokenizer, chunk, overlap):
    rng, near = random.Random(2), T.margin(DATA)
    for text in RUNS + [mixed(rng, 3_000) for _ in range(60)]:
        assert T.in_steps(tokenizer, text, near, chunk, overlap) == len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("chunk, overlap", [(170, 84), (1_000, 200), (T.CHUNK, T.OVERLAP)])
def test_counts_are_those_of_the_library(docs_of, ragged, tokenizer, chunk, overlap):
    rng = random.Random(3)
    rows = ragged + list(enumerate(RUNS + [mixed(rng, rng.choice([10, 300, 2_000])) for _ in range(40)], 100))
    rows += rows[-5:]  # repeated
    assert result(T.token_counts(docs_of(rows, clashing=True), DATA, chunk=chunk, overlap=overlap)) == library(tokenizer, rows)


def test_texts_out_of_step_are_told_apart(spark, docs_of, tokenizer):
    """Words align in the overlap; a run of one sign that starts out of step does not."""
    shared, near = spark.sparkContext.broadcast(DATA), T.margin(DATA)
    rows = [("words", "one two three " * 400), ("run", "x" + "-" * 4_001)]
    got = {r["key"]: r for r in T.long_counts(spark.createDataFrame(rows, "key string, text string"), shared, near, 300, 100).collect()}
    assert not got["words"]["open"] and got["run"]["open"]
    assert got["words"]["n_tokens"] == len(tokenizer.encode(rows[0][1], add_special_tokens=False).ids)


def test_no_rows_and_limits(docs_of, tokenizer):
    assert result(T.token_counts(docs_of([]), DATA)) == []
    rows = [(1, "word " * 10), (2, "word " * 9)]
    assert result(T.token_counts(docs_of(rows), DATA, limit=10)) == library(tokenizer, rows, 10)
    with pytest.raises(ValueError, match="overlap"):
        T.token_counts(docs_of(rows), DATA, chunk=100, overlap=90)


def test_other_kinds_of_tokenizer_are_refused():
    import json

    given = json.loads(DATA)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"added_tokens": [{**given["added_tokens"][0], "lstrip": True}]}, {"added_tokens": [{**given["added_tokens"][0], "content": c} for c in ("<a>", ">b<")]}):
        with pytest.raises(ValueError):
            T.margin(json.dumps(given | change))


def test_query_beside_the_library(spark, tmp_path, docs_of, tokenizer):
    rng = random.Random(5)
    rows = [(i, mixed(rng, n)) for i, n in enumerate([5, 400, 3_000, 50_000, 120_000])] + [(9, "=" * 70_000), (10, None)]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert result(QUERIES["op11_token_counts"](spark, str(tmp_path))) == library(tokenizer, rows)


def test_pieces_are_those_of_the_library(tokenizer):
    """Every character that is split here, in all neighbourhoods that the pattern tells apart."""
    import regex

    split = regex.compile(T.SPLIT).findall
    for code in range(ord(T.LAST_PLAIN) + 1):
        c = chr(code)
        text = f"a{c}1{c}.{c} {c}a{c}{c}  {c}'{c}'ll{c}\n{c}"
        assert [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)] == split(text)


def test_pieces_encoded_in_a_row(tokenizer, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(T, "MOST_PIECES", 50)
    counter = T.Counter(DATA)
    for _ in range(20):
        texts = [mixed(rng, rng.randrange(400)) for _ in range(30)] + ["", "Ünïcödé wörds и слова", "plain words here"]
        assert counter.of(texts) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
