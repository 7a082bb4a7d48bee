"""The byte and word window operators beside brute force."""

import hashlib
import random

import numpy as np
import pytest

from docketry.llm import recompress, repeats, suffixes
from docketry.llm.common import LAST
from docketry.llm.queries import QUERIES


def brute(rows, window, split, join, within):
    """What each row keeps, by a table of every window's first place."""
    key = lambda d: LAST if d is None else d
    docs = [(key(d), split(t or "")) for d, t in rows]
    least, out = {}, []
    for d, e in docs:
        for k in range(len(e) - window + 1):
            w = tuple(e[k : k + window])
            least[w] = min(least.get(w, LAST), d)
    for (raw, _), (d, e) in zip(rows, docs, strict=True):
        gone, seen = np.zeros(len(e) + 1, int), set()
        for k in range(len(e) - window + 1):
            w = tuple(e[k : k + window])
            if least[w] < d or within and w in seen:
                gone[k] += 1
                gone[k + window] -= 1
            seen.add(w)
        gone = np.cumsum(gone[:-1]) > 0 if len(e) else np.zeros(0, bool)
        kept = join([x for x, g in zip(e, gone, strict=True) if not g])
        out.append((raw, len(e), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def by_bytes(rows, window=50):
    return brute(rows, window, lambda t: t.encode(), bytes, False)


def by_words(rows, window=20):
    return [(r[0], r[1], r[2], r[4]) for r in brute(rows, window, lambda t: t.encode().split(), b" ".join, True)]


def found(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)


BYTES, WORDS = ("n_bytes", "n_removed", "n_spans", "kept_sha256"), ("n_words", "n_removed", "kept_sha256")


def texts_with_copies(seed, n=60):
    """Texts of few different words, with passages of each other and repeated words."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcd" for b in ("", "x", "yz")]
    texts = []
    for _ in range(n):
        t = [rng.choice(words) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            if texts:
                other = rng.choice(texts)
                a = rng.randrange(len(other) + 1)
                t[(k := rng.randrange(len(t) + 1)) : k] = other[a : a + rng.randrange(60)]
        if rng.random() < 0.2:
            t += [rng.choice(words)] * rng.randrange(45)
        texts.append(t)
    ids = list(range(n))
    rng.shuffle(ids)
    return [(i, rng.choice((" ", "  ", "\n")).join(t)) for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("seed", range(3))
def test_bytes_agree_with_brute_force(docs_of, seed):
    rows = texts_with_copies(seed)
    assert found(suffixes.without_earlier_bytes(docs_of(rows)), *BYTES) == by_bytes(rows)


@pytest.mark.parametrize("seed", range(3))
def test_words_agree_with_brute_force(docs_of, seed):
    rows = texts_with_copies(seed + 10)
    assert found(recompress.without_earlier_words(docs_of(rows)), *WORDS) == by_words(rows)


def test_ragged_rows(docs_of, ragged):
    assert found(suffixes.without_earlier_bytes(docs_of(ragged, clashing=True)), *BYTES) == by_bytes(ragged)
    assert found(recompress.without_earlier_words(docs_of(ragged, clashing=True)), *WORDS) == by_words(ragged)


def test_kept_texts(docs_of):
    base = "0123456789" * 5
    rows = {r["doc_id"]: bytes(r["kept"]) for r in suffixes.without_earlier_bytes(docs_of([(1, base), (2, "<" + base + ">"), (3, base[:49])])).collect()}
    assert rows == {1: base.encode(), 2: b"<>", 3: base[:49].encode()}
    words = " ".join(f"w{i}" for i in range(20))
    got = {r["doc_id"]: r["kept"] for r in recompress.without_earlier_words(docs_of([(1, words), (2, f"a  {words}\tb {words}")])).collect()}
    assert got == {1: words, 2: "a b"}


def test_empty_table(docs_of):
    assert found(suffixes.without_earlier_bytes(docs_of([])), *BYTES) == []
    assert found(recompress.without_earlier_words(docs_of([])), *WORDS) == []


def test_only_short_texts(docs_of):
    rows = [(1, "a"), (2, "a"), (3, None)]
    assert found(suffixes.without_earlier_bytes(docs_of(rows)), *BYTES) == by_bytes(rows)
    assert found(recompress.without_earlier_words(docs_of(rows)), *WORDS) == by_words(rows)


@pytest.mark.parametrize("scheme", [suffixes.byte_scheme(50), recompress.word_scheme(20)])
def test_anchors_follow_from_the_window_alone(scheme):
    """Equal windows get the same anchor name wherever they are and however texts are cut."""
    rows = texts_with_copies(3, 40)
    texts = [t.encode() for _, t in rows]
    name_of = {}
    for piece in (scheme.piece, 64, 100_000):
        one = repeats.Scheme(scheme.window, piece, scheme.within, scheme.sieve, scheme.elements, scheme.batch)
        for b in one.batches(texts, []):
            for f, z, n, r, s in zip(b.first, b.last, b.name, b.row, b.start, strict=True):
                own = one.elements(texts[r])
                for k in range(z - f + 1):
                    w = tuple(own[s + k : s + k + one.window])
                    assert name_of.setdefault(w, n) == n
    seen = sum(max(0, len(scheme.elements(t)) - scheme.window + 1) for t in texts)
    assert seen and len(name_of) <= seen


def test_words_are_split_and_named_alike_in_long_texts(monkeypatch):
    monkeypatch.setattr(recompress, "STRETCH", 64)
    rng = random.Random(1)
    name_of = {}
    for _ in range(60):
        text = "".join(rng.choice(" \t\n\r\x0b\x0c" + "abé" * 3) for _ in range(rng.randrange(900))) + "x" * rng.choice((0, 300)) + " y"
        words = text.encode().split()
        names = recompress.word_names(text.encode())
        assert len(names) == len(words)
        for w, n in zip(words, names.tolist(), strict=True):
            assert name_of.setdefault(w, n) == n
    assert len(set(name_of.values())) == len(name_of)
    assert len(recompress.word_names(b" \n ")) == len(recompress.word_names(b"")) == 0


def test_names_of_documents_and_planes_round_trip():
    ids = np.array([5, 7, 1 << 40, LAST], np.int64)
    assert (repeats.unpacked(repeats.packed(ids), 4) == ids).all()
    assert (repeats.unpacked(repeats.packed(ids[:2]), 2) == ids[:2]).all()
    v = np.arange(7, dtype=np.uint64) * 12345678901234567
    assert (repeats.unplaned(repeats.planes(v), np.uint64, 7) == v).all()


@pytest.mark.parametrize("name, columns, brute_force", [("op3_suffix_dedup", BYTES, by_bytes), ("op9_recompression", WORDS, by_words)])
def test_queries_beside_brute_force(spark, tmp_path, docs_of, name, columns, brute_force):
    rows = texts_with_copies(21, 80)
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert found(QUERIES[name](spark, str(tmp_path)), *columns) == brute_force(rows)


def thue_morse(power, letters="ab"):
    word = "0"
    for _ in range(power):
        word += word.translate(str.maketrans("01", "10"))
    return word.translate(str.maketrans("01", letters))


def test_words_that_sums_of_powers_confuse(spark, tmp_path, docs_of):
    """A word of 1,024 letters and its complement have one polynomial modulo 2**64, but are two words."""
    rest = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{thue_morse(10)} {rest}"), (2, f"{thue_morse(10, 'ba')} {rest}"), (3, f"{thue_morse(10)} {rest}")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = found(QUERIES["op9_recompression"](spark, str(tmp_path)), *WORDS)
    assert got == by_words(rows) and [r[2] for r in got] == [0, 0, 20]


def test_words_have_names_of_their_own():
    rng = random.Random(6)
    words = {bytes(rng.choice(b"ab\xc3\xa9\x00") for _ in range(rng.randrange(1, 90))) for _ in range(20_000)} | {b"a" * n for n in range(1, 3_000, 7)} | {thue_morse(n, x).encode() for n in range(12) for x in ("ab", "ba")}
    text = b" ".join(words)
    names = recompress.word_names(text)
    assert len(names) == len(words) == len(set(names.tolist()))
    assert (recompress.word_names(b"\n" + text * 2) == np.r_[recompress.word_names(text * 2)]).all()
    for w, name in list(zip(text.split(), names, strict=True))[::97]:
        assert recompress.word_names(b"x " * 5 + w)[5] == name == recompress.word_names(w + b"\tyz")[0]


def test_windows_with_a_half_in_common_are_checked_apart(monkeypatch):
    """If all names of parts were equal, the check would still tell windows apart."""
    for scheme, text in ((recompress.word_scheme(20), b" ".join(b"w%d" % (i % 37) for i in range(200))), (suffixes.byte_scheme(50), bytes(i * i % 251 for i in range(400)))):
        batch = next(iter(scheme.batches([text], [])))
        at = np.arange(scheme.elements(text) is not text and 150 or 300)
        unlike = {}
        for k, c in zip(at.tolist(), batch.check(at).tolist(), strict=True):
            own = tuple(text.split()[k : k + 20]) if scheme.within else text[k : k + 50]
            assert unlike.setdefault(own, c) == c
        assert len(set(unlike.values())) == len(unlike)


def test_one_word_of_many_bytes_takes_little_memory():
    import tracemalloc

    text = b"a b " + b"x" * 8_000_000 + b" c"
    tracemalloc.start()
    names = recompress.word_names(text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(names) == 4 and most < 10 * len(text)


def test_short_texts_are_named_together(monkeypatch):
    """As each by itself, in a pass per stretch and not per text."""
    texts = [b"", b"a bb ccc", b" \n", b"ends with blank\t", b"w%d " % 7 * 300, b"\x0bx" * 40, b"y" * 100 + b" z", b"", b"\xc3\xa9 a"] * 30
    texts += [b"long words " * 30_000, b"z" * 300_000 + b" q", b"a b"]
    want = [recompress.word_names(t) for t in texts]
    passes = []
    named = recompress._named
    monkeypatch.setattr(recompress, "_named", lambda piece: passes.append(len(piece)) or named(piece))
    got = list(recompress.word_scheme(20).several(texts))
    assert len(got) == len(want) and all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
    assert len(passes) < 10 and max(passes) <= 300_002


def test_runs_are_judged_once_at_the_end(monkeypatch):
    """What the earlier rounds said of the runs is read once, not once more for the windows that are left."""
    import pyarrow as pa

    table = pa.table({"doc_id": [1, 2, 3], "text": ["p q r s " * 20, "p q r s " * 20 + "t", " ".join(f"w{i}" for i in range(50))]})
    scheme = recompress.word_scheme(20)

    def told(bits):
        bucket, out = repeats.Bucket(scheme, table, 1, bits), {}
        for r in repeats.ask(bucket, 0, max([0, *bits]) + (1 if not bits else 1 if 1 in bits and 2 not in bits else 2)).to_pylist():
            if r["to"] >= 0:
                out.setdefault(r["round"], {})[r["part"]] = repeats.bits_of([r])[0]
        return bits | out

    bits = told(told(told({})))
    assert sorted(bits) == [1, 2, 4]
    bucket, calls = repeats.Bucket(scheme, table, 1, bits), []
    candidates = bucket.candidates
    bucket.candidates = lambda: calls.append(1) or candidates()
    row, place = repeats.repeated_starts(bucket)
    first, second = set(place[row == 0].tolist()), set(place[row == 1].tolist())
    assert first == set(range(4, 61)) and second == set(range(61)) and not (row == 2).any()
    assert len(calls) == 1
