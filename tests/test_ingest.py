import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketry.functions.chunking import pieces_by, split_by_kind, split_long_text, split_offsets, split_separators, split_tokens
from docketry.functions.text import extension, stem
from docketry.functions.text import element_key
from docketry.operators import ingest


def column(df, name):
    return sorted(r[name] for r in df.collect())


def test_gates_first_reason_wins(spark):
    requested = spark.createDataFrame([(p,) for p in ("/x/a.pdf", "/x/b.PDF", "/x/c.rst", "/x/d.exe", "/x/e.txt", "/x/gone.pdf", "/x/a.pdf")], "path string")
    listing = requested.where("path <> '/x/gone.pdf'").withColumn("length", F.lit(1))
    existing = spark.createDataFrame([("b.PDF",)], "document_name string")
    got = {r.document_name: r.reason for r in ingest.gate_files(requested, listing, existing, pdf_only=True).collect()}
    assert got["a.pdf"] is None and "exists" in got["b.PDF"] and "refused" in got["c.rst"]
    assert "not supported" in got["d.exe"] and "PDF" in got["e.txt"] and "not found" in got["gone.pdf"]


def test_size_reasons(spark):
    mb = 1024 * 1024
    files = spark.createDataFrame([("a.mp3", 30 * mb), ("b.MP3", 60 * mb), ("c.txt", 90 * mb), ("d.txt", 100 * mb + 1), ("e.exe", 1), ("noext", 1)], "name string, length long")
    got = files.select("name", ingest.size_reason(F.col("name"), F.col("length"), max_mb=100, max_audio_mb=50).alias("r"))
    assert {r.name: r.r for r in got.collect()} == {
        "a.mp3": None, "b.MP3": "audio file too large", "c.txt": None, "d.txt": "file too large",
        "e.exe": "file type not supported", "noext": "file type not supported",
    }
    plain = files.select("name", ingest.size_reason(F.col("name"), F.col("length"), max_mb=50).alias("r"))
    assert {r.name: r.r for r in plain.collect()}["b.MP3"] == "file too large"


def test_picture_keys_are_in_decimals(spark):
    df = spark.createDataFrame([("c", "f.pdf", 3, [0.0005, 12345678.5, 2.0, 0.12345])], "c string, f string, p int, box array<double>")
    got = df.select(element_key(F.col("c"), F.col("f"), F.col("p"), F.col("box")).alias("k")).first().k
    assert got == "c_::_f.pdf_::_3_0.0005_12345678.5_2.0_0.1235"


def test_reports(spark):
    requested = spark.createDataFrame([("/x/a",), ("/x/b",)], "path string")
    a = spark.createDataFrame([("a", "late")], "document_name string, reason string")
    b = spark.createDataFrame([("a", "early"), ("b", "other")], "document_name string, reason string")
    failures = ingest.failure_report([b, a])
    assert sorted(map(tuple, failures.collect())) == [("a", "early"), ("b", "other")]
    assert ingest.upload_report(requested, failures).first().state == "all failed"
    assert ingest.upload_report(requested, a).first().asDict() == {"total": 2, "failed": 1, "uploaded": 1, "state": "some failed"}
    assert ingest.upload_report(requested.limit(0), a).first().state == "empty"


def test_names(spark):
    df = spark.createDataFrame([("/a/b.tar.gz",), ("plain",), ("/x/.hidden",), ("c.",)], "p string")
    assert [tuple(r) for r in df.select(stem(F.col("p")), extension(F.col("p"))).collect()] == [
        ("b.tar", ".gz"), ("plain", ""), (".hidden", ""), ("c", "."),
    ]


def test_metadata_table(spark):
    files = spark.createDataFrame([("/u/a.txt",), ("/u/b.txt",), ("/u/c.txt",)], "path string")
    items = spark.createDataFrame(
        [("a.txt", '{"x": 1, "y": "", "it\'s": "q"}', 0), ("b.txt", '{"x": [], "z": [1, 2]}', 1), ("a.txt", '{"x": 2, "y": "", "it\'s": "q"}', 2)],
        "filename string, metadata string, pos long",
    )
    got = {r.filename: r.asDict() for r in ingest.metadata_table(files, items).collect()}
    assert got["a.txt"] == {"source": "/u/a.txt", "filename": "a.txt", "it's": "q", "x": "2", "y": None, "z": None}
    assert got["b.txt"]["x"] is None and got["b.txt"]["z"] == "[1,2]"
    assert got["c.txt"]["x"] is None


def element(kind, source="/d/f.pdf", content=None, subtype="", table=None, caption=None, audio=None, location=None, page=0):
    return (
        "c", 0, kind,
        (content, (source,), (kind, subtype, page, location), (table,), (caption,), (audio,)),
    )


ELEMENTS = (
    "collection string, pos int, document_type string, metadata struct<content:string,source_metadata:struct<source_id:string>,"
    "content_metadata:struct<type:string,subtype:string,page_number:int,location:array<double>>,table_metadata:struct<table_content:string>,"
    "image_metadata:struct<caption:string>,audio_metadata:struct<audio_transcript:string>>"
)


def test_element_texts_and_pictures(spark):
    df = spark.createDataFrame(
        [
            element("text", content="hello"), element("text", content=""), element("structured", subtype="table", table="t|1", location=[0.33333, 2.0]),
            element("structured", subtype="chart", table="c|1"), element("image", caption="cap", content="b64", location=[1.0]),
            element("image", content="b64"), element("audio", audio="said"), element("video", content="v"),
        ],
        ELEMENTS,
    )
    assert column(ingest.elements_to_chunks(df), "text") == ["c|1", "hello", "said", "t|1"]
    assert column(ingest.elements_to_chunks(df, tables=False, charts=False, images=True), "text") == ["cap", "hello", "said"]
    chunks = {r.text: (r.source, r.source_name, r.chunk_type) for r in ingest.elements_to_chunks(df).collect()}
    assert chunks["t|1"] == ("/d/f.pdf", "f.pdf", "table") and chunks["said"][2] == "audio"
    assert column(ingest.payload_rows(df), "element_key") == ["c_::_f.pdf_::_0_0.3333_2.0", "c_::_f.pdf_::_0_1.0"]
    stats = {r.type_label: (r.n_elements, r.text_chars) for r in ingest.ingest_statistics(df).collect()}
    assert stats["text"] == (2, 5) and stats["structured(table)"] == (1, 0) and stats["image"] == (2, 0)


def windows(words, size, overlap):
    step = size - overlap
    return [words[i : i + size] for i in range(0, max(len(words) - overlap - 1, 0) + 1, step)] if words else []


@pytest.mark.parametrize("size, overlap", [(4, 1), (3, 0), (5, 4), (50, 10)])
def test_token_windows(spark, size, overlap):
    texts = ["", "   ", "one", "a b c d", "a b c d e", " ".join(f"w{i}" for i in range(23))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = split_tokens(df, size=size, overlap=overlap).orderBy("i", "chunk_no").collect()
    want = [(i, n, " ".join(w), len(w)) for i, t in enumerate(texts) for n, w in enumerate(windows(t.split(), size, overlap))]
    assert [(r.i, r.chunk_no, r.chunk_text, r.n_tokens) for r in got] == want
    for i in range(len(texts) - 1):
        last = [w for w in want if w[0] == i]
        assert all(set(b[2].split()) - set(a[2].split()) for a, b in zip(last, last[1:], strict=False))


def test_window_arguments(spark):
    df = spark.createDataFrame([(1, "a b")], "i int, text string")
    for size, overlap in ((3, 3), (3, 5), (3, -1)):
        with pytest.raises(ValueError):
            split_tokens(df, size=size, overlap=overlap)


def test_split_by_kind(spark):
    df = spark.createDataFrame([(1, "text", "a b c"), (2, "pdf", "a  b c"), (3, None, "x y z"), (4, "pdf", "")], "i int, kind string, text string")
    got = sorted((r.i, r.chunk_no, r.chunk_text) for r in split_by_kind(df, "kind", size=2, overlap=0).collect())
    assert got == [(1, 0, "a b"), (1, 1, "c"), (2, 0, "a  b c"), (3, 0, "x y z")]
    assert split_by_kind(df, "kind", size=2, overlap=0, split_pdf=True).where("i = 2").count() == 2


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n", max_size=120), st.integers(5, 30), st.integers(0, 4))
def test_pieces_are_short_and_lose_nothing(text, limit, overlap):
    pieces = split_separators(text, limit, overlap)
    assert all(0 < len(p) <= limit for p in pieces)
    assert "".join("".join(pieces).split()) == "".join(text.split()) or overlap
    at = 0
    for piece in pieces:
        # each piece is found in order in the text, at or after the start of the one before
        at = text.index(piece, at)
    bare = "".join(split_separators(text, limit, 0))
    assert "".join(bare.split()) == "".join(text.split())


def test_pieces_by_coarsest_separator():
    assert split_separators("one two\n\nthree four", 12, 0) == ["one two", "three four"]
    assert split_separators("x" * 25, 10, 2) == ["x" * 10, "x" * 10, "x" * 9]


def test_only_long_texts_are_cut(spark):
    df = spark.createDataFrame([(1, "short text"), (2, "word " * 30), (3, "")], "i int, text string")
    got = split_long_text(df, limit=40, overlap=5).collect()
    assert [r.piece for r in got if r.i == 1] == ["short text"]
    assert len([r for r in got if r.i == 2]) > 3 and not [r for r in got if r.i == 3]


def test_documents_in_parts_and_folded(spark):
    rows = [("c", name, i, f"{name}{i}") for name, n in (("a", 3), ("hot", 25)) for i in range(n)]
    chunks = spark.createDataFrame(rows, "collection string, source_name string, pos int, text string").repartition(4)
    parts = ingest.document_texts(chunks, part_rows=10)
    got = {(r.source_name, r.part_no): r.text for r in parts.collect()}
    assert got[("a", 0)] == "a0 a1 a2" and sorted(p for n, p in got if n == "hot") == [0, 1, 2]
    assert " ".join(got[("hot", p)] for p in range(3)) == " ".join(f"hot{i}" for i in range(25))
    whole = {r.source_name: r.text for r in ingest.document_texts(chunks).collect()}
    assert whole == {name: " ".join(f"{name}{i}" for i in range(n)) for name, n in (("a", 3), ("hot", 25))}


@pytest.mark.parametrize("part_rows", [1, 3, 1_000, None])
def test_folds_do_not_depend_on_parts(spark, part_rows):
    # places in the text that are no count of rows
    rows = [("c", name, 1_500 * i, f"{name}{i}") for name, n in (("a", 3), ("hot", 25)) for i in range(n)]
    chunks = spark.createDataFrame(rows, "collection string, source_name string, pos int, text string").repartition(4)
    parts = ingest.document_texts(chunks, part_rows=part_rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        folded = ingest.fold_summaries(parts, lambda p: f"[{p}]", lambda s, p: f"{s}[{p}]", limit=20, overlap=0).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = "".join(f"[{p}]" for p in split_separators(" ".join(f"hot{i}" for i in range(25)), 20, 0))
    assert {r.file_name: r.summary for r in folded} == {"a": "[a0 a1 a2]", "hot": want}


def test_embedding(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "b")], "i int, text string")
    got = ingest.embed(df, lambda s: [[float(len(t)), 1.0] for t in s], 2).orderBy("i").collect()
    assert [r.vector for r in got] == [[2.0, 1.0], [1.0, 1.0]]
    with pytest.raises(Exception, match="3 numbers"):
        ingest.embed(df, lambda s: [[1.0]] * len(s), 3).collect()
    vectors, fitted = ingest.hashed_vectors(df, 64)
    again, _ = ingest.hashed_vectors(df.where("i = 1"), 64, fitted=fitted)
    assert again.first().vector == vectors.where("i = 1").first().vector and len(again.first().vector) == 64


def test_resume_and_summaries(spark):
    files = spark.createDataFrame([("/x/a",), ("/x/b",), ("/x/c",)], "path string")
    listed = spark.createDataFrame([("a", "zzz"), ("", "b")], "metadata_filename string, document_name string")
    assert column(ingest.resume(files, listed), "path") == ["/x/c"]
    asked = spark.createDataFrame([("c", "f"), ("c", "g")], "collection string, file_name string")
    known = spark.createDataFrame([("c", "f", "short")], "collection string, file_name string, summary string")
    assert {r.file_name: (r.summary, r.status) for r in ingest.look_up_summaries(asked, known).collect()} == {"f": ("short", "found"), "g": (None, "not found")}


def test_orphans(spark):
    files = spark.createDataFrame([("/x/a",), ("/x/b",)], "path string")
    items = spark.createDataFrame([("a", "{}"), ("z", "{}")], "filename string, metadata string")
    assert column(ingest.metadata_without_file(items, files), "filename") == ["z"]
    assert column(ingest.files_without_metadata(files, items, ["t"]), "filename") == ["b"]
    assert ingest.files_without_metadata(files, items, []).count() == 0
    assert pd.notna(ingest.files_without_metadata(files, items, ["t"]).first().error)


@pytest.mark.parametrize("size, overlap", [(3, 0), (3, 1), (5, 4), (100, 10)])
def test_offset_windows_give_the_text_back(spark, size, overlap):
    texts = [" \n lead  and\ttrail \n", "one", "", "  ", None, "a b\n\nc  d e f g\th i j k é \U0001f600 l m n o p", " ".join(map(str, range(60)))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    by_three = pieces_by(lambda column: column.map(lambda t: [t[k : k + 3] for k in range(0, len(t), 3)]))
    for pieces, none in ((None, {2, 3, 4}), (by_three, {2, 4})):
        rows = split_offsets(df, size=size, overlap=overlap, **({"pieces": pieces} if pieces else {})).orderBy("i", "chunk_no").collect()
        back, at = {}, {}
        for r in rows:
            assert r.chunk_text == texts[r.i][r.start : r.stop] and 0 < r.n_tokens <= size and r.chunk_no == at.get(r.i, (-1, 0))[0] + 1
            assert r.start <= at.get(r.i, (0, 0))[1] < r.stop
            back[r.i] = back.get(r.i, "") + r.chunk_text[at.get(r.i, (0, 0))[1] - r.start :]
            at[r.i] = (r.chunk_no, r.stop)
        assert back == {i: t for i, t in enumerate(texts) if i not in none}


def test_pieces_have_to_give_the_text_back(spark):
    df = spark.createDataFrame([("a b",)], "text string")
    with pytest.raises(Exception, match="do not give the text back"):
        split_offsets(df, pieces=pieces_by(lambda column: column.str.split(" "))).collect()


def test_pieces_of_a_batch_are_not_held_at_once(spark, monkeypatch):
    """Texts go to a user's tokenizer in stretches of bounded size, and come back in their order."""
    from docketry.functions import chunking

    most = chunking.CUT_CHARS

    def cut(column):
        if column.str.len().sum() > most and len(column) > 1:
            raise ValueError("too much at once")
        return column.map(lambda t: [t[k : k + 1_000] for k in range(0, len(t), 1_000)])

    texts = [None if i % 7 == 3 else chr(97 + i) * (most + 5 if i == 5 else most // 3) for i in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    rows = df.select("i", "text", pieces_by(cut)("text").alias("p")).collect()
    assert {r.i: r.p and "".join(r.p) for r in rows} == dict(enumerate(texts))


def test_windows_move_without_the_text_of_their_document(spark, tmp_path):
    from docketry.plans.files import byte_token_windows

    words = [" ".join(f"{kind}{k}é" for k in range(400)) for kind in ("left", "right")]
    rows = [(1, words[0]), (1, words[1]), (2, words[0]), (2, words[0]), (None, "a"), (None, words[1]), (3, ""), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = byte_token_windows(spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("Window [lag") : plan.index("Generate posexplode")]
    assert "chunk_text#" in moved and not re.search(r"\btext#", moved)
    got = sorted(map(tuple, df.collect()), key=repr)
    # one row per id and text, also where an id has two texts
    assert got == sorted([(i, len(t), True) for i, t in {r for r in rows if r[1]}], key=repr)


def test_byte_tokens_begin_where_the_library_says(monkeypatch):
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    from docketry.plans import files

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    monkeypatch.setattr(files, "pieces_by", lambda cut: cut)
    cut = files._byte_tokens(path, public_tokenizers.PATTERN)
    texts = ["", "plain words", "é", "日本語 テキスト 😀😀", "\x80\x85 ｱｱｱ", "🏳️\u200d🌈 a\u0301"]
    for text, pieces in zip(texts, cut(pd.Series(texts)), strict=True):
        starts = sorted({0, *library.decode_with_offsets(library.encode_ordinary(text))[1]})
        assert pieces == [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True) if a < b]


def test_kinds_with_a_tokenizer_of_ones_own(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "text", "a,b,c"), (2, "pdf", "a,b,c")], "i int, kind string, text string")
    got = sorted((r.i, r.chunk_text, r.n_tokens) for r in split_by_kind(df, "kind", size=2, overlap=0, tokenize=lambda t: F.split(t, ",")).collect())
    assert got == [(1, "a b", 2), (1, "c", 1), (2, "a,b,c", 3)]


def test_typed_metadata_table(spark):
    files = spark.createDataFrame([("/u/a.txt",), ("/u/b.txt",), ("/u/c.txt",)], "path string")
    rows = [
        ("a.txt", '{"n": 1, "r": 1.5, "ok": true, "t": "q", "l": [1, 2], "m": 1, "o": {"k": 1}, "z": null, "w": [1, "a"], "it\'s": [true]}', 1),
        ("b.txt", '{"n": "", "r": 2, "ok": null, "t": "", "l": [], "m": "one", "filename": "other"}', 2),
        ("a.txt", '{"n": "old"}', 0), ("c.txt", "not json", 3),
    ]
    got = ingest.typed_metadata_table(files, spark.createDataFrame(rows, "filename string, metadata string, pos long"))
    assert got.select("metadata.*").dtypes == [("it's", "array<boolean>"), ("l", "array<bigint>"), ("m", "string"), ("n", "bigint"), ("o", "string"), ("ok", "boolean"), ("r", "double"), ("t", "string"), ("w", "string")]
    by = {r.filename: r.metadata.asDict() if r.metadata else None for r in got.collect()}
    assert by["a.txt"] == {"it's": [True], "l": [1, 2], "m": "1", "n": 1, "o": '{"k":1}', "ok": True, "r": 1.5, "t": "q", "w": '[1,"a"]'}
    assert {k: v for k, v in by["b.txt"].items() if v is not None} == {"m": "one", "r": 2.0}
    assert not any(v is not None for v in by["c.txt"].values())
    assert ingest.typed_metadata_table(files, spark.createDataFrame([], "filename string, metadata string, pos long")).columns == ["source", "filename"]
