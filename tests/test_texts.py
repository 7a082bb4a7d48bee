import pytest
from pyspark.sql import functions as F

from docketry.functions import text as tx
from docketry.operators import citations, converse, evaluation, usage
from docketry.sources.payloads import delete_payloads, get_payloads, list_payloads, put_payloads


def apply(spark, function, *values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_text_functions(spark):
    assert apply(spark, tx.strip_think, "a<think>x\ny</think>b<think>z", "<think>1</think><think>2</think>c") == ["ab", "c"]
    assert apply(spark, tx.collapse_blank_lines, " a\n \n\nb\n") == ["a\nb"]
    assert apply(spark, tx.filter_reply, "no_filter", "<think>a</think>\nUnsupported: x", "", "<think>open", " f == 1 \n\n") == [None] * 4 + ["f == 1"]
    assert apply(spark, tx.numbered_items, "Intro\n1. First. Really\n 2) second\n\n3. ") == [["First. Really", "2) second", "3."]]
    assert apply(spark, tx.follow_up, " 'what \"now\"?' ", "''", " ") == ["what now?", None, None]
    assert apply(spark, tx.escape_braces, '{"a": {}}') == ['{{"a": {{}}}}']
    assert apply(spark, tx.strip_html, "a <b>c</b><!-- x > y -->d\n<img\nsrc='q'>") == ["a cd\n"]
    assert apply(spark, tx.role_name, "USER", "<i>System</i>", "robot") == ["user", "system", None]
    assert apply(spark, tx.preview, "x" * 500, "x" * 501) == ["x" * 500, "x" * 500 + "... [content truncated]"]


MESSAGES = "conv_id long, turn long, role string, text string"


def test_conversations(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"m{t}") for t in range(40)] + [
        (2, 0, "system", "be {kind}"), (2, 1, "user", "hi {x}"), (2, 2, "assistant", "  "), (2, 3, "system", "and short"), (2, 4, "assistant", "yes"),
        (3, 0, "assistant", "alone"),
    ]
    m = spark.createDataFrame(rows, MESSAGES)
    assert converse.last_messages(m).where("conv_id = 1").agg(F.min("turn"), F.count("*")).first()[:] == (10, 30)
    history = {r.conv_id: r.history for r in converse.history_text(m).collect()}
    assert history[1].split("\n")[0] == "User: m10" and history[2] == "User: hi {x}\nAssistant:   \nAssistant: yes"
    combined = {(r.conv_id, r.part_no): r.text for r in converse.combined_query(m, part_rows=10).collect()}
    assert combined[(1, 0)] == ". ".join(f"m{t}" for t in range(0, 20, 2)) and combined[(1, 1)].endswith("m38")
    assert {r.conv_id: r.text for r in converse.combined_query(m).collect()} == {1: ". ".join(f"m{t}" for t in range(0, 40, 2)), 2: "hi {x}"}
    assert {r.conv_id: r.text for r in converse.combined_query(m, last_n=1).collect()} == {1: "m36. m38", 2: "hi {x}"}
    request = converse.split_request(m)
    assert {r.conv_id: r.query for r in request["query"].collect()} == {1: "m38", 2: "hi {{x}}"}
    left = sorted((r.turn, r.text) for r in request["history"].where("conv_id = 2").collect())
    assert left == [(0, "be {{kind}}"), (3, "and short"), (4, "yes")]
    assert request["history"].where("conv_id = 3").count() == 1
    prompts = {r.conv_id: r.prompt for r in converse.system_prompt(m, "Base").collect()}
    assert prompts == {1: "Base", 2: "Base be {kind} and short", 3: "Base"}
    late = spark.createDataFrame([(1, 1500, "system", "S"), (1, 99_000, "system", "T"), (1, 99_001, "user", "u")], MESSAGES)
    assert [tuple(r) for r in converse.system_prompt(late, "Base").collect()] == [(1, "Base S T")]


def test_multipart(spark):
    parts = "array<struct<type:string,text:string,url:string>>"
    df = spark.createDataFrame(
        [(0, [("text", " a ", None), ("image_url", None, "u"), ("text", "", None)]), (1, [("text", "x", None), ("text", "y", None)]), (2, [])],
        f"i int, p {parts}",
    )
    p = F.col("p")
    got = [tuple(r) for r in df.orderBy("i").select(converse.content_text(p), converse.content_query(p), converse.has_image(p)).collect()]
    assert got == [(" a  ", "a\n\nu", True), ("x y", "x\n\ny", False), ("", "", False)]


PAYLOADS = "element_key string, collection string, file_name string, content string, put_at long"


def test_payloads(spark):
    stored = spark.createDataFrame([("a_1", "a", "f", "old", 1), ("b_1", "b", "f", "x", 1)], PAYLOADS)
    new = spark.createDataFrame([("a_1", "a", "f", "new", 2), ("a_2", "a", "g", "y", 2)], PAYLOADS)
    every = put_payloads(stored, new)
    assert {r.element_key: r.content for r in every.collect()} == {"a_1": "new", "a_2": "y", "b_1": "x"}
    keys = spark.createDataFrame([("a_1",), ("zz",)], "element_key string")
    assert {r.element_key: r.content for r in get_payloads(keys, every).collect()} == {"a_1": "new", "zz": ""}
    assert sorted(r[0] for r in list_payloads(every, "a_").collect()) == ["a_1", "a_2"]
    assert delete_payloads(every, list_payloads(every, "a_")).count() == 1


def test_citations(spark):
    hits = spark.createDataFrame(
        [
            (1, "c", 1, "words", "/d/a.pdf", False, 0.5, ("text", None, None, None)),
            (1, "c", 2, "said", "/d/a.mp3", False, None, ("audio", None, None, None)),
            (1, "c", 3, "caption", "/d/a.pdf", False, 0.1, ("image", None, 2, [1.0, 2.5])),
            (1, "c", 4, "table", "/d/a.pdf", False, 0.1, ("structured", "table", 2, [9.0])),
            (1, "c", 5, "graph", "/d/a.pdf", False, 0.1, ("structured", "graph", 3, [1.0])),
            (1, "c", 6, "bare", "/d/b.txt", True, 0.1, (None, None, None, None)),
            (1, "c", 7, "odd", "/d/b.txt", False, 0.1, ("video", None, None, None)),
            (1, "c", 8, "", "/d/b.txt", False, 0.1, ("text", None, None, None)),
            (1, "c", 9, "no box", "/d/a.pdf", False, 0.1, ("image", None, 2, None)),
        ],
        "query_id long, collection string, rank int, text string, source_id string, plain_source boolean, score double, "
        "content_metadata struct<type:string,subtype:string,page_number:int,location:array<double>>",
    )
    payloads = spark.createDataFrame(
        [("c_::_a.pdf_::_2_1.0_2.5", "c", "a.pdf", "PNG", 0), ("c_::_a.pdf_::_3_1.0", "c", "a.pdf", "PNG3", 0)], PAYLOADS
    )
    got = {r["rank"]: (r.content, r.document_name, r.document_type, r.score) for r in citations.cite(hits, payloads).collect()}
    assert got == {
        1: ("words", "a.pdf", "text", 0.5), 2: ("said", "a.mp3", "audio", 0.0), 3: ("PNG", "a.pdf", "image", 0.1), 6: ("bare", "b.txt", "text", 0.1),
    }
    found = citations.visual_hits(hits, payloads)
    assert sorted((r["rank"], r.picture) for r in found.collect()) == [(3, "PNG"), (5, "PNG3")]
    asked = spark.createDataFrame([(1, 7, "Q7"), (1, 2, "Q2")], "query_id long, rank int, picture string")
    shown = citations.pictures_shown(asked, found)
    assert {(r.origin, r["rank"], r.picture) for r in shown.collect()} == {("question", 1, "Q2"), ("context", 1, "PNG")}
    with pytest.raises(ValueError):
        citations.pictures_shown(asked, found, total=1)
    assert citations.citation_counts(citations.cite(hits, payloads)).first().total_results == 4


def test_recall(spark):
    truth = spark.createDataFrame(
        [(1, 0, "a_b.pdf", "3"), (1, 1, "a_b.pdf", "3"), (1, 2, "c.pdf", "1"), (2, 0, "d.pdf", ""), (2, 1, "e.pdf", "7"), (3, 0, "f", "1")],
        "question_id long, pos int, filename string, page string",
    )
    hits = spark.createDataFrame(
        [(1, 1, "a_b.pdf_4"), (1, 2, "a_b.pdf_3"), (1, 3, "a_b.pdf_3"), (2, 1, "e.pdf_1"), (2, 4, "d.pdf_9")],
        "question_id long, rank int, name string",
    )
    got = {(r.question_id, r.granularity, r.k): r.recall for r in evaluation.recall_by_question(truth, hits).collect()}
    assert got[(1, "page", 1)] == 0 and got[(1, "page", 3)] == pytest.approx(1 / 3)
    assert got[(1, "document", 1)] == pytest.approx(1 / 3) and got[(1, "document", 10)] == pytest.approx(1 / 3)
    # without a page on the first truth row both granularities compare documents
    assert got[(2, "page", 1)] == got[(2, "document", 1)] == 0.5 and got[(2, "page", 5)] == 1.0
    assert not [key for key in got if key[0] == 3]
    recall = evaluation.recall_by_question(truth, hits)
    means = {(r.granularity, r.k): (r.n_questions, r.mean_recall) for r in evaluation.mean_recall(recall, 3).collect()}
    assert set(k for _, k in means) == {1, 3} and means[("document", 1)] == (2, pytest.approx((1 / 3 + 0.5) / 2))
    every = evaluation.mean_recall(recall, 3, questions=truth.select("question_id").distinct())
    assert every.where("k = 1 and granularity = 'document'").first().mean_recall == pytest.approx((1 / 3 + 0.5) / 3)


def test_ground_truth(spark):
    questions = spark.createDataFrame(
        [("q", "?", "!", [("doc", 4, "text"), ("rep.pdf", None, "the second page says hello"), ("rep.pdf", None, "zzzz"), ("doc", None, None)])],
        "question_id string, question string, reference string, evidence array<struct<doc_name:string,evidence_page_num:long,evidence_text_full_page:string>>",
    )
    pages = spark.createDataFrame(
        [("rep.pdf", 0, "first"), ("rep.pdf", 1, "the second page says hello!"), ("rep.pdf", 2, "the second page says hello!")],
        "doc_name string, page_no int, page_text string",
    )
    rows = evaluation.ground_truth(questions, pages, ".pdf").orderBy("pos").collect()
    assert [(r.filename, r.page) for r in rows] == [("doc.pdf", "4"), ("rep.pdf", "1"), ("rep.pdf", "0"), ("doc.pdf", "")]


def test_best_pages_is_brute_force(spark):
    from difflib import SequenceMatcher

    words = "alpha beta gamma delta epsilon zeta".split()
    pages = [(d, n, " ".join(words[(n * 7 + i * (n + 1) + len(d)) % 6] for i in range(n % 5 + 2))) for d in ("a", "hot") for n in range(12)]
    asked = [(d, p, d, " ".join(words[(p + i) % 6] for i in range(p + 2))) for d in ("a", "hot", "none") for p in range(4)]
    p_df = spark.createDataFrame(pages, "doc_name string, page_no int, page_text string").repartition(3)
    e_df = spark.createDataFrame(asked, "question_id string, pos int, doc_name string, evidence_text string")
    want = set()
    for q, pos, d, text in asked:
        ratios = [(-SequenceMatcher(None, t, text).ratio(), n) for name, n, t in pages if name == d]
        want.add((q, pos, min(ratios)[1] if ratios else 0))
    for bounds in ({}, {"broadcast_bytes": 0, "tile_rows": 5}):
        assert {tuple(r) for r in evaluation.best_pages(e_df, p_df, **bounds).collect()} == want


def test_page_names(spark):
    assert [tuple(x) for x in apply(spark, evaluation.split_page_name, "a_b_3", "a_b.pdf", "plain", "x.pdf_12")] == [
        ("a_b", "3"), ("a_b.pdf", ""), ("plain", ""), ("x.pdf", "12"),
    ]


def test_buckets(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (5.1,), (10_001.0,)], "v double")
    assert [r[0] for r in df.select(usage.bucket_bound(F.col("v"))).collect()] == [0.0, 5.0, 10.0, None]


def test_few_pages_are_compared_in_full(monkeypatch):
    """Of 20 texts and 50 pages the most similar ones, as all pairs give them, from few full comparisons."""
    import random
    from difflib import SequenceMatcher

    import numpy as np

    from docketry.operators import evaluation

    rng = random.Random(3)
    letters = [rng.sample("abcdefghijklmnopqrstuvwxyzéß中 .,", 12) for _ in range(10)]
    pages = ["".join(rng.choice(letters[i % 10]) for _ in range(rng.randrange(30, 150))) for i in range(48)] + ["", "xyz"]
    texts = ["".join(c for c in rng.choice(pages) if rng.random() < 0.9) for _ in range(18)] + ["", "\U0001f600"]
    want = [[SequenceMatcher(None, p, t).ratio() for t in texts] for p in pages]
    many, real = [], SequenceMatcher.ratio
    monkeypatch.setattr(SequenceMatcher, "ratio", lambda self: many.append(1) or real(self))
    kernel = evaluation.SimilarText()
    sides = [(x, evaluation.histograms(x)) for x in (pages, texts)]
    got, _ = kernel.rough(*sides, np.full(len(texts), np.inf))
    for col in range(len(texts)):
        best = max(row[col] for row in want)
        first = next(k for k, row in enumerate(want) if row[col] == best)
        if texts[col] and best > 0:
            assert got[:, col].min() == -best and int(np.argmin(got[:, col])) == first
        else:
            assert not np.isfinite(got[:, col]).any()
    assert len(many) < 0.15 * len(pages) * len(texts)
