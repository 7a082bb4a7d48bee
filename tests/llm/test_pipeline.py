"""The pipeline beside plain versions of its stages, and with odd rows."""

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_groups import by_simhash
from test_tokens import base_of, by_sets

import corpus_pipeline
from docketry.llm import secrets, tokens, toxicity
from docketry.llm.queries import PATTERN, RANKS


@pytest.fixture(scope="module")
def ranks(spark):
    return tokens.read_ranks(spark, RANKS)


def plain(rows, labels, items, ranks):
    """doc_id, token number and text of what the stages leave of rows (doc_id, text)."""
    grade = {}
    for i, g in labels:
        if i is not None and g is not None:
            grade[i] = max(g, grade.get(i, g))
    known = sorted((d, t) for d, t in rows if d in grade)
    model = toxicity.fit_severity([toxicity.feature_places(t) for _, t in known], np.array([grade[d] for d, _ in known]))
    weight = model.table()
    strength = np.array([weight[toxicity.feature_places(t)].sum(dtype=np.float64) for _, t in rows])
    rows = [r for r, s in zip(rows, model.severity(strength), strict=True) if s < model.limit]
    away = {d for d, _, c in by_simhash(rows) if d is not None and d != c}
    rows = [r for r in rows if r[0] not in away]
    held = {p[0] for p in by_sets(rows, items)}
    rows = [r for r in rows if r[0] is None or r[0] not in held]
    encode = tokens.Encoder(ranks, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for d, t in rows:
        spans = secrets.all_spans(t, encode)
        assert secrets.written([s for s in spans if s[2] != "random"]).split(",") == (base_of(t) or [""])
        out.append((d, library.encode_ordinary(secrets.masked(t or "", spans, "<secret>"))))
    return sorted(out, key=repr)


def test_pipeline_beside_plain_stages(spark, ranks, sf):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(*c).collect()]
    docs = read("documents", "doc_id", "text")
    want = plain(docs, read("labels", "doc_id", "toxic"), read("benchmark", "item_id", "text"), ranks)
    got = sorted(((r["doc_id"], list(r["ids"])) for r in corpus_pipeline.run(spark, sf).collect()), key=repr)
    assert got == want
    assert len(got) < len(docs)


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("severity", F.lit(1)).withColumn("of", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert (out.columns, [f.dataType for f in out.schema]) == (docs.columns, [f.dataType for f in docs.schema]), name
        assert 0 < out.count() <= docs.count()


def test_stages_with_ragged_rows(spark, sf, docs_of, ragged):
    """Rows without a number stay in every filtering stage, repeated rows stay or go together."""
    docs = docs_of(ragged, clashing=True)
    for name, stage in corpus_pipeline.STAGES:
        left = [r["doc_id"] for r in stage(spark, docs, sf).collect()]
        assert left.count(None) == 2, name
        assert left.count(5) in (0, 2)
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "byte_bpe"]


def test_stages_leave_columns_of_another_case_alone(spark, sf):
    """Each stage by itself; no table can be written with two names that differ in case only."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    wide = docs.select(*docs.columns, F.lit("x").alias("TEXT"), F.lit(7).alias("Doc_Id"))
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, wide, sf), stage(spark, docs, sf)
        last = name == "byte_bpe"
        assert got.columns == (want.columns if last else wide.columns)
        plain = got.toDF(*map(str, range(len(got.columns)))).collect()
        assert sorted((tuple(r)[: len(want.columns)] for r in plain), key=repr) == sorted((tuple(r) for r in want.collect()), key=repr)
