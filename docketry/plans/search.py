"""Vector, keyword and hybrid search over whole tables of queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from docketry.functions.scores import sigmoid
from docketry.functions.text import score_reply
from docketry.operators import keyword, rerank, search
from docketry.operators.metadata import Field
from docketry.operators.postings import posting_top_k, write_postings
from docketry.plans.registry import SQL, query, sql_distance, sql_tokens, sql_words, table, texts
from docketry.session import work_path

CHUNK_FIELDS = [Field("label", "integer"), Field("lang", "string"), Field("n_chars", "integer")]


def label_chunks(spark, sf):
    """Embeddings as chunks, the label as collection."""
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("collection"),
        F.col("vec_id").alias("chunk_id"),
        F.col("embedding").alias("vector"),
    )


def vector_queries(spark, sf):
    """Every embedding asks once."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def document_vectors(spark, sf):
    """All documents with text and metadata; the embeddings are dealt out to them in turn."""
    docs, vectors = texts(spark, sf), table(spark, sf, "embeddings")
    own = F.col("vec_id") == F.col("doc_id") % F.lit(vectors.count())
    return docs.join(vectors, own).select(
        F.col("lang").alias("collection"),
        F.col("doc_id").alias("chunk_id"),
        "text",
        F.concat(F.lit("/data/"), "source", F.lit(".txt")).alias("source"),
        F.col("embedding").alias("vector"),
        F.struct("label", "lang", "n_chars").alias("content_metadata"),
    )


def document_texts(spark, sf):
    """What is shown of a hit, by chunk_id; the embeddings are not needed again."""
    return texts(spark, sf).select(
        F.col("doc_id").alias("chunk_id"), "text", F.concat(F.lit("/data/"), "source", F.lit(".txt")).alias("source")
    )


def benchmark_queries(spark, sf):
    """Benchmark texts as questions, with the embedding of the same number."""
    bench = table(spark, sf, "benchmark")
    return bench.join(table(spark, sf, "embeddings"), F.col("item_id") == F.col("vec_id")).select(
        F.col("item_id").alias("query_id"), "text", F.col("embedding").alias("vector")
    )


SQL_DOCS = """
chunks as (select lang as collection, doc_id as chunk_id, text, '/data/' || source || '.txt' as source, embedding as vector, label, n_chars
  from documents join embeddings on vec_id = doc_id % (select count(*) from embeddings)),
asked as (select item_id as query_id, text, embedding as vector from benchmark join embeddings on item_id = vec_id)
"""
SQL_DENSE = f"""
dense as (select * from (select query_id, collection, chunk_id, c.text, source, {sql_distance('q.vector', 'c.vector')} as distance,
  q.text as query_text,
  row_number() over (partition by query_id, collection order by {sql_distance('q.vector', 'c.vector')}, chunk_id) as rank
  from asked q, chunks c) where rank <= {{k}})
"""


def sql_label_top(k: int, keep: str = "") -> str:
    return f"""
select * from (select q.vec_id as query_id, 'c' || c.label as collection, c.vec_id as chunk_id,
  {sql_distance('q.embedding', 'c.embedding')} as distance,
  row_number() over (partition by q.vec_id, c.label order by {sql_distance('q.embedding', 'c.embedding')}, c.vec_id) as rank
  from embeddings q, embeddings c {keep}) where rank <= {k}
"""


def _long_rank(df, name="rank"):
    return df.withColumn(name, F.col(name).cast("long"))


def _rounded(df, name="distance"):
    return df.withColumn(name, F.round(name, 6))


@query(f"select query_id, collection, chunk_id, round(distance, 6) as distance, rank from ({sql_label_top(3)})")
def vector_top_k(spark, sf):
    return _long_rank(_rounded(search.vector_top_k(label_chunks(spark, sf), vector_queries(spark, sf), 3)))


@query(f"""
select * from (select q.vec_id as query_id, c.vec_id as chunk_id, round({sql_distance('q.embedding', 'c.embedding')}, 6) as distance,
  row_number() over (partition by q.vec_id order by {sql_distance('q.embedding', 'c.embedding')}, c.vec_id) as rank
  from embeddings q, embeddings c) where rank <= 10
""")
def vector_top_k_overall(spark, sf):
    hits = search.vector_top_k(label_chunks(spark, sf), vector_queries(spark, sf), 10, per_collection=False)
    return _long_rank(_rounded(hits))


SPEC = {
    "and": [
        {"op": "in", "field": "lang", "value": ["EN", "de", "fr"]},
        {"op": "between", "field": "n_chars", "value": [500, 9000]},
        {"not": {"op": "==", "field": "label", "value": 3}},
    ]
}
SQL_FILTERED = f"""
with {SQL_DOCS.replace("from embeddings)),", "from embeddings) where lang in ('en', 'de', 'fr') and n_chars between 500 and 9000 and label <> 3),")},
{SQL_DENSE.format(k=10)}
"""


def _filtered(spark, sf):
    return search.filtered_top_k(document_vectors(spark, sf), benchmark_queries(spark, sf), SPEC, CHUNK_FIELDS, 10)


@query(SQL_FILTERED + "select query_id, collection, chunk_id, round(distance, 6) as distance, rank from dense")
def filtered_top_k(spark, sf):
    return _long_rank(_rounded(_filtered(spark, sf)))


@query(SQL_FILTERED + """
select query_id, collection, chunk_id, rank, round(1 / (1 + exp(-0.1 * (10 - distance * 10))), 6) as score, source as document_name
from (select * replace (string_split(source, '/')[-1] as source) from dense)
where 1 / (1 + exp(-0.1 * (10 - distance * 10))) >= 0.4
""")
def filtered_search(spark, sf):
    """The whole path: filter, search, score on 0..1, confidence cut, name the document."""
    hits = _filtered(spark, sf).withColumn("score", 10 - F.col("distance") * 10)
    kept = rerank.cut_by_confidence(rerank.normalise_scores(hits), 0.4)
    names = document_texts(spark, sf).select("chunk_id", F.element_at(F.split("source", "/"), -1).alias("document_name"))
    return kept.join(names, "chunk_id").select(
        "query_id", "collection", "chunk_id", F.col("rank").cast("long").alias("rank"),
        F.round("score", 6).alias("score"), "document_name",
    )


ORDER = ["c7", "c2", "c5"]


@query(f"""
select query_id, collection, chunk_id, row_number() over (partition by query_id order by list_position(['c7', 'c2', 'c5'], collection), rank) as position
from ({sql_label_top(4)}) where collection in ('c7', 'c2', 'c5')
""")
def several_collections(spark, sf):
    names = search.check_search("dense", ORDER, rerank=True)
    chunks = label_chunks(spark, sf).where(F.col("collection").isin(names))
    hits = search.vector_top_k(chunks, vector_queries(spark, sf), 4)
    return search.in_collection_order(hits, names).select(
        "query_id", "collection", "chunk_id", F.col("position").cast("long").alias("position")
    )


def sql_keyword(queries: str, chunks: str, k: int) -> str:
    return f"""
kd as (select collection, chunk_id, {sql_tokens('text')} as tk from {chunks}),
kstat as (select collection, count(*) as n, avg(len(tk)) as al from kd group by 1),
ktf as (select collection, chunk_id, dl, term, count(*) as tf from (select collection, chunk_id, len(tk) as dl, unnest(tk) as term from kd) group by all),
kdf as (select collection, term, count(*) as df from ktf group by all),
kq as (select query_id, term, count(*) as uses from (select query_id, unnest({sql_tokens('text')}) as term from {queries}) group by all),
kscore as (select query_id, collection, chunk_id,
  round(sum(uses * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / al))), 6) as score
  from kq join ktf using (term) join kdf using (collection, term) join kstat using (collection) group by all),
keyword as (select * from (select *, row_number() over (partition by query_id, collection order by score desc, chunk_id) as rank from kscore) where rank <= {k})
"""


@query(f"""
with d as (select lang as collection, doc_id as chunk_id, text from documents), q as (select item_id as query_id, text from benchmark),
{sql_keyword('q', 'd', 10)} select query_id, collection, chunk_id, score, rank from keyword
""")
def keyword_top_k(spark, sf):
    docs = texts(spark, sf).select(F.col("lang").alias("collection"), F.col("doc_id").alias("chunk_id"), "text")
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return _long_rank(keyword.keyword_top_k(docs, asked, 10))


@query(SQL["keyword_top_k"])
def keyword_top_k_postings(spark, sf):
    """The same from an index of postings in blocks, written first and read by the words asked for."""
    docs = texts(spark, sf).select(F.col("lang").alias("collection"), F.col("doc_id").alias("chunk_id"), "text")
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    index = write_postings(docs, work_path(spark, "postings"))
    return _long_rank(posting_top_k(index, asked, 10))


def hybrid_hits(spark, sf, k: int = 10):
    chunks, asked = document_vectors(spark, sf), benchmark_queries(spark, sf)
    dense = search.vector_top_k(chunks, asked, 2 * k)
    sparse = keyword.keyword_top_k(chunks, asked, 2 * k)
    return keyword.fuse_ranks(dense, sparse, k)


SQL_HYBRID = f"""
with {SQL_DOCS}, {SQL_DENSE.format(k=20)}, {sql_keyword('asked', 'chunks', 20)},
fused as (select query_id, collection, chunk_id, d.rank as dense_rank, s.rank as sparse_rank,
  round(coalesce(1.0::double / (60 + d.rank), 0) + coalesce(1.0::double / (60 + s.rank), 0), 9) as score
  from dense d full join keyword s using (query_id, collection, chunk_id)),
hybrid as (select * from (select *, row_number() over (partition by query_id, collection order by score desc, chunk_id) as rank from fused) where rank <= 10)
"""


@query(SQL_HYBRID + "select query_id, collection, chunk_id, coalesce(dense_rank, 0) as dense_rank, coalesce(sparse_rank, 0) as sparse_rank, score, rank from hybrid")
def hybrid_top_k(spark, sf):
    search.check_search("hybrid", ["documents"], rerank=False)
    hits = hybrid_hits(spark, sf).withColumn("score", F.round("score", 9))
    for name in ("rank", "dense_rank", "sparse_rank"):
        hits = _long_rank(hits, name).fillna(0, [name])
    return hits


@query()
def cell_top_k(spark, sf):
    """Approximate search: clustered chunks on disk, each query looks into its nearest cells."""
    chunks = label_chunks(spark, sf)
    cells = search.train_cells(chunks, cells=16)
    path = work_path(spark, "cells")
    search.write_cells(chunks, cells, path)
    hits = search.cell_top_k(spark.read.parquet(path), vector_queries(spark, sf), cells, 3, probes=6)
    return _long_rank(_rounded(hits))


@query(f"""
select query_id, collection, chunk_id, round(distance, 6) as distance, rank from ({sql_label_top(3)})
""")
def cell_top_k_all_probed(spark, sf):
    """With every cell probed the approximate search is the exact one."""
    chunks = label_chunks(spark, sf)
    cells = search.train_cells(chunks, cells=8)
    hits = search.cell_top_k(cells.assign(chunks), vector_queries(spark, sf), cells, 3, probes=8)
    return _long_rank(_rounded(hits))


# ---------------------------------------------------------------- after the search


def hits_with_text(spark, sf, k: int = 10):
    chunks, asked = document_vectors(spark, sf), benchmark_queries(spark, sf)
    hits = search.vector_top_k(chunks, asked, k)
    return (
        hits.join(document_texts(spark, sf), "chunk_id")
        .join(asked.select("query_id", F.col("text").alias("query_text")), "query_id")
        .withColumn("place", F.struct("rank", "collection"))
    )


SQL_OVERLAP = f"""
round(len(list_intersect(list_distinct({sql_tokens('query_text')}), {sql_tokens('text')}))::double
  / len(list_distinct({sql_tokens('query_text')})), 9)
"""
SQL_SCORED = f"""
with {SQL_DOCS}, {SQL_DENSE.format(k=10)}, scored as (select *, {SQL_OVERLAP} as score from dense)
"""


@query(SQL_SCORED + """
select * from (select query_id, chunk_id, score,
  row_number() over (partition by query_id order by score desc, rank, collection) as new_rank from scored) where new_rank <= 5
""")
def reranked_hits(spark, sf):
    best = rerank.rerank(hits_with_text(spark, sf), 5, order="place")
    return best.select("query_id", "chunk_id", F.round("score", 9).alias("score"), F.col("new_rank").cast("long").alias("new_rank"))


@query(SQL_SCORED + """
select * from (select query_id, chunk_id, length(text)::bigint as score,
  row_number() over (partition by query_id order by length(text) desc, rank, collection) as new_rank from scored) where new_rank <= 4
""")
def reranked_by_function(spark, sf):
    """A user's scorer, here the length of the text; a top_n of 0 means 4."""
    def by_length(queries: pd.Series, texts: pd.Series) -> pd.Series:
        return texts.str.len().astype("float64")

    best = rerank.rerank(hits_with_text(spark, sf), 0, scorer=by_length, order="place")
    return best.select("query_id", "chunk_id", F.col("score").cast("long").alias("score"), F.col("new_rank").cast("long").alias("new_rank"))


@query("""
select event_id, case when event_type <> 'error' then round(1 / (1 + exp(-0.1 * value)), 9) end as score from events
""")
def normalised_scores(spark, sf):
    score = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf, "events").select("event_id", F.round(sigmoid(score), 9).alias("score"))


def _event_hits(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("query_id"),
        F.col("event_id").alias("rank"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("score"),
    )


@query("""
select * from (select user_id as query_id, event_id as rank, row_number() over (partition by user_id
  order by coalesce(case when event_type <> 'error' then value end, 0) desc, event_id) as new_rank from events) where new_rank <= 3
""")
def best_three(spark, sf):
    return rerank.keep_best(_event_hits(spark, sf)).select("query_id", "rank", F.col("new_rank").cast("long").alias("new_rank"))


@query("select event_id as rank from events where coalesce(case when event_type <> 'error' then value end, 0) >= 20.5")
def confident_hits(spark, sf):
    return rerank.cut_by_confidence(_event_hits(spark, sf), 20.5).select("rank")


@query("select event_id from events where coalesce(try_cast(case event_type when 'view' then 'n/a' else value::varchar end as double), 0) >= 10")
def confident_text_scores(spark, sf):
    """Scores kept as text: one that is no number counts as 0."""
    score = F.when(F.col("event_type") == "view", "n/a").otherwise(F.col("value").cast("string"))
    hits = table(spark, sf, "events").select("event_id", score.alias("score"))
    return rerank.cut_by_confidence(hits, 10.0).select("event_id")


SQL_MERGED = f"""
with {SQL_DOCS}, {SQL_DENSE.format(k=10)},
lists as (select query_id, query_text, text, chunk_id, case collection when 'en' then 0 when 'de' then 1 when 'es' then 2 else 3 end as list_no, rank from dense),
firsts as (select * from (select *, row_number() over (partition by query_id, text order by list_no, rank) as rn from lists) where rn = 1),
scored as (select *, {SQL_OVERLAP} as s from firsts)
select query_id, list_no, rank, round(1 / (1 + exp(-0.1 * s)), 6) as score, new_rank from (
  select *, row_number() over (partition by query_id order by s desc, list_no, rank) as new_rank from scored) where new_rank <= 20
"""


@query(SQL_MERGED)
def merged_contexts(spark, sf):
    """Lists of several collections as one, copies of a text counted once."""
    number = F.when(F.col("collection") == "en", 0).when(F.col("collection") == "de", 1).when(F.col("collection") == "es", 2).otherwise(3)
    hits = hits_with_text(spark, sf).select("query_id", "query_text", "text", number.alias("list_no"), "rank")
    return rerank.merge_contexts(hits).select(
        "query_id", "list_no", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"),
        F.col("new_rank").cast("long").alias("new_rank"),
    )


def keyword_search(spark, sf, k: int = 10, with_text: bool = True):
    """Search function for the loops: keyword hits over all documents as one collection.

    The index is written once, so a round does not split and count the documents again.
    """
    docs = texts(spark, sf).select(F.lit("documents").alias("collection"), F.col("doc_id").alias("chunk_id"), "text")
    index = keyword.write_index(docs, work_path(spark, "keywords"))

    def run(queries):
        hits = keyword.keyword_top_k(index, queries, k).select("query_id", "chunk_id", "rank")
        if not with_text:
            return hits
        return hits.join(docs.select("chunk_id", "text"), "chunk_id").select("query_id", "chunk_id", "text", "rank")

    return run


@query(f"""
with d as (select 'documents' as collection, doc_id as chunk_id, text from documents),
q as (select conv_id * 1000 + turn as query_id, text, conv_id from conversations where role = 'user'),
parent as (select conv_id, arg_min(text, turn) as query_text from conversations where role = 'user' group by 1),
{sql_keyword('q', 'd', 10)},
f as (select k.query_id, k.chunk_id, k.rank, d.text, p.query_text from keyword k join d using (chunk_id) join q using (query_id) join parent p using (conv_id)),
s as (select *, {SQL_OVERLAP} as score from f)
select query_id, chunk_id, score, rank from (
  select query_id, chunk_id, score, row_number() over (partition by query_id order by score desc, rank) as rank from s) where rank <= 3
""")
def subquery_hits(spark, sf):
    """Each user message is searched by itself and ranked against the first of its conversation."""
    users = table(spark, sf, "conversations").where("role = 'user'")
    parents = users.groupBy("conv_id").agg(F.min_by("text", "turn").alias("parent_text"))
    subs = users.join(parents, "conv_id").select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text", "parent_text")
    shown = table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    hits = rerank.retrieve_for(subs, keyword_search(spark, sf, with_text=False), 3, texts=shown)
    return hits.select("query_id", "chunk_id", F.round("score", 9).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(r"""
select conv_id, turn, case when contains(text || ' (' || turn || ')', '2') then 2 when contains(text || ' (' || turn || ')', '1') then 1 else 0 end as grade
from conversations
""")
def graded_replies(spark, sf):
    reply = F.concat("text", F.lit(" ("), F.col("turn").cast("string"), F.lit(")"))
    return table(spark, sf, "conversations").select("conv_id", "turn", score_reply(reply).alias("grade"))


@query(f"""
with {SQL_DOCS}, {SQL_DENSE.format(k=2)}
select query_id, string_agg('File: ' || regexp_replace(string_split(source, '/')[-1], '\\.[^.]*$', '') || chr(10) || 'Content: ' || text,
  chr(10) order by rank, collection) as context from dense group by 1
""")
def context_of_query(spark, sf):
    hits = hits_with_text(spark, sf, 2)
    shown = hits.withColumn("shown", rerank.context_text(F.col("source"), F.col("text")))
    return rerank.contexts_by_query(shown, "shown", order="place")


# ---------------------------------------------------------------- loops with stand-in models


def _questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def sql_distinct_words(text: str) -> str:
    return f"list_distinct({sql_words(text)})"


@query(f"""
with d as (select 'documents' as collection, doc_id as chunk_id, text from documents),
v1 as (select item_id, 1 as round, text from benchmark),
v2 as (select item_id, 2 as round, case when contains(text, ' ') then substr(text, strpos(text, ' ') + 1) else '' end as text from v1),
v3 as (select item_id, 3 as round, case when contains(text, ' ') then substr(text, strpos(text, ' ') + 1) else '' end as text from v2),
q as (select item_id * 10 + round as query_id, * from (select * from v1 union all select * from v2 union all select * from v3)),
{sql_keyword('q', 'd', 3)},
seen as (select query_id, list_distinct(flatten(list({sql_distinct_words('text')}))) as words from keyword join d using (chunk_id) group by 1),
shared as (select item_id, round, text, len(list_intersect({sql_distinct_words('text')}, coalesce(words, []))) as n from q left join seen using (query_id)),
graded as (select *, case when n > 12 then 2 when n > 9 then 1 else 0 end as grade from shared)
select item_id as query_id, text, grade, grade > 0 as accepted, round from graded g
where (grade > 0 or round = 3) and not exists (select 1 from graded e where e.item_id = g.item_id and e.round < g.round and e.grade > 0)
""")
def relevance_rounds(spark, sf):
    """The stand-in judge wants three words of the query in the contexts; the rewriter drops the first word."""
    def judge(queries, contexts):
        shared = [len(set(q.split()) & set(c.split())) for q, c in zip(queries, contexts, strict=True)]
        return pd.Series(["2" if n > 12 else "1" if n > 9 else "0" for n in shared])

    out = rerank.relevance_loop(
        _questions(spark, sf), keyword_search(spark, sf, 3), judge, lambda q: q.str.partition(" ")[2]
    )
    return out["queries"]


@query(f"""
with a as (select r.conv_id * 1000 + r.turn as query_id, u.text as context, r.text as answer from conversations r
  join conversations u on u.conv_id = r.conv_id and u.turn + 1 = r.turn where r.role = 'assistant' and u.role = 'user'),
s as (select *, len(list_intersect({sql_distinct_words('context')}, {sql_distinct_words('answer')})) > 8 as first_good,
  length(context) < 100 as outside, len({sql_distinct_words('context')}) > 8 as next_good from a)
select query_id, case when first_good or outside then answer else context end as answer,
  first_good or (not outside and next_good) as grounded, case when first_good or outside then 1 when next_good then 2 else 3 end as round from s
""")
def groundedness_rounds(spark, sf):
    """Assistant messages as answers, the user message before them as context."""
    conv = table(spark, sf, "conversations")
    users = conv.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("context"))
    answers = conv.where("role = 'assistant'").join(users, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("context").alias("query"), "context", F.col("text").alias("answer")
    )

    def judge(contexts, replies):
        shared = [len(set(c.split()) & set(a.split())) for c, a in zip(contexts, replies, strict=True)]
        return pd.Series(["1" if n > 8 else "0" for n in shared])

    def again(queries, contexts):
        return pd.Series([rerank.OUT_OF_CONTEXT if len(q) < 100 else q for q in queries])

    return rerank.groundedness_loop(answers, judge, again)


def _decomposed(spark, sf):
    def split(texts):
        """The first sentence and the rest, or the text alone if it is one sentence."""
        flat = texts.str.replace(r"\s+", " ", regex=True).str.partition(". ")
        return pd.Series([f"1. {a}\n2. {c}" if c else f"1. {a}" for a, c in zip(flat[0], flat[2], strict=True)])

    def further(texts, past, contexts):
        return pd.Series(["" if len(p) > 1500 else f'"{t}"' for t, p in zip(texts, past, strict=True)])

    return rerank.decompose(
        _questions(spark, sf), keyword_search(spark, sf, 5), split, lambda q, past: q,
        lambda q, context: context.str.len().map("{} characters".format), further, top_n=3,
    )


SQL_DECOMPOSED = rf"""
with d as (select 'documents' as collection, doc_id as chunk_id, text from documents),
flat as (select item_id, text as query_text, regexp_replace(text, '\s+', ' ', 'g') as t from benchmark),
cut as (select item_id, query_text, trim(substr(t, 1, strpos(t, '. ') - 1)) as head, trim(substr(t, strpos(t, '. ') + 2)) as rest from flat where contains(t, '. ')),
two as (select * from cut where rest <> ''),
steps as (select item_id, text as query_text, 0 as step, text from benchmark
  union all select item_id, query_text, 1, head from two union all select item_id, query_text, 2, rest from two
  union all select item_id, query_text, 3, translate(query_text, chr(39) || chr(34), '') from two),
q as (select item_id * 10 + step as query_id, * from steps),
{sql_keyword('q', 'd', 5)},
f as (select k.query_id, k.rank, k.chunk_id, d.text, q.query_text, q.item_id, q.step from keyword k join d using (chunk_id) join q using (query_id)),
best as (select * from (select *, row_number() over (partition by query_id order by s desc, rank) as rn from (select *, {SQL_OVERLAP} as s from f)) where rn <= 3),
size as (select query_id, sum(length(text)) + count(*) - 1 as n from best group by 1),
told as (select item_id, step, text, coalesce(n, 0)::bigint || ' characters' as answer from q left join size using (query_id) where step > 0),
past as (select *, sum(length('Question: ' || text || chr(10) || 'Answer: ' || answer) + 3) over (partition by item_id order by step) - 3 as length_so_far from told),
third as (select p.* from past p join past before on p.item_id = before.item_id and p.step = 3 and before.step = 2 where before.length_so_far <= 1500 and p.text <> '')
"""


@query(SQL_DECOMPOSED + """
select item_id as query_id, step, text as question, text as rewritten, answer from (
  select item_id, step, text, answer from told where step < 3 union all select item_id, step, text, answer from third
  union all select item_id, 4, text, answer from third where length_so_far <= 1500)
""")
def decomposed_history(spark, sf):
    return _decomposed(spark, sf)["history"]


@query(SQL_DECOMPOSED + f""",
lists as (select item_id, step, rn, chunk_id, text, query_text from best where step < 3 or item_id in (select item_id from third)),
firsts as (select * from (select *, row_number() over (partition by item_id, text order by step, rn) as copy from lists) where copy = 1 or item_id not in (select item_id from two)),
scored as (select *, {SQL_OVERLAP} as score from firsts),
merged as (select *, row_number() over (partition by item_id order by score desc, step, rn) as new_rank from scored)
select item_id as query_id, chunk_id, round(1 / (1 + exp(-0.1 * score)), 6) as score, new_rank from merged where new_rank <= 20
""")
def decomposed_contexts(spark, sf):
    return _decomposed(spark, sf)["contexts"].select(
        "query_id", "chunk_id", F.round("score", 6).alias("score"), F.col("new_rank").cast("long").alias("new_rank")
    )
