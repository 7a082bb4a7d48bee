"""Citations, evaluation and request metrics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from docketry.operators import citations, evaluation, search, usage
from docketry.operators.ingest import payload_rows
from docketry.plans.files import SQL_ELEMENTS, elements
from docketry.plans.registry import query, sql_distance, sql_words, table
from docketry.plans.search import SQL_DENSE, SQL_DOCS, benchmark_queries, hits_with_text, label_chunks, vector_queries
from docketry.session import cut_lineage, work_path
from docketry.sources.files import read_evaluation, write_truth

# ---------------------------------------------------------------- citations


def _element_hits(spark, sf):
    """Every element as a hit of the question that is its document, in element order."""
    meta = F.col("metadata")
    return elements(spark, sf).select(
        F.col("doc_id").alias("query_id"),
        "collection",
        F.col("pos").alias("rank"),
        F.coalesce(meta["table_metadata"]["table_content"], meta["image_metadata"]["caption"], meta["content"]).alias("text"),
        meta["source_metadata"]["source_id"].alias("source_id"),
        F.lit(False).alias("plain_source"),
        F.when(F.col("pos") % 2 == 0, F.col("pos") / 4).alias("score"),
        meta["content_metadata"].alias("content_metadata"),
    )


def _payloads(spark, sf):
    return payload_rows(elements(spark, sf)).dropDuplicates(["element_key"]).withColumn("put_at", F.lit(0).cast("long"))


SQL_CITED = SQL_ELEMENTS + """
, hits as (select doc_id as query_id, pos as rank, source_name as document_name, chunk_type as document_type,
  case when k in (1, 2, 3) then case when length(line) > 100 then 'picture of ' || line else '' end else line end as content,
  case when pos % 2 = 0 then pos / 4.0::double else 0.0 end as score, case when k in (1, 2, 3) then pos end as page_number, k from c),
cited as (select * from hits where content <> '')
"""


@query(SQL_CITED + "select query_id, rank::bigint as rank, document_name, document_type, content, score, coalesce(page_number, -1)::bigint as page_number from cited")
def citation_rows(spark, sf):
    return citations.cite(_element_hits(spark, sf), _payloads(spark, sf)).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "document_name", "document_type", "content", "score",
        F.coalesce("metadata.page_number", F.lit(-1)).cast("long").alias("page_number"),
    )


@query(SQL_CITED + "select query_id, count(*) as total_results from cited group by 1")
def citation_totals(spark, sf):
    return citations.citation_counts(citations.cite(_element_hits(spark, sf), _payloads(spark, sf)))


@query(SQL_CITED + "select query_id, rank::bigint as rank, content as picture from cited where k in (1, 2, 3)")
def visual_hits(spark, sf):
    return citations.visual_hits(_element_hits(spark, sf), _payloads(spark, sf)).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "picture"
    )


@query(SQL_CITED + """
select query_id, content as picture, rn as rank, 'context' as origin from (
  select *, row_number() over (partition by query_id order by rank) as rn from cited where k in (1, 2, 3)) where rn <= 3
union all select doc_id, 'pic-' || lang, 1, 'question' from documents
""")
def pictures_shown(spark, sf):
    """The question brings two pictures, of which one may be shown."""
    asked = table(spark, sf, "documents").select(
        F.col("doc_id").alias("query_id"), F.posexplode(F.array(F.concat(F.lit("pic-"), "lang"), F.col("source"))).alias("rank", "picture")
    )
    found = citations.visual_hits(_element_hits(spark, sf), _payloads(spark, sf))
    return citations.pictures_shown(asked, found, of_context=3).withColumn("rank", F.col("rank").cast("long"))


@query(f"""
with {SQL_DOCS}, {SQL_DENSE.format(k=3)}
select query_id, collection, rank, text as content, string_split(source, '/')[-1] as document_name, 'text' as document_type, round(-distance, 6) as score from dense
""")
def plain_source_citations(spark, sf):
    """Hits whose source is a bare path and whose metadata has no kind are texts."""
    nothing = "cast(null as struct<type:string,subtype:string,page_number:int,location:array<double>>)"
    hits = hits_with_text(spark, sf, 3).select(
        "query_id", "collection", "rank", "text", F.col("source").alias("source_id"), F.lit(True).alias("plain_source"),
        (-F.col("distance")).alias("score"), F.expr(nothing).alias("content_metadata"),
    )
    return citations.cite(hits, _payloads(spark, sf)).select(
        "query_id", "collection", F.col("rank").cast("long").alias("rank"), "content", "document_name", "document_type",
        F.round("score", 6).alias("score"),
    )


# ---------------------------------------------------------------- evaluation


def _hit_names(spark, sf, k=10):
    """Nearest embeddings named as pages: the label is the document, the id the page."""
    chunks = label_chunks(spark, sf)
    hits = search.vector_top_k(chunks, vector_queries(spark, sf), k, per_collection=False)
    return hits.join(chunks.select("chunk_id", "collection"), "chunk_id").select(
        F.col("query_id").alias("question_id"),
        "rank",
        evaluation.page_name(F.concat("collection", F.lit("_doc")), F.col("chunk_id")).alias("name"),
    )


def _truth(spark, sf):
    """True pages of an embedding: itself and the two before it; questions of the low labels have no pages."""
    emb = table(spark, sf, "embeddings")
    paged = F.col("label") >= 3
    offset = emb.select("vec_id", paged.alias("paged"), F.posexplode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("pos", "back"))
    labels = emb.select(F.col("vec_id").alias("page_id"), "label")
    return offset.withColumn("page_id", F.col("vec_id") - F.col("back")).join(labels, "page_id").select(
        F.col("vec_id").alias("question_id"),
        "pos",
        F.concat(F.lit("c"), F.col("label").cast("string"), F.lit("_doc")).alias("filename"),
        F.when(F.col("paged"), F.col("page_id").cast("string")).otherwise("").alias("page"),
    )


SQL_RECALL = f"""
with hits as (select * from (select q.vec_id as question_id, q.label >= 3 as paged, 'c' || c.label || '_doc' as filename, c.vec_id as page,
  row_number() over (partition by q.vec_id order by {sql_distance('q.embedding', 'c.embedding')}, c.vec_id) as rank
  from embeddings q, embeddings c) where rank <= 10),
truth as (select q.vec_id as question_id, 'c' || p.label || '_doc' as filename, p.vec_id as page, q.label >= 3 as paged
  from embeddings q join embeddings p on p.vec_id between q.vec_id - 2 and q.vec_id),
sizes as (select question_id, count(*) as n_truth from truth group by 1),
ks as (select unnest([1, 3, 5, 10]) as k, unnest([['page', 'document']]) as gs), kg as (select k, unnest(gs) as granularity from (select k, ['page', 'document'] as gs from ks)),
h as (select question_id, granularity, k, filename || case when granularity = 'page' and paged then '_' || page else '' end as key from hits, kg where rank <= k),
t as (select question_id, granularity, filename || case when granularity = 'page' and paged then '_' || page else '' end as key from truth, (select distinct granularity from kg)),
found as (select question_id, granularity, k, count(distinct key) as n from h join t using (question_id, granularity, key) group by 1, 2, 3),
recall as (select s.question_id, kg.granularity, kg.k, coalesce(n, 0)::double / n_truth as recall
  from sizes s cross join kg left join found f on f.question_id = s.question_id and f.granularity = kg.granularity and f.k = kg.k)
""".replace("unnest([['page', 'document']]) as gs), kg", "1 as one), kg")


@query(SQL_RECALL + "select question_id, granularity, k::int as k, round(recall, 9) as recall from recall")
def recall_by_question(spark, sf):
    return evaluation.recall_by_question(_truth(spark, sf), _hit_names(spark, sf)).withColumn("recall", F.round("recall", 9))


@query(SQL_RECALL + "select granularity, k::int as k, count(*) as n_questions, round(avg(recall), 6) as mean_recall from recall where k <= 5 group by 1, 2")
def mean_recall(spark, sf):
    recall = evaluation.recall_by_question(_truth(spark, sf), _hit_names(spark, sf))
    return evaluation.mean_recall(recall, top_k=5).withColumn("mean_recall", F.round("mean_recall", 6))


@query(r"""
select page_id, case when contains(b, '_') and not (b like '%.pdf' or b like '%.txt') then regexp_extract(b, '(?s)^(.*)_([^_]*)$', 1) else b end as filename,
  case when contains(b, '_') and not (b like '%.pdf' or b like '%.txt') then regexp_extract(b, '(?s)^(.*)_([^_]*)$', 2) else '' end as page
from (select page_id, case when starts_with(url, 'https') then url || '_' || page_id else url || '.pdf' end as b from pages)
""")
def page_names_split(spark, sf):
    name = F.when(F.col("url").startswith("https"), F.concat("url", F.lit("_"), F.col("page_id").cast("string"))).otherwise(
        F.concat("url", F.lit(".pdf"))
    )
    return table(spark, sf, "pages").select("page_id", evaluation.split_page_name(name).alias("s")).select("page_id", "s.*")


def _evaluation_file(spark, sf):
    """Benchmark items as evaluation lines: one evidence with a page, one without."""
    path = work_path(spark, "evaluation")
    body = """
      array(named_struct('doc_name', concat('report ', item_id), 'evidence_page_num', item_id, 'evidence_text_full_page', text),
            named_struct('doc_name', concat('annex_', item_id, '.pdf'), 'evidence_page_num', cast(null as bigint), 'evidence_text_full_page', cast(null as string)))
    """
    table(spark, sf, "benchmark").select(
        F.col("item_id").cast("string").alias("bench_id"),
        F.col("text").alias("question"),
        F.lower("text").alias("answer"),
        F.expr(body).alias("evidence"),
    ).write.json(path)
    return path


@query("""
select item_id::varchar as question_id, text as question, lower(text) as reference, 2::bigint as n_evidence from benchmark
""")
def evaluation_lines(spark, sf):
    rows = read_evaluation(spark, _evaluation_file(spark, sf), "bench_id")
    return rows.select("question_id", "question", "reference", F.size("evidence").cast("long").alias("n_evidence"))


TRUTH = """
select item_id::varchar as question_id, 'report ' || item_id || '.html' as filename, item_id::varchar as page from benchmark
union all select item_id::varchar, 'annex_' || item_id || '.pdf', '' from benchmark
"""


@query(TRUTH)
def truth_pages(spark, sf):
    truth = evaluation.ground_truth(read_evaluation(spark, _evaluation_file(spark, sf), "bench_id"), file_ext=".html")
    return truth.select("question_id", "filename", "page")


@query(TRUTH)
def truth_written(spark, sf):
    path = work_path(spark, "truth")
    write_truth(evaluation.ground_truth(read_evaluation(spark, _evaluation_file(spark, sf), "bench_id"), file_ext=".html"), path)
    written = spark.read.schema("original_id string, contexts array<struct<filename:string,page:string>>").json(path)
    return written.select(F.col("original_id").alias("question_id"), F.explode("contexts").alias("c")).select(
        "question_id", "c.filename", "c.page"
    )


@query()
def alike_pages(spark, sf):
    """Evidence without a page: messages are looked for among the messages of their conversation."""
    conv = table(spark, sf, "conversations")
    pages = conv.select(F.col("conv_id").alias("doc_name"), F.col("turn").cast("int").alias("page_no"), F.col("text").alias("page_text"))
    evidence = conv.where("role = 'user'").select(
        F.col("conv_id").alias("question_id"), F.col("turn").alias("pos"), F.col("conv_id").alias("doc_name"),
        F.lower("text").alias("evidence_text"),
    )
    return evaluation.best_pages(evidence, pages)


SQL_EVALUATION = f"""
with {SQL_DOCS}, {SQL_DENSE.format(k=2)}, first as (select * from asked),
e as (select query_id as question_id, f.text as question, lower(f.text) as reference,
  (select string_agg(d.text, '|' order by rank) from dense d where d.query_id = f.query_id and d.collection = 'en') as contexts,
  f.text[-20:] as response from first f)
"""


def _evaluation_set(spark, sf):
    # both are read in several places of the set
    hits = cut_lineage(hits_with_text(spark, sf, 2).select("query_id", "collection", "rank", "text"))
    asked = cut_lineage(table(spark, sf, "benchmark").join(table(spark, sf, "embeddings"), F.col("item_id") == F.col("vec_id"), "left_semi").select(F.col("item_id").alias("query_id"), "text"))
    questions = asked.select(F.col("query_id").alias("question_id"), F.col("text").alias("question"))
    questions = questions.withColumn("reference", F.lower("question"))
    contexts = hits.where("collection = 'en'").select(F.col("query_id").alias("question_id"), "rank", "text")
    responses = questions.select("question_id", F.expr("right(question, 20)").alias("response"))
    return evaluation.evaluation_set(questions, contexts, responses)


@query(SQL_EVALUATION + "select question_id, question, reference, coalesce(contexts, '') as contexts, response from e")
def evaluation_rows(spark, sf):
    return _evaluation_set(spark, sf).withColumn("contexts", F.array_join("contexts", "|"))


@query(SQL_EVALUATION + """
select round(avg(length(question) / 1000.0::double), 6) as accuracy, 0.5::double as relevance, count(*) as n_rows from e
""")
def judged_answers(spark, sf):
    """Stand-in judges: the length of the question, and always one half."""
    judges = {
        "accuracy": lambda q, c, a, r: q.str.len() / 1000,
        "relevance": lambda q, c, a, r: pd.Series([0.5] * len(q)),
    }
    means = evaluation.judged_means(evaluation.judged(_evaluation_set(spark, sf), judges), ["accuracy", "relevance"])
    return means.withColumn("accuracy", F.round("accuracy", 6))


# ---------------------------------------------------------------- request metrics


def requests(spark, sf):
    """Events as requests: the type is the endpoint, the value a duration, the property a token count."""
    return table(spark, sf, "events").select(
        F.when(F.col("event_type") == "view", "GET").otherwise("POST").alias("method"),
        F.concat(F.lit("/"), "event_type").alias("endpoint"),
        F.get_json_object("props", "$.k").cast("long").alias("input_tokens"),
        F.length("event_type").cast("long").alias("output_tokens"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("rag_ttft_ms"),
        (F.col("value") * 10).alias("llm_ttft_ms"),
        F.lit(None).cast("double").alias("context_reranker_time_ms"),
        (F.col("value") / 2).alias("retrieval_time_ms"),
        (F.col("value") * 100).alias("llm_generation_time_ms"),
    )


SQL_LATENCY = """
with l as (select unnest(['rag_ttft_ms', 'llm_ttft_ms', 'retrieval_time_ms', 'llm_generation_time_ms']) as metric,
  unnest([case when event_type <> 'error' then value end, value * 10, value / 2, value * 100]) as ms from events)
"""


def sql_bucket(value: str) -> str:
    return f"(select min(b) from (select unnest({list(usage.BUCKETS)})::double as b) where b >= {value})"


@query("select case event_type when 'view' then 'GET' else 'POST' end as method, '/' || event_type as endpoint, count(*) as n_requests from events group by 1, 2")
def request_counts(spark, sf):
    return usage.request_counts(requests(spark, sf))


SQL_TOKENS = "t as (select json_extract(props, '$.k')::bigint as i, length(event_type) as o from events)"


@query(f"with {SQL_TOKENS} select sum(i)::bigint as input_tokens, sum(o)::bigint as output_tokens, sum(i + o)::bigint as total_tokens from t")
def token_totals(spark, sf):
    return usage.token_totals(requests(spark, sf))


@query(f"with {SQL_TOKENS} select {sql_bucket('i + o')} as le, count(*) as n from t group by 1")
def token_histogram(spark, sf):
    return usage.token_histogram(requests(spark, sf))


@query(f"select round(avg(len({sql_words('text')})), 6) as avg_words_per_chunk from documents")
def words_per_chunk(spark, sf):
    return usage.words_per_chunk(table(spark, sf, "documents")).withColumn(
        "avg_words_per_chunk", F.round("avg_words_per_chunk", 6)
    )


@query(SQL_LATENCY + f"select metric, {sql_bucket('ms')} as le, count(*) as n, round(sum(ms), 4) as total_ms from l where ms is not null group by 1, 2")
def latency_histogram(spark, sf):
    return usage.latency_histogram(requests(spark, sf)).withColumn("total_ms", F.round("total_ms", 4))


@query(SQL_LATENCY + """
select metric, count(*) as n, quantile_disc(ms, 0.5) as p50, quantile_disc(ms, 0.95) as p95, quantile_disc(ms, 0.99) as p99
from l where ms is not null group by 1
""")
def latency_percentiles(spark, sf):
    return usage.latency_percentiles(requests(spark, sf), accuracy=100_000)
