"""Collections and their documents: `lang` is the collection, `source` the file."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.operators import collections as ops
from docketry.operators.metadata import REGISTRY_TYPE, schema_errors
from docketry.plans.registry import query, table
from docketry.sources.files import write_chunks, write_elements
from docketry.session import work_path

FIELDS_TYPE = (
    "array<struct<name:string,type:string,required:boolean,array_type:string,max_length:int,description:string>>"
)


def document_chunks(spark, sf):
    """Each document as one chunk."""
    name = F.concat(F.lit("/data/"), "source", F.lit(".txt"))
    return table(spark, sf, "documents").select(
        F.col("lang").alias("collection"),
        F.col("doc_id").alias("chunk_id"),
        "text",
        F.struct(name.alias("source_id"), name.alias("source_name")).alias("source"),
        F.struct("n_chars").alias("content_metadata"),
    )


def _collections(spark, sf):
    """Languages of the documents and of the pages, and the hidden registry."""
    pages = table(spark, sf, "pages").select(F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("collection"))
    docs = table(spark, sf, "documents").select(F.col("lang").alias("collection"))
    hidden = docs.select(F.concat(F.lit(".index_"), "collection").alias("collection"))
    return docs.union(pages).union(hidden).distinct().withColumn("dimension", F.lit(64))


def _schemas(spark, sf):
    """One field per source seen in a language."""
    return (
        table(spark, sf, "documents")
        .groupBy(F.col("lang").alias("collection"))
        .agg(F.sort_array(F.collect_set("source")).alias("names"))
        .select(
            "collection",
            F.expr(
                "transform(names, n -> named_struct('name', n, 'type', 'integer', 'required', false, 'array_type', "
                "cast(null as string), 'max_length', cast(null as int), 'description', cast(null as string)))"
            ).alias("fields"),
        )
    )


LANGS = """
select distinct lang as collection from documents
union select regexp_extract(html, 'lang="([a-z]+)"', 1) from pages
"""


@query(f"""
select collection, coalesce(n, 0) as n_chunks, coalesce(f, 0) as n_fields from ({LANGS})
left join (select lang as collection, count(*) as n, count(distinct source) as f from documents group by 1) using (collection)
""")
def collection_listing(spark, sf):
    listed = ops.list_collections(_collections(spark, sf), _schemas(spark, sf), document_chunks(spark, sf))
    return listed.select("collection", "n_chunks", F.size("fields").cast("long").alias("n_fields"))


@query("select row_number() over (order by source) - 1 as pos, source as name, 'integer' as type from (select distinct source from documents where lang = 'de')")
def collection_schema(spark, sf):
    return ops.schema_of(_schemas(spark, sf), "de").select(F.col("pos").cast("long").alias("pos"), "name", "type")


def _wanted(spark, sf):
    """A collection per customer, named by segment and nation, with faults that follow the data."""
    field = F.struct(
        F.when(F.col("c_acctbal") < 0, " ").otherwise(F.lower("c_mktsegment")).alias("name"),
        F.when(F.col("c_acctbal") > 9000, "decimal").otherwise("string").alias("type"),
        F.lit(False).alias("required"),
        F.lit(None).cast("string").alias("array_type"),
        F.when(F.col("c_nationkey") == 0, 0).cast("int").alias("max_length"),
        F.lit(None).cast("string").alias("description"),
    )
    twice = F.when(F.col("c_nationkey") == 1, F.array(field, field)).otherwise(F.array(field))
    return table(spark, sf, "customer").select(
        F.lower("c_name").alias("collection"), F.lit(64).alias("dimension"), twice.cast(FIELDS_TYPE).alias("fields")
    )


FAULTS = """
with f as (select lower(c_name) as collection, case when c_acctbal < 0 then '' else lower(c_mktsegment) end as field,
  c_acctbal, c_nationkey, unnest(range(case when c_nationkey = 1 then 2 else 1 end)) as copy from customer),
faults as (
  select collection, field, 'name is blank' as error from f where c_acctbal < 0
  union all select collection, field, 'type is not known' from f where c_acctbal > 9000
  union all select collection, field, 'max length must be positive' from f where c_nationkey = 0
  union all select collection, field, 'only strings and arrays have a max length' from f where c_nationkey = 0 and c_acctbal > 9000
  union all select collection, field, 'name is used twice' from f where c_nationkey = 1 and copy = 1)
"""


@query(FAULTS + "select * from faults")
def schema_faults(spark, sf):
    return schema_errors(_wanted(spark, sf).select("collection", "fields"))


CREATED = FAULTS + """, known as (select lower(c_name) as collection from customer where c_custkey in (select s_suppkey from supplier where s_acctbal < 0)),
report as (select c.collection,
  case when k.collection is not null then 'exists' when e.error is not null then 'failed' else 'created' end as status,
  case when k.collection is not null then 'collection exists already' else e.error end as message
from (select lower(c_name) as collection from customer) c left join known k on k.collection = c.collection
left join (select collection, min(field || ': ' || error) as error from faults group by 1) e on e.collection = c.collection)
"""


def _created(spark, sf):
    rich = table(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("c_custkey"))
    known = (
        table(spark, sf, "customer")
        .join(rich, "c_custkey", "left_semi")
        .select(F.lower("c_name").alias("collection"), F.lit(64).alias("dimension"))
    )
    none = spark.createDataFrame([], REGISTRY_TYPE)
    return ops.create_collections(known, none, _wanted(spark, sf))


@query(CREATED + "select * from report")
def collections_created(spark, sf):
    return _created(spark, sf)["report"]


@query(CREATED + """select count(*) filter (status <> 'failed') as succeeded, count(*) filter (status = 'failed') as failed,
count(*) as total from report""")
def collections_created_totals(spark, sf):
    return ops.report_totals(_created(spark, sf)["report"])


@query(CREATED + """, c as (select collection, field from (select lower(c_name) as collection, lower(c_mktsegment) as field from customer) join report using (collection) where status = 'created')
select * from c union all select collection, 'filename' from c""")
def created_schemas(spark, sf):
    return _created(spark, sf)["schemas"].select("collection", F.explode("fields.name").alias("field"))


def _page_langs(spark, sf):
    """Names asked for: languages as the page addresses spell them."""
    return table(spark, sf, "pages").select(F.regexp_extract("url", "//[^/]*/([^/]*)", 1).alias("collection"))


@query("""
select distinct regexp_extract(url, '//[^/]*/([^/]*)', 1) as collection from pages
where regexp_extract(url, '//[^/]*/([^/]*)', 1) not in (select lang from documents)
""")
def missing_collections(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("lang").alias("collection")).distinct()
    return ops.missing_collections(docs, _page_langs(spark, sf))


def _drop(spark, sf):
    langs = table(spark, sf, "documents").select(F.col("lang").alias("collection")).distinct()
    chunks = document_chunks(spark, sf)
    summaries = chunks.select("collection", F.col("source.source_name").alias("file_name")).distinct()
    asked = table(spark, sf, "documents").where("n_chars > 8000").select(
        F.explode(F.array("lang", "source")).alias("collection")
    ).where("collection <> 'en'")
    return ops.drop_collections({"collections": langs, "chunks": chunks, "summaries": summaries}, asked)


ASKED = "asked as (select distinct unnest([lang, source]) as collection from documents where n_chars > 8000)"


@query(f"""
with {ASKED}
select collection, case when collection in (select lang from documents) then 'deleted' else 'failed' end as status,
  case when collection not in (select lang from documents) then 'collection not found: ' || collection end as message
from asked where collection <> 'en'
""")
def collections_dropped(spark, sf):
    return _drop(spark, sf)["report"]


@query(f"""
with {ASKED}, kept as (select * from documents where lang not in (select collection from asked where collection <> 'en'))
select 'chunks' as store, lang as collection, count(*) as n from kept group by 2
union all select 'summaries', lang, count(distinct source) from kept group by 2
""")
def collections_left(spark, sf):
    left = _drop(spark, sf)
    counted = [
        left[name].groupBy("collection").agg(F.count("*").alias("n")).select(F.lit(name).alias("store"), "collection", "n")
        for name in ("chunks", "summaries")
    ]
    return counted[0].unionByName(counted[1])


@query("""
select lang as collection, source || '.txt' as document_name, min(doc_id) as chunk_id,
  arg_min(n_chars, doc_id) as n_chars, null::varchar as author
from documents group by 1, 2
""")
def document_listing(spark, sf):
    return ops.list_documents(document_chunks(spark, sf), ["n_chars", "author"])


def _toxic_names(spark, sf):
    toxic = table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    return table(spark, sf, "documents").join(toxic, "doc_id", "left_semi").select(
        F.col("lang").alias("collection"), F.concat(F.lit("/data/"), "source", F.lit(".txt")).alias("source_name")
    )


TOXIC = "toxic as (select distinct lang, source from documents where doc_id in (select doc_id from labels where toxic = 1))"


@query(f"with {TOXIC} select lang as collection, doc_id as chunk_id from documents where (lang, source) not in (select lang, source from toxic)")
def documents_deleted(spark, sf):
    return ops.delete_documents(document_chunks(spark, sf), _toxic_names(spark, sf))["chunks"].select(
        "collection", "chunk_id"
    )


@query("""
select distinct regexp_extract(url, '//[^/]*/([^/]*)', 1) as collection, '/data/src' || page_id || '.txt' as source_name
from pages where (regexp_extract(url, '//[^/]*/([^/]*)', 1), 'src' || page_id) not in (select lang, source from documents)
""")
def documents_not_found(spark, sf):
    names = table(spark, sf, "pages").select(
        F.regexp_extract("url", "//[^/]*/([^/]*)", 1).alias("collection"),
        F.concat(F.lit("/data/src"), F.col("page_id").cast("string"), F.lit(".txt")).alias("source_name"),
    )
    return ops.delete_documents(document_chunks(spark, sf), names)["missing"]


@query("""
with new as (select doc_id + 1000000 as doc_id, lang, source from documents where doc_id in (select doc_id from labels where quality = 1 and toxic = 1))
select lang as collection, doc_id as chunk_id from documents where (lang, source) not in (select lang, source from new)
union all select lang, doc_id from new
""")
def documents_replaced(spark, sf):
    chunks = document_chunks(spark, sf)
    good = table(spark, sf, "labels").where("quality = 1 and toxic = 1").select(F.col("doc_id").alias("chunk_id"))
    new = chunks.join(good, "chunk_id", "left_semi").withColumn("chunk_id", F.col("chunk_id") + 1_000_000)
    return ops.replace_documents(chunks, new.select(*chunks.columns))["chunks"].select("collection", "chunk_id")


@query(f"with {TOXIC} select lang as collection, source as file_name, doc_id from documents where (lang, source) not in (select lang, source from toxic)")
def dependents_dropped(spark, sf):
    kept = table(spark, sf, "documents").select(
        F.col("lang").alias("collection"), F.col("source").alias("file_name"), "doc_id"
    )
    gone = _toxic_names(spark, sf).select(
        "collection", F.regexp_extract("source_name", "/data/(.*)\\.txt", 1).alias("file_name")
    )
    return ops.drop_dependents(kept, gone)


@query("select lang as collection, count(*) as n, sum(length(text))::bigint as chars from documents group by 1")
def chunks_written(spark, sf):
    path = work_path(spark, "chunks")
    write_chunks(document_chunks(spark, sf), path, clustered=True)
    return (
        spark.read.parquet(path)
        .groupBy("collection")
        .agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    )


@query("select lang as collection, count(*) as n, sum(n_chars)::bigint as chars from documents where source <> 'src0' or lang <> 'de' group by 1")
def elements_saved(spark, sf):
    path = work_path(spark, "elements")
    elements = table(spark, sf, "documents").select(F.col("lang").alias("collection"), "source", "n_chars")
    write_elements(elements, path)
    # a second save replaces the collections it holds and no other
    write_elements(elements.where("collection = 'de' and source <> 'src0'"), path)
    return (
        spark.read.parquet(path)
        .groupBy("collection")
        .agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    )
