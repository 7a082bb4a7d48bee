"""From files and elements to chunks."""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import Window
from pyspark.sql import functions as F

from docketry.functions.chunking import pieces_by, split_by_kind, split_long_text, split_offsets, split_tokens
from docketry.functions.text import base_name, extension, stem
from docketry.operators import ingest
from docketry.plans.registry import query, sql_base, sql_words, table, texts


@query(f"""
with u as (select page_id, {sql_base('url')} as b from pages)
select page_id, b as base_name,
  case when regexp_matches(b, '[^.]\\.[^.]*$') then regexp_replace(b, '\\.[^.]*$', '') else b end as stem,
  lower(regexp_extract(b, '[^.](\\.[^.]*)$', 1)) as extension
from u
""")
def file_names(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", base_name(url).alias("base_name"), stem(url).alias("stem"), extension(url).alias("extension")
    )


# ---------------------------------------------------------------- gates

SQL_PATH = """
'/in/' || source || '-' || doc_id || case lang when 'de' then '.pdf' when 'fr' then '.RST' when 'es' then '.xyz' else '.txt' end
"""


def _paths(spark, sf):
    """A path per document, its extension following the language."""
    suffix = F.when(F.col("lang") == "de", ".pdf").when(F.col("lang") == "fr", ".RST").when(F.col("lang") == "es", ".xyz").otherwise(".txt")
    path = F.concat(F.lit("/in/"), "source", F.lit("-"), F.col("doc_id").cast("string"), suffix)
    return table(spark, sf, "documents").select("doc_id", path.alias("path"), F.col("n_chars").alias("length"))


def _gated(spark, sf, pdf_only=False):
    paths = _paths(spark, sf)
    labels = table(spark, sf, "labels")
    listing = paths.join(labels, "doc_id", "left_semi")
    existing = paths.join(labels.where("toxic = 1"), "doc_id", "left_semi").select(
        base_name(F.col("path")).alias("document_name")
    )
    return ingest.gate_files(paths, listing, existing, pdf_only=pdf_only)


SQL_GATED = f"""
with g as (select {SQL_PATH} as path, doc_id, lang, l.toxic from documents left join labels l using (doc_id)),
gated as (select path, doc_id, case when toxic = 1 then 'document already exists in the collection' when toxic is null then 'file not found'
  when lang = 'fr' then 'file type is refused' when lang = 'es' then 'file type not supported'
  when lang <> 'de' then 'only PDF files can be used with this extract method' end as reason from g)
"""


@query(SQL_GATED + "select path, case when reason not like 'only%' then reason end as reason from gated")
def upload_gates(spark, sf):
    return _gated(spark, sf).select("path", "reason")


@query(SQL_GATED + "select path, reason from gated")
def upload_gates_pdf_only(spark, sf):
    return _gated(spark, sf, pdf_only=True).select("path", "reason")


@query(f"""
select {SQL_PATH} as path, case when lang in ('fr', 'es') then 'file type not supported'
  when n_chars * 100000 > 400 * 1024 * 1024 then 'file too large' end as reason from documents
""")
def size_gate(spark, sf):
    return _paths(spark, sf).select(
        "path", ingest.size_reason(F.col("path"), F.col("length") * 100_000).alias("reason")
    )


@query(f"select {SQL_PATH} as path from documents where doc_id not in (select doc_id from labels)")
def resumed_upload(spark, sf):
    paths = _paths(spark, sf)
    name = base_name(F.col("path"))
    listed = (
        paths.join(table(spark, sf, "labels"), "doc_id")
        .select(
            F.when(F.col("toxic") == 1, name).otherwise("").alias("metadata_filename"),
            F.when(F.col("toxic") == 1, "renamed").otherwise(name).alias("document_name"),
        )
    )
    return ingest.resume(paths, listed).select("path")


def _labelled_items(spark, sf):
    """Metadata for labelled documents, some under a name nobody asked for."""
    name = base_name(F.col("path"))
    return _paths(spark, sf).join(table(spark, sf, "labels"), "doc_id").select(
        F.when(F.col("quality") == 0, F.concat(F.lit("old-"), name)).otherwise(name).alias("filename"),
        F.to_json(F.struct("quality", F.when(F.col("toxic") == 1, "").otherwise("no").alias("note"))).alias("metadata"),
        F.col("doc_id").alias("pos"),
    )


SQL_NAME = f"replace({SQL_PATH}, '/in/', '')"


@query(f"""
select 'old-' || {SQL_NAME} as filename, 'metadata given for a file that is not in the request' as error
from documents join labels using (doc_id) where quality = 0
""")
def metadata_without_file(spark, sf):
    return ingest.metadata_without_file(_labelled_items(spark, sf), _paths(spark, sf))


@query(f"""
select {SQL_NAME} as filename, 'no metadata given; required: title, year' as error
from documents where doc_id not in (select doc_id from labels where quality = 1)
""")
def files_without_metadata(spark, sf):
    return ingest.files_without_metadata(_paths(spark, sf), _labelled_items(spark, sf), ["title", "year"])


def _failures(spark, sf):
    gated = _gated(spark, sf, pdf_only=True).where("reason is not null").select("document_name", "reason")
    failed = _paths(spark, sf).where("length > 5000").select(
        base_name(F.col("path")).alias("document_name"), F.lit("extraction failed").alias("reason")
    )
    return ingest.failure_report([failed, gated])


@query(SQL_GATED + f"""
select {SQL_NAME} as document_name, case when n_chars > 5000 then 'extraction failed' else reason end as reason
from documents join gated using (doc_id) where n_chars > 5000 or reason is not null
""")
def failed_documents(spark, sf):
    return _failures(spark, sf)


@query(SQL_GATED + """
, r as (select count(*) as total, count(*) filter (n_chars > 5000 or reason is not null) as failed from documents join gated using (doc_id))
select total, failed, total - failed as uploaded, case when failed = total then 'all failed' when failed > 0 then 'some failed' else 'all uploaded' end as state from r
""")
def upload_report(spark, sf):
    return ingest.upload_report(_paths(spark, sf), _failures(spark, sf))


@query(f"""
select {SQL_PATH} as source, {SQL_NAME} as filename, quality::varchar as quality, case when toxic = 0 then 'no' end as note
from documents left join (select * from labels where quality = 1) using (doc_id)
""")
def metadata_per_file(spark, sf):
    return ingest.metadata_table(_paths(spark, sf), _labelled_items(spark, sf))


@query(f"""
select {SQL_PATH} as source, {SQL_NAME} as filename, n_chars::bigint as size, n_chars / 8.0::double as share, case when doc_id % 5 <> 0 then n_chars % 2 = 0 end as even,
  lang || '|x' as tags, case when n_chars % 3 = 0 then 'many' else n_chars::varchar end as mixed
from documents
""")
def metadata_typed(spark, sf):
    """Metadata whose fields have kinds of their own, one of them two."""
    n, quoted = F.col("n_chars").cast("string"), lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    body = F.concat(
        F.lit('{"size": '), n, F.lit(', "share": '), (F.col("n_chars") / 8).cast("string"),
        F.when(F.col("doc_id") % 5 == 0, ', "even": null').otherwise(F.concat(F.lit(', "even": '), (F.col("n_chars") % 2 == 0).cast("string"))),
        F.lit(', "tags": ['), quoted(F.col("lang")), F.lit(', "x"], "none": [], "mixed": '), F.when(F.col("n_chars") % 3 == 0, quoted(F.lit("many"))).otherwise(n), F.lit("}"),
    )
    docs = _paths(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    items = docs.select(base_name(F.col("path")).alias("filename"), body.alias("metadata"), F.col("doc_id").alias("pos"))
    return ingest.typed_metadata_table(_paths(spark, sf), items).select(
        "source", "filename", "metadata.size", "metadata.share", "metadata.even", F.array_join("metadata.tags", "|").alias("tags"), "metadata.mixed"
    )


# ---------------------------------------------------------------- elements

SQL_ELEMENTS = """
with lines as (select doc_id, lang as collection, '/data/' || source || '/doc' || doc_id || '.pdf' as source, n_chars,
  string_split(text, chr(10)) as ls from documents),
el as (select doc_id, collection, source, n_chars, unnest(ls) as line, generate_subscripts(ls, 1) - 1 as pos from lines),
e as (select *, (length(line) % 5)::int as k, source[length('/data/x'):] as u, string_split(source, '/')[-1] as source_name from el),
c as (select *, case k when 1 then 'table' when 2 then 'chart' when 3 then 'image' when 4 then 'audio' else 'text' end as chunk_type from e)
"""


def elements(spark, sf):
    """Lines of documents as extracted elements; the kind follows the length of the line."""
    kind = "int(length(line) % 5)"
    expr = f"""
      transform(split(text, '\\n'), (line, i) -> named_struct(
        'document_type', case {kind} when 1 then 'structured' when 2 then 'structured' when 3 then 'image' when 4 then 'audio' else 'text' end,
        'metadata', named_struct(
          'content', case when {kind} in (1, 2, 3) then concat('picture of ', line) else line end,
          'source_metadata', named_struct('source_id', concat('/data/', source, '/doc', doc_id, '.pdf')),
          'content_metadata', named_struct(
            'type', case {kind} when 1 then 'structured' when 2 then 'structured' when 3 then 'image' when 4 then 'audio' else 'text' end,
            'subtype', case {kind} when 1 then 'table' when 2 then 'chart' else '' end,
            'page_number', int(i),
            'location', case when length(line) > 100 then array(double(i) / 3, double(length(line)) / 8) end),
          'table_metadata', named_struct('table_content', case when {kind} in (1, 2) then line end),
          'image_metadata', named_struct('caption', case when {kind} = 3 then concat('caption: ', line) end),
          'audio_metadata', named_struct('audio_transcript', case when {kind} = 4 then line end))))
    """
    results = texts(spark, sf).select("doc_id", F.col("lang").alias("collection"), F.expr(expr).alias("elements"))
    return ingest.flatten_results(results)


@query(SQL_ELEMENTS + "select doc_id, collection, pos::bigint as pos, source, source_name, chunk_type, case when k = 3 then 'caption: ' || line else line end as text from c where line <> '' or k = 3")
def element_chunks(spark, sf):
    return ingest.elements_to_chunks(elements(spark, sf), images=True).select(
        "doc_id", "collection", F.col("pos").cast("long").alias("pos"), "source", "source_name", "chunk_type", "text"
    )


@query(SQL_ELEMENTS + "select doc_id, chunk_type, count(*) as n from c where line <> '' and chunk_type not in ('chart', 'image') group by 1, 2")
def element_chunks_without_charts(spark, sf):
    chunks = ingest.elements_to_chunks(elements(spark, sf), charts=False)
    return chunks.groupBy("doc_id", "chunk_type").agg(F.count("*").alias("n"))


@query(SQL_ELEMENTS + """
select collection || '_::_' || source_name || '_::_' || pos || '_' || round(pos / 3.0::double, 4) || '_' || round(length(line) / 8.0::double, 4) as element_key,
  collection, source_name as file_name, 'picture of ' || line as content
from c where k in (1, 2, 3) and length(line) > 100
""")
def picture_payloads(spark, sf):
    return ingest.payload_rows(elements(spark, sf))


@query(SQL_ELEMENTS + """
select case k when 1 then 'structured(table)' when 2 then 'structured(chart)' when 3 then 'image' when 4 then 'audio' else 'text' end as type_label,
  count(*) as n_elements, coalesce(sum(case when k = 0 then length(line) end), 0)::bigint as text_chars from c group by 1
""")
def ingest_statistics(spark, sf):
    return ingest.ingest_statistics(elements(spark, sf))


@query(SQL_ELEMENTS + "select count(distinct source) as n_documents, count(*) as n_elements from c")
def ingest_totals(spark, sf):
    return ingest.ingest_totals(elements(spark, sf))


SQL_DOC_TEXT = SQL_ELEMENTS + """
, t as (select collection, source_name, string_agg(line, ' ' order by pos) as text
from c where line <> '' and k <> 3 group by 1, 2)
"""


@query(SQL_DOC_TEXT + "select collection, source_name, text from t")
def document_texts(spark, sf):
    return ingest.document_texts(ingest.elements_to_chunks(elements(spark, sf)))


# no text is over the 50,000 characters of a piece, so each is one piece
@query(SQL_DOC_TEXT + """
select collection, source_name as file_name, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))::varchar as summary from t where text <> ''
""")
def folded_summaries(spark, sf):
    """A stand-in summariser notes the length of each piece it was given."""
    whole = ingest.document_texts(ingest.elements_to_chunks(elements(spark, sf)))
    return ingest.fold_summaries(
        whole, lambda piece: str(len(piece.strip())), lambda summary, piece: f"{summary}+{len(piece.strip())}"
    )


@query("""
with s as (select lang, source, max(n_chars) as longest from documents where n_chars > 3000 group by 1, 2)
select d.lang as collection, d.source as file_name, 'longest ' || longest as summary,
  case when longest is null then 'not found' else 'found' end as status
from (select distinct lang, source from documents) d left join s using (lang, source)
""")
def summary_lookup(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("lang").alias("collection"), F.col("source").alias("file_name"), "n_chars")
    summaries = docs.where("n_chars > 3000").groupBy("collection", "file_name").agg(
        F.concat(F.lit("longest "), F.max("n_chars").cast("string")).alias("summary")
    )
    return ingest.look_up_summaries(docs.select("collection", "file_name").distinct(), summaries)


# ---------------------------------------------------------------- splitting

SIZE, OVERLAP = 128, 32


def sql_windows(rows: str, keep: str) -> str:
    step = SIZE - OVERLAP
    return f"""
with t as (select *, {sql_words('text')} as w from {rows}),
s as (select {keep}, w, unnest(range(0, greatest(len(w) - {OVERLAP + 1}, 0) + 1, {step})) as start from t where len(w) > 0)
select {keep}, (start / {step})::int as chunk_no, array_to_string(w[start + 1 : start + {SIZE}], ' ') as chunk_text,
  len(w[start + 1 : start + {SIZE}])::int as n_tokens from s
"""


@query(sql_windows("documents", "doc_id"))
def token_windows(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    return split_tokens(docs, size=SIZE, overlap=OVERLAP).select("doc_id", "chunk_no", "chunk_text", "n_tokens")


@query(f"""
with t as (select doc_id, regexp_extract_all(text, '(?:^\\s+)?\\S+\\s*') as p from documents),
s as (select doc_id, p, unnest(range(0, greatest(len(p) - {OVERLAP + 1}, 0) + 1, {SIZE - OVERLAP})) as k from t where len(p) > 0)
select doc_id, (k / {SIZE - OVERLAP})::int as chunk_no, length(array_to_string(p[1 : k], ''))::int as start,
  length(array_to_string(p[1 : k + {SIZE}], ''))::int as stop, array_to_string(p[k + 1 : k + {SIZE}], '') as chunk_text,
  len(p[k + 1 : k + {SIZE}])::int as n_tokens from s
""")
def offset_windows(spark, sf):
    """Windows that are slices of the text, with their places."""
    return split_offsets(texts(spark, sf).select("doc_id", "text"), size=SIZE, overlap=OVERLAP).select(
        "doc_id", "chunk_no", "start", "stop", "chunk_text", "n_tokens"
    )


def _byte_tokens(path: str, pattern: str):
    """A user's tokenizer: tokens of a public vocabulary; those that share a character stay together."""
    with open(path, "rb") as file:  # read on the driver, sent with the function
        ranks = dict(line.split() for line in file if line.strip())
    made = {}

    def cut(column: pd.Series) -> pd.Series:
        if not made:
            tokens = {base64.b64decode(t): int(r) for t, r in ranks.items()}
            made["it"] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=tokens, special_tokens={})
            # per token: the characters that begin in it, and whether it begins inside of one
            made["chars"], made["inside"] = np.zeros((2, max(tokens.values()) + 1), np.int64)
            for token, rank in tokens.items():
                made["chars"][rank] = sum(not 0x80 <= c < 0xC0 for c in token)
                made["inside"][rank] = 0x80 <= token[0] < 0xC0

        def pieces(text: str) -> list[str]:
            found = np.asarray(made["it"].encode_ordinary(text), np.int64)
            chars = made["chars"][found]
            starts = np.unique(np.maximum(np.cumsum(chars) - chars - made["inside"][found], 0)).tolist()
            return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True) if a < b] if starts else []

        return column.map(pieces)

    return pieces_by(cut)


@query("select doc_id, length(text)::int as n_chars, true as whole from documents where text <> ''")
def byte_token_windows(spark, sf):
    """Windows by the tokens of a byte-level vocabulary, joined without their overlaps again.

    Windows move without their document's text, which is as long as all of them together; it comes in
    once, beside the joined windows. The mark tells documents apart, also those that share an id."""
    mark = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "text"), 256)
    docs = texts(spark, sf).select("doc_id", "text").withColumn("mark", mark)
    pieces = _byte_tokens(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = split_offsets(docs, size=SIZE, overlap=OVERLAP, pieces=pieces).drop("doc_id", "text")
    before = F.coalesce(F.lag("stop").over(Window.partitionBy("mark").orderBy("chunk_no")), F.lit(0))
    own = rows.withColumn("before", before).withColumn("own", F.expr("substring(chunk_text, before - start + 1)"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_no", "own"))), lambda x: x["own"]), "")
    again = own.groupBy("mark").agg(F.max("stop").alias("n_chars"), joined.alias("joined"))
    given = table(spark, sf, "documents").select("doc_id", "text").withColumn("mark", mark)
    compared = given.join(again, "mark").select("mark", "doc_id", "n_chars", (F.col("joined") == F.col("text")).alias("whole"))
    # rows that come twice are one document
    return compared.groupBy("mark").agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.first("whole").alias("whole")).drop("mark")


@query(f"""
select * from ({sql_windows("(select * from documents where lang in ('en', 'fr'))", "doc_id")})
union all select doc_id, 0, text, len({sql_words('text')})::int from documents where lang not in ('en', 'fr') and text <> ''
""")
def windows_by_kind(spark, sf):
    docs = texts(spark, sf).select(
        "doc_id",
        F.when(F.col("lang") == "en", "html").when(F.col("lang") == "fr", "text").otherwise("pdf").alias("kind"),
        "text",
    )
    return split_by_kind(docs, "kind", size=SIZE, overlap=OVERLAP).select(
        "doc_id", "chunk_no", "chunk_text", "n_tokens"
    )


@query()
def separator_pieces(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    return split_long_text(docs, limit=2_000, overlap=200).select("doc_id", "piece_no", "piece")


@query(SQL_ELEMENTS + """
select doc_id, pos::bigint as pos, coalesce(quality, -1)::bigint as quality from c left join labels using (doc_id) where line <> '' and k <> 3
""")
def metadata_on_chunks(spark, sf):
    chunks = ingest.elements_to_chunks(elements(spark, sf))
    source = F.concat(F.lit("/data/"), "source", F.lit("/doc"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    metadata = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        source.alias("source"), F.col("quality").cast("long").alias("quality")
    )
    return ingest.attach_metadata(chunks, metadata).select("doc_id", F.col("pos").cast("long").alias("pos"), F.coalesce("quality", F.lit(-1).cast("long")).alias("quality"))


@query()
def hashed_vectors(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    vectors, _ = ingest.hashed_vectors(docs, dimension=256)
    return vectors.select("doc_id", "vector")


@query("select doc_id, [length(text)::double, n_chars::double][1] as first, 2::bigint as dimension from documents")
def embedded_by_function(spark, sf):
    """A stand-in embedding: length in characters and in bytes."""
    docs = texts(spark, sf).select("doc_id", "text")
    vectors = ingest.embed(docs, lambda texts: [[float(len(t)), float(len(t.encode()))] for t in texts], 2)
    return vectors.select(
        "doc_id", F.col("vector")[0].cast("double").alias("first"), F.size("vector").cast("long").alias("dimension")
    )
