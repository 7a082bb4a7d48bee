"""From files and extracted elements to chunk rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.chunking import split_long_text
from docketry.functions.rows import exploded
from docketry.functions.text import base_name, element_key, extension, tokens
from docketry.operators.ordered import joined_in_order
from docketry.sources.tables import first_per_key

# File kinds that are refused, and those with the audio size limit.
REFUSED = (".rst", ".rtf", ".org")
AUDIO = (".mp3", ".wav")
# Kinds a default upload accepts.
ACCEPTED = (
    ".bmp", ".docx", ".html", ".jpeg", ".json", ".md", ".mp3", ".pdf", ".png", ".pptx", ".sh",
    ".svg", ".tiff", ".txt", ".wav",
)
STRUCTURED = ("table", "chart")
MAX_FIELDS = 10_000


# ---------------------------------------------------------------- gates


def size_reason(
    name: Column, length: Column, accepted=ACCEPTED, max_mb: float = 400, max_audio_mb: float | None = None
) -> Column:
    """Why a file may not be uploaded, null if it may; audio has a reason of its own if it has a limit."""
    kind = extension(name)
    reason = F.when(~kind.isin(*accepted), "file type not supported")
    if max_audio_mb:
        reason = reason.when(kind.isin(*AUDIO) & (length > max_audio_mb * 1024 * 1024), "audio file too large")
    return reason.when(length > max_mb * 1024 * 1024, "file too large")


def gate_files(
    requested: DataFrame, listing: DataFrame, existing: DataFrame, accepted=ACCEPTED,
    pdf_only: bool = False,
) -> DataFrame:
    """Requested paths with `reason`: null for those to load, else the first that applies.

    `requested` has path; `listing` has path, length (real files only); `existing`
    has document_name, the names already in the collection.
    """
    name, kind = base_name(F.col("path")), extension(F.col("path"))
    present = listing.select("path", "length").dropDuplicates(["path"])
    loaded = existing.select("document_name").distinct().withColumn("loaded", F.lit(True))
    gated = (
        requested.select("path")
        .distinct()
        .withColumn("document_name", name)
        .join(present, "path", "left")
        .join(loaded, "document_name", "left")
    )
    reason = (
        F.when(F.col("loaded"), "document already exists in the collection")
        .when(F.col("length").isNull(), "file not found")
        .when(kind.isin(*REFUSED), "file type is refused")
        .when(~kind.isin(*accepted), "file type not supported")
    )
    if pdf_only:
        reason = reason.when(kind != ".pdf", "only PDF files can be used with this extract method")
    return gated.select("path", "document_name", "length", reason.alias("reason"))


def resume(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Files whose name is not listed yet; `listed` has metadata_filename, document_name."""
    done = listed.select(
        F.coalesce(F.nullif("metadata_filename", F.lit("")), "document_name").alias("done")
    ).distinct()
    return files.join(done, base_name(F.col("path")) == F.col("done"), "left_anti")


def metadata_without_file(items: DataFrame, requested: DataFrame) -> DataFrame:
    """Error rows for metadata that names a file not in the request."""
    names = requested.select(base_name(F.col("path")).alias("filename")).distinct()
    return items.join(names, "filename", "left_anti").select(
        "filename", F.lit("metadata given for a file that is not in the request").alias("error")
    )


def files_without_metadata(requested: DataFrame, items: DataFrame, required: list[str]) -> DataFrame:
    """Error rows for files lacking metadata when the schema requires some fields."""
    names = requested.select(base_name(F.col("path")).alias("filename")).distinct()
    bare = names.join(items.select("filename").distinct(), "filename", "left_anti")
    message = "no metadata given; required: " + ", ".join(required)
    return bare.where(F.lit(bool(required))).select("filename", F.lit(message).alias("error"))


def failure_report(reasons: list[DataFrame]) -> DataFrame:
    """First reason per file; earlier lists go first. Each list has document_name, reason."""
    ranked = [
        df.select("document_name", F.lit(i).alias("priority"), "reason") for i, df in enumerate(reasons)
    ]
    every = ranked[0]
    for df in ranked[1:]:
        every = every.unionByName(df)
    return every.groupBy("document_name").agg(
        F.min(F.struct("priority", "reason")).getField("reason").alias("reason")
    )


def upload_report(requested: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: files uploaded, failed and in all, and the overall state."""
    names = requested.select(base_name(F.col("path")).alias("document_name")).distinct()
    failed = failures.select("document_name").distinct().withColumn("failed", F.lit(True))
    joined = names.join(failed, "document_name", "left")
    n_failed = F.count_if(F.coalesce("failed", F.lit(False)))
    return joined.agg(F.count("*").alias("total"), n_failed.alias("failed")).select(
        "total",
        "failed",
        (F.col("total") - F.col("failed")).alias("uploaded"),
        F.when(F.col("total") == 0, "empty")
        .when(F.col("failed") == F.col("total"), "all failed")
        .when(F.col("failed") > 0, "some failed")
        .otherwise("all uploaded")
        .alias("state"),
    )


# ---------------------------------------------------------------- elements and chunks


def flatten_results(results: DataFrame, elements: str = "elements") -> DataFrame:
    """One row per element of each result list, with its place in the list."""
    rest = [c for c in results.columns if c != elements]
    return exploded(results, elements, "element", "pos").select(*rest, "pos", "element.*")


def element_text(tables: bool = True, charts: bool = True, images: bool = False) -> Column:
    """Text of an element by its kind, null for kinds that are switched off."""
    subtype = F.col("metadata.content_metadata.subtype")
    kept = [s for s, on in zip(STRUCTURED, (tables, charts), strict=True) if on]
    kind = F.col("document_type")
    text = F.when(kind == "text", F.col("metadata.content"))
    if kept:
        text = text.when(
            (kind == "structured") & subtype.isin(*kept), F.col("metadata.table_metadata.table_content")
        )
    if images:
        text = text.when(kind == "image", F.col("metadata.image_metadata.caption"))
    return text.when(kind == "audio", F.col("metadata.audio_metadata.audio_transcript"))


def elements_to_chunks(elements: DataFrame, **kinds: bool) -> DataFrame:
    """Elements with text as rows: adds text, source, source_name, chunk_type; blanks are dropped."""
    source = F.col("metadata.source_metadata.source_id")
    kind = F.when(
        F.col("document_type") == "structured", F.col("metadata.content_metadata.subtype")
    ).otherwise(F.col("document_type"))
    return (
        elements.withColumn("text", element_text(**kinds))
        .where(F.col("text") != "")
        .withColumn("source", source)
        .withColumn("source_name", base_name(source))
        .withColumn("chunk_type", kind)
    )


def attach_metadata(chunks: DataFrame, metadata: DataFrame, source: str = "source") -> DataFrame:
    """Metadata of the file on each of its chunks; `metadata` has one row per source."""
    return chunks.join(metadata, source, "left")


def metadata_table(files: DataFrame, items: DataFrame, raw: str = "metadata") -> DataFrame:
    """One row per path, one text column per field any file has.

    Null, "" and [] all become null; `filename` is always there. For a file named
    twice in `items` (filename, metadata, pos) the later one counts.
    """
    last = first_per_key(items.select("filename", raw, "pos"), ["filename"], [-F.col("pos")])
    found = (
        last.select(F.explode(F.json_object_keys(raw)).alias("field")).distinct().limit(MAX_FIELDS + 1).collect()
    )
    if len(found) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} metadata fields")
    names = sorted({r["field"] for r in found} - {"filename"})
    entries = F.try_variant_get(F.try_parse_json(F.col(raw)), "$", "map<string,variant>")
    last = last.select("filename", entries.alias("entries"))

    def value(name: str):
        text = F.try_variant_get(F.try_element_at("entries", F.lit(name)), "$", "string")
        return F.nullif(F.nullif(text, F.lit("")), F.lit("[]")).alias(name)

    columns = [value(name) for name in names]
    named = files.select(F.col("path").alias("source"), base_name(F.col("path")).alias("filename"))
    return named.join(last, "filename", "left").select("source", "filename", *columns)


def column_type(schema: str) -> str:
    """Column type of a variant schema: whole numbers, numbers, booleans, texts and lists of them keep
    their kind; what is mixed, nested or unknown is text."""
    if schema.startswith(("DECIMAL", "DOUBLE", "FLOAT")):
        return "double"
    if schema.startswith("ARRAY<"):
        inner = schema[len("ARRAY<") : -1]
        plain = inner in ("BIGINT", "BOOLEAN", "STRING") or inner.startswith(("DECIMAL", "DOUBLE", "FLOAT"))
        return f"array<{column_type(inner)}>" if plain else "string"
    return {"BIGINT": "bigint", "BOOLEAN": "boolean"}.get(schema, "string")


def typed_metadata_table(files: DataFrame, items: DataFrame, raw: str = "metadata") -> DataFrame:
    """One row per path: source, filename and `metadata`, a struct of all fields that any file has.

    A field's type is that of all its values together, merged in Spark; null, "" and [] are null and
    say nothing about it. Fields of mixed kinds are text. For a file named twice in `items`
    (filename, metadata, pos) the later one counts. Without any field there is no struct."""
    last = first_per_key(items.select("filename", raw, "pos"), ["filename"], [-F.col("pos")])
    entries = F.try_variant_get(F.try_parse_json(F.col(raw)), "$", "map<string,variant>")
    last = last.select("filename", F.map_filter(entries, lambda _, v: ~_says_nothing(v)).alias("entries"))
    each = last.select(F.explode("entries").alias("field", "value")).where("field <> 'filename'")
    found = each.groupBy("field").agg(F.schema_of_variant_agg("value").alias("type")).orderBy("field").limit(MAX_FIELDS + 1).collect()
    if len(found) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} metadata fields")
    values = [F.try_variant_get(F.try_element_at("entries", F.lit(r["field"])), "$", column_type(r["type"])).alias(r["field"]) for r in found]
    named = files.select(F.col("path").alias("source"), base_name(F.col("path")).alias("filename"))
    return named.join(last, "filename", "left").select("source", "filename", *([F.struct(*values).alias("metadata")] if values else []))


def _says_nothing(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return kind.isNull() | (kind == "VOID") | (kind == "ARRAY<VOID>") & (F.size(F.try_variant_get(value, "$", "array<variant>")) == 0) | F.coalesce(F.try_variant_get(value, "$", "string") == "", F.lit(False))


def payload_rows(elements: DataFrame) -> DataFrame:
    """Pictures to keep: image and structured elements that have a location."""
    content = F.col("metadata.content_metadata")
    file_name = base_name(F.col("metadata.source_metadata.source_id"))
    key = element_key(F.col("collection"), file_name, content["page_number"], content["location"])
    return elements.where(
        F.col("document_type").isin("image", "structured") & content["location"].isNotNull()
    ).select(
        key.alias("element_key"),
        "collection",
        file_name.alias("file_name"),
        F.col("metadata.content").alias("content"),
    )


def document_texts(chunks: DataFrame, pos: str = "pos", part_rows: int | None = None) -> DataFrame:
    """Whole text of each document: element texts joined by a blank; in parts if part_rows is given."""
    return joined_in_order(chunks, ["collection", "source_name"], pos, "text", " ", part_rows)


def ingest_statistics(elements: DataFrame) -> DataFrame:
    """Per kind of element: how many, and characters of raw text."""
    subtype = F.nullif(F.col("metadata.content_metadata.subtype"), F.lit(""))
    kind = F.coalesce("document_type", F.lit("unknown"))
    label = F.when(subtype.isNotNull(), F.concat(kind, F.lit("("), subtype, F.lit(")"))).otherwise(kind)
    chars = F.when(F.col("document_type") == "text", F.length("metadata.content"))
    return elements.groupBy(label.alias("type_label")).agg(
        F.count("*").alias("n_elements"), F.coalesce(F.sum(chars), F.lit(0)).alias("text_chars")
    )


def ingest_totals(elements: DataFrame) -> DataFrame:
    """One row: documents and elements seen."""
    return elements.agg(
        F.count_distinct("metadata.source_metadata.source_id").alias("n_documents"),
        F.count("*").alias("n_elements"),
    )


# ---------------------------------------------------------------- user functions


def embed(
    df: DataFrame, function: Callable[[pd.Series], list], dimension: int, text: str = "text"
) -> DataFrame:
    """Adds `vector` from a user function over batches of texts; its length is checked."""
    schema = df.select("*", F.lit(None).cast("array<float>").alias("vector")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = [list(v) for v in function(batch[text])]
            if any(len(v) != dimension for v in vectors):
                raise ValueError(f"the embedding function must give {dimension} numbers per text")
            yield batch.assign(vector=vectors)

    return df.mapInPandas(run, schema)


def hashed_vectors(df: DataFrame, dimension: int = 2048, text: str = "text", fitted=None) -> tuple:
    """Adds `vector` without a model: hashed term counts, weighted by rarity, at unit length.

    Gives the rows and the fitted weights, which embed queries the same way.
    """
    counted = HashingTF(inputCol="tokens_in", outputCol="counts_in", numFeatures=dimension).transform(
        df.withColumn("tokens_in", tokens(F.col(text)))
    )
    weights = fitted or IDF(inputCol="counts_in", outputCol="weighted_in").fit(counted)
    unit = Normalizer(inputCol="weighted_in", outputCol="unit_in").transform(weights.transform(counted))
    out = unit.withColumn("vector", vector_to_array("unit_in", "float32")).drop(
        "tokens_in", "counts_in", "weighted_in", "unit_in"
    )
    return out, weights


def fold_summaries(
    parts: DataFrame, first: Callable[[str], str], more: Callable[[str, str], str], limit: int = 50_000,
    overlap: int = 200,
) -> DataFrame:
    """One summary per document: the first piece starts it, each further one updates it.

    Pieces are those of the whole text, whether it comes whole or in parts (part_no), so the result
    depends on the text alone. They stream through one task in order; only the running summary is held.
    """
    keys = ["collection", "source_name"]
    whole = joined_in_order(parts, keys, "part_no", "text", " ") if "part_no" in parts.columns else parts
    pieces = split_long_text(whole, "text", limit, overlap).select(*keys, "piece_no", "piece")
    sorted_pieces = pieces.repartition(*keys).sortWithinPartitions(*keys, "piece_no")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, summary = None, None
        done: list[tuple] = []
        for batch in batches:
            for collection, source_name, piece in zip(
                batch["collection"], batch["source_name"], batch["piece"], strict=True
            ):
                if (collection, source_name) == current:
                    summary = more(summary, piece)
                    continue
                if current is not None:
                    done.append((*current, summary))
                current, summary = (collection, source_name), first(piece)
            if done:
                yield pd.DataFrame(done, columns=["collection", "file_name", "summary"])
                done = []
        if current is not None:
            yield pd.DataFrame([(*current, summary)], columns=["collection", "file_name", "summary"])

    kinds = {f.name: f.dataType.simpleString() for f in parts.schema}
    return sorted_pieces.mapInPandas(
        fold, f"collection {kinds['collection']}, file_name {kinds['source_name']}, summary string"
    )


def look_up_summaries(asked: DataFrame, summaries: DataFrame) -> DataFrame:
    """Summary and status of each asked collection and file."""
    keys = ["collection", "file_name"]
    return asked.join(summaries.select(*keys, "summary"), keys, "left").withColumn(
        "status", F.when(F.col("summary").isNull(), "not found").otherwise("found")
    )
