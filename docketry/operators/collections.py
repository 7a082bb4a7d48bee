"""Collections: named sets of chunks, their schemas, documents and removal.

Tables: `collections(collection, dimension)`, `schemas(collection, fields)`,
`chunks(collection, chunk_id, source, content_metadata, ...)`, and the payload and
summary tables, both with `collection` and `file_name`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import base_name
from docketry.operators.metadata import schema_errors
from docketry.sources.tables import first_per_key, replace_group

DIMENSION = 2048
FILENAME_FIELD = (
    "named_struct('name', 'filename', 'type', 'string', 'required', false, 'array_type', "
    "cast(null as string), 'max_length', cast(null as int), 'description', cast(null as string))"
)
NO_FIELDS = (
    "cast(array() as array<struct<name:string,type:string,required:boolean,"
    "array_type:string,max_length:int,description:string>>)"
)


def add_filename_field(schemas: DataFrame) -> DataFrame:
    has = F.exists("fields", lambda f: f["name"] == "filename")
    return schemas.withColumn(
        "fields",
        F.when(has, F.col("fields")).otherwise(F.concat("fields", F.array(F.expr(FILENAME_FIELD)))),
    )


def create_collections(collections: DataFrame, schemas: DataFrame, wanted: DataFrame) -> dict[str, DataFrame]:
    """Create many collections: `wanted` has collection, dimension, fields.

    Gives the new `collections` and `schemas` and a `report` with a row per name:
    created, exists, or failed with its first error. A name asked for twice is made
    once.
    """
    once = first_per_key(wanted, ["collection"], [F.col("dimension")])
    faults = (
        schema_errors(once.select("collection", "fields"))
        .groupBy("collection")
        .agg(F.min(F.concat_ws(": ", "field", "error")).alias("error"))
    )
    known = collections.select("collection", F.lit(True).alias("known"))
    report = (
        once.join(known, "collection", "left")
        .join(faults, "collection", "left")
        .select(
            "collection",
            F.when(F.col("known"), "exists").when(F.col("error").isNotNull(), "failed").otherwise("created").alias("status"),
            F.when(F.col("known"), "collection exists already").otherwise(F.col("error")).alias("message"),
        )
    )
    made = report.where("status = 'created'").select("collection")
    new = once.join(made, "collection", "left_semi")
    new_schemas = add_filename_field(new.select("collection", "fields"))
    return {
        "collections": collections.unionByName(new.select("collection", "dimension")),
        "schemas": set_schemas(schemas, new_schemas),
        "report": report,
    }


def report_totals(report: DataFrame) -> DataFrame:
    """One row: how many succeeded, how many failed, how many in all. Empty input gives zeros."""
    failed = F.count_if(F.col("status") == "failed")
    return report.agg(
        (F.count("*") - failed).alias("succeeded"), failed.alias("failed"), F.count("*").alias("total")
    )


def set_schemas(schemas: DataFrame, new: DataFrame) -> DataFrame:
    """Registry upsert: the old rows of a collection go, the new ones come."""
    return replace_group(schemas, new, ["collection"])


def schema_of(schemas: DataFrame, collection: str) -> DataFrame:
    """Fields of one collection in order, no rows if it has no schema."""
    return (
        schemas.where(F.col("collection") == collection)
        .select(F.posexplode("fields").alias("pos", "f"))
        .select("pos", "f.*")
        .orderBy("pos")
    )


def list_collections(collections: DataFrame, schemas: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every visible collection with its row count and fields; names from "." on are hidden."""
    counts = chunks.groupBy("collection").agg(F.count("*").alias("n_chunks"))
    return (
        collections.select("collection")
        .where(~F.col("collection").startswith("."))
        .join(counts, "collection", "left")
        .join(schemas, "collection", "left")
        .select(
            "collection",
            F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
            F.coalesce("fields", F.expr(NO_FIELDS)).alias("fields"),
        )
    )


def drop_collections(tables: dict[str, DataFrame], names: DataFrame) -> dict[str, DataFrame]:
    """Remove collections from every given table that has them.

    `report` has a row per asked name: deleted, or failed because it is not known.
    """
    asked = names.select("collection").distinct()
    known = tables["collections"].select("collection", F.lit(True).alias("known"))
    report = asked.join(known, "collection", "left").select(
        "collection",
        F.when(F.col("known"), "deleted").otherwise("failed").alias("status"),
        F.when(F.col("known").isNull(), F.concat(F.lit("collection not found: "), "collection")).alias("message"),
    )
    left = {name: df.join(asked, "collection", "left_anti") for name, df in tables.items()}
    return {**left, "report": report}


def missing_collections(collections: DataFrame, names: DataFrame) -> DataFrame:
    return names.select("collection").distinct().join(collections, "collection", "left_anti")


def require_collections(collections: DataFrame, names: DataFrame, shown: int = 20) -> None:
    """Raise if a name is not a collection; called before a search or an upload."""
    missing = [r[0] for r in missing_collections(collections, names).limit(shown).collect()]
    if missing:
        raise ValueError(f"collections do not exist: {', '.join(sorted(missing))}")


def list_documents(chunks: DataFrame, fields: list[str], source: str = "source.source_name") -> DataFrame:
    """Each document of each collection once, with metadata taken from its first chunk.

    A field the metadata lacks is null; a chunk without a name is left out.
    """
    have = chunks.schema["content_metadata"].dataType.names if "content_metadata" in chunks.columns else []
    picked = [
        (F.col(f"content_metadata.`{f}`") if f in have else F.lit(None).cast("string")).alias(f)
        for f in fields
    ]
    named = chunks.select(
        "collection", base_name(F.col(source)).alias("document_name"), "chunk_id", *picked
    ).where("document_name <> ''")
    return first_per_key(named, ["collection", "document_name"], [F.col("chunk_id")])


def delete_documents(
    chunks: DataFrame, names: DataFrame, source: str = "source.source_name"
) -> dict[str, DataFrame]:
    """Remove documents by exact source name: `names` has collection, source_name.

    All that exist go; `missing` lists those that do not.
    """
    asked = names.select("collection", "source_name").distinct()
    keyed = chunks.withColumn("_name", F.col(source))
    match = [F.col("c.collection") == F.col("n.collection"), F.col("c._name") == F.col("n.source_name")]
    kept = keyed.alias("c").join(asked.alias("n"), match, "left_anti").drop("_name")
    present = keyed.alias("c").join(asked.alias("n"), match, "left_semi").select(
        "collection", F.col("_name").alias("source_name")
    ).distinct()
    return {
        "chunks": kept,
        "missing": asked.join(present, ["collection", "source_name"], "left_anti"),
    }


def replace_documents(chunks: DataFrame, new: DataFrame, source: str = "source.source_name") -> dict[str, DataFrame]:
    """Delete the documents that come anew, then add their chunks."""
    names = new.select("collection", F.col(source).alias("source_name"))
    gone = delete_documents(chunks, names, source)
    return {"chunks": gone["chunks"].unionByName(new), "missing": gone["missing"]}


def drop_dependents(dependents: DataFrame, deleted: DataFrame) -> DataFrame:
    """Payload or summary rows left after their documents went (collection, file_name)."""
    return dependents.join(
        deleted.select("collection", "file_name").distinct(), ["collection", "file_name"], "left_anti"
    )
