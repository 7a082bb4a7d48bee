import pytest

from docketry.operators import collections as ops
from docketry.operators.metadata import Field, registry_frame

CHUNKS = "collection string, chunk_id long, source struct<source_id:string,source_name:string>, content_metadata struct<title:string>"


def chunk(c, i, name, title=None):
    return (c, i, (name, name), (title,))


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [chunk("a", 2, "/x/f.txt", "second"), chunk("a", 1, "/x/f.txt", "first"), chunk("a", 3, "/x/g.txt"), chunk("b", 4, "/x/f.txt"), chunk("a", 5, "")]
    return spark.createDataFrame(rows, CHUNKS)


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([("a", 64), ("b", 64), ("empty", 64), (".hidden", 64)], "collection string, dimension int")


def test_listing(spark, chunks, known):
    schemas = registry_frame(spark, {"a": [Field("title", "string")]})
    got = {r.collection: (r.n_chunks, len(r.fields)) for r in ops.list_collections(known, schemas, chunks).collect()}
    assert got == {"a": (4, 1), "b": (1, 0), "empty": (0, 0)}
    docs = {(r.collection, r.document_name): (r.chunk_id, r.title, r.author) for r in ops.list_documents(chunks, ["title", "author"]).collect()}
    assert docs == {("a", "f.txt"): (1, "first", None), ("a", "g.txt"): (3, None, None), ("b", "f.txt"): (4, None, None)}


def test_create(spark, known):
    from pyspark.sql import functions as F

    schemas = registry_frame(spark, {"a": [Field("old", "string")]})
    wanted = registry_frame(
        spark, {"a": [Field("new", "string")], "n": [Field("title", "string")], "f": [Field("filename", "string")], "bad": [Field("x", "decimal")]}
    ).withColumn("dimension", F.lit(8))
    made = ops.create_collections(known, schemas, wanted)
    assert {r.collection: r.status for r in made["report"].collect()} == {"a": "exists", "n": "created", "f": "created", "bad": "failed"}
    assert ops.report_totals(made["report"]).first()[:] == (3, 1, 4)
    fields = {r.collection: [f.name for f in r.fields] for r in made["schemas"].collect()}
    assert fields == {"a": ["old"], "n": ["title", "filename"], "f": ["filename"]}
    assert made["collections"].count() == 6
    none = ops.create_collections(known, schemas, wanted.limit(0))
    assert ops.report_totals(none["report"]).first()[:] == (0, 0, 0)


def test_drop_and_require(spark, chunks, known):
    names = spark.createDataFrame([("a",), ("zzz",), ("a",)], "collection string")
    left = ops.drop_collections({"collections": known, "chunks": chunks}, names)
    assert left["collections"].count() == 3 and left["chunks"].count() == 1
    assert {r.collection: r.status for r in left["report"].collect()} == {"a": "deleted", "zzz": "failed"}
    with pytest.raises(ValueError, match="zzz"):
        ops.require_collections(known, names)
    ops.require_collections(known, names.where("collection = 'a'"))


def test_documents(spark, chunks):
    names = spark.createDataFrame([("a", "/x/f.txt"), ("b", "/x/none.txt"), ("b", "/x/g.txt")], "collection string, source_name string")
    out = ops.delete_documents(chunks, names)
    assert sorted(r.chunk_id for r in out["chunks"].collect()) == [3, 4, 5]
    assert sorted(map(tuple, out["missing"].collect())) == [("b", "/x/g.txt"), ("b", "/x/none.txt")]
    new = spark.createDataFrame([chunk("a", 9, "/x/f.txt"), chunk("b", 10, "/x/new.txt")], CHUNKS)
    replaced = ops.replace_documents(chunks, new)
    assert sorted(r.chunk_id for r in replaced["chunks"].collect()) == [3, 4, 5, 9, 10]
    assert [r.source_name for r in replaced["missing"].collect()] == ["/x/new.txt"]
    rows = spark.createDataFrame([("a", "f"), ("a", "g"), ("b", "f")], "collection string, file_name string")
    gone = spark.createDataFrame([("a", "f")], "collection string, file_name string")
    assert ops.drop_dependents(rows, gone).count() == 2
