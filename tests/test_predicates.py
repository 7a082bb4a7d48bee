import pytest

from docketry.operators.metadata import Field, registry_frame
from docketry.operators.predicates import FilterError, accepting_collections, check_filter, covering_collections, filter_chunks, from_conditions

FIELDS = [
    Field("title", "string"),
    Field("pages", "integer"),
    Field("rating", "float"),
    Field("is_public", "boolean"),
    Field("created", "datetime"),
    Field("tags", "array", array_type="string", max_length=10),
    Field("scores", "array", array_type="float"),
    Field("flags", "array", array_type="boolean"),
]


def leaf(op, field, value=None, **more):
    return {"op": op, "field": field, "value": value, **more}


@pytest.mark.parametrize(
    "spec",
    [
        leaf("==", "title", "x"), leaf("LIKE", "title", "%x%"), leaf("like", "title", "50\\%\\_\\\\ \n%"), leaf("NOT IN", "title", ["a", "b"]),
        leaf("in", "pages", [1, 2]), leaf("in", "rating", [1, 2.5]), leaf("between", "pages", [1, 1]),
        leaf("between", "created", ["2024-01-01", "Jan 2, 2024"]), leaf("before", "created", "2024-01-01"),
        leaf("!=", "is_public", False), leaf("==", "tags", ["a"]), leaf("in", "tags", ["a"]),
        leaf("includes", "tags", "a"), leaf("includes", "tags", ["a", "b"]), leaf("array_contains", "scores", 1.5),
        leaf("array_contains_any", "flags", [True]), leaf("array_length", "tags", 0, cmp=">"), leaf("has", "tags", "a"),
        {"and": [leaf("==", "pages", 1), {"not": {"or": [leaf("==", "pages", 2)]}}]},
    ],
)
def test_accepted(spec):
    check_filter(spec, FIELDS)


@pytest.mark.parametrize(
    "spec",
    [
        leaf("==", "author", "x"), leaf(">", "title", "x"), leaf("like", "pages", "1%"), leaf("like", "title", 5),
        leaf("==", "title", None), leaf("==", "title", "  "), leaf("==", "title", 5), leaf("is null", "title"),
        leaf("==", "pages", "five"), leaf("==", "pages", 1.5), leaf("==", "pages", True), leaf("in", "pages", []),
        leaf("in", "pages", 5), leaf("in", "pages", [1, "a"]), leaf("in", "rating", [float("nan")]),
        leaf("in", "rating", [float("inf")]), leaf("in", "created", ["2024-01-01"]), leaf("in", "is_public", [True]),
        leaf("between", "title", ["a", "b"]), leaf("between", "pages", [2, 1]), leaf("between", "pages", [1]),
        leaf("between", "created", ["2024-02-01", "2024-01-01"]), leaf("before", "pages", 3), leaf(">", "is_public", True),
        leaf("==", "is_public", "true"), leaf("==", "created", "soon"), leaf("==", "tags", "a"), leaf("==", "tags", []),
        leaf("includes", "title", "a"), leaf("includes", "tags", ""), leaf("in", "tags", ["a", ""]), leaf("in", "tags", ["a", 1]),
        leaf("array_length", "tags", 0), leaf("array_length", "tags", 0, cmp="!="), leaf("array_length", "tags", -1),
        leaf("array_length", "tags", 11, cmp="<"), leaf("array_length", "tags", 1.5), leaf("array_length", "title", 2),
        leaf("has", "title", "a"), leaf("has", "tags", ["a"]), leaf("array_contains", "tags", ["a"]),
        leaf("in", "tags", ["a"] * 11), leaf("like", "title", "abc\\"), leaf("like", "title", "a\\b%"), leaf("like", "title", "%\\\\\\"), {"and": []}, {}, "title == 1", {"or": [leaf("==", "pages", 1)], "and": []},
    ],
)
def test_refused(spec):
    with pytest.raises(FilterError):
        check_filter(spec, FIELDS)


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [
        (1, ("alpha", 5, ["red", "blue"], True)),
        (2, ("beta", None, [], False)),
        (3, (None, 7, None, None)),
    ]
    return spark.createDataFrame(rows, "id int, content_metadata struct<title:string,pages:long,tags:array<string>,is_public:boolean>")


def ids(chunks, spec, **options):
    return sorted(r.id for r in filter_chunks(chunks, spec, FIELDS, **options).select("id").collect())


@pytest.mark.parametrize(
    "spec, want",
    [
        (leaf("==", "title", "ALPHA"), [1]), (leaf("!=", "title", "alpha"), [2]), ({"not": leaf("==", "title", "alpha")}, [2, 3]),
        ({"not": {"not": leaf("==", "title", "alpha")}}, [1]), ({"not": {"and": [leaf(">", "pages", 1), leaf("==", "title", "alpha")]}}, [2, 3]),
        (leaf("like", "title", "%a"), [1, 2]), (leaf("like", "title", "A%"), []), (leaf("not in", "pages", [5]), [3]),
        ({"not": leaf("in", "pages", [5])}, [2, 3]), (leaf("includes", "tags", ["RED", "blue"]), [1]),
        (leaf("array_contains", "tags", "RED"), []), (leaf("does not include", "tags", ["red"]), [2]),
        ({"not": leaf("in", "tags", ["red"])}, [2, 3]), (leaf("array_length", "tags", 1, cmp="<"), [2]),
        (leaf("array_length", "tags", 2), [1]), (leaf("has not", "tags", "red"), [2]), (leaf("=", "is_public", False), [2]),
        (None, [1, 2, 3]), ({}, [1, 2, 3]),
    ],
)
def test_rows_kept(chunks, spec, want):
    assert ids(chunks, spec) == want


def test_generated_and_missing_schema(chunks):
    broken = leaf("like", "title", "abc\\")
    assert ids(chunks, {"and": [broken, leaf("==", "pages", 5)]}, generated=True) == [1, 2, 3]
    with pytest.raises(FilterError, match="backslash"):
        ids(chunks, broken)
    bad = leaf("==", "author", "x")
    assert ids(chunks, bad, generated=True) == [1, 2, 3]
    with pytest.raises(FilterError):
        ids(chunks, bad)
    assert filter_chunks(chunks, bad, []).count() == 3


def test_many_collections():
    sets = {"a": FIELDS, "b": [Field("title", "string")], "free": []}
    spec = leaf(">", "pages", 3)
    assert accepting_collections(spec, sets, strict=False) == ["a", "free"]
    with pytest.raises(FilterError, match="b:"):
        accepting_collections(spec, sets)
    with pytest.raises(FilterError):
        accepting_collections(leaf("==", "nothing", 1), {"a": FIELDS}, strict=False)
    assert accepting_collections(None, sets) == ["a", "b", "free"]


def test_condition_lists(chunks):
    spec = from_conditions([{"range": {"pages": {"gte": 5, "lt": 7}}}, {"wildcard": {"title": {"value": "al?ha*"}}}])
    assert ids(chunks, spec) == [1]
    assert from_conditions([]) is None
    assert from_conditions([{"wildcard": {"title": "50%_*"}}])["and"][0]["value"] == "50\\%\\_%"
    with pytest.raises(FilterError):
        from_conditions([{"fuzzy": {"title": "x"}}])


def test_covering_collections_are_the_accepting_ones(spark):
    """Beside the loop, over schemas of all kinds of fields and filters of all kinds of leaves."""
    import itertools

    kinds = [Field("x", t) for t in ("string", "datetime", "number", "integer", "float", "boolean")]
    kinds += [Field("x", "array", array_type=t, max_length=m) for t in ("string", "number", "integer", "float", "boolean") for m in (None, 2)]
    schemas = {"none": [], "other": [Field("z", "string")]}
    for i, (a, b) in enumerate(itertools.product(kinds, kinds)):
        schemas[f"s{i}"] = [a, Field("y", b.type, array_type=b.array_type, max_length=b.max_length)]
    registry = registry_frame(spark, schemas).persist()
    specs = [
        leaf("==", "x", "2024-01-05"), leaf(">", "x", 3), leaf("==", "x", True), leaf("in", "x", ["a", "b", "c"]), leaf("in", "x", [1, 2]), leaf("array_length", "x", 3, cmp=">"),
        leaf("includes", "x", ["a"]), leaf("between", "x", [1.5, 2]), leaf("like", "x", "a%"), {"and": [leaf("==", "x", 1), {"not": leaf("array_contains_any", "y", [1.5])}]},
        {"or": [leaf("has", "x", "a"), leaf("before", "y", "2024-01-01")]}, leaf("is null", "x"), leaf("==", "none", 1), None,
    ]
    for spec in specs:
        try:
            want = accepting_collections(spec, schemas, strict=False)
        except FilterError:
            want = []
        assert sorted(r.collection for r in covering_collections(spec, registry).collect()) == sorted(want), spec
    with pytest.raises(FilterError):
        covering_collections({"and": []}, registry)
    registry.unpersist()


def test_covering_many_schemas(spark):
    """A hundred thousand schemas, by one join and one count."""
    from pyspark.sql import functions as F

    row = F.struct(F.lit("x").alias("name"), F.when(F.col("id") % 3 == 0, "integer").otherwise("string").alias("type"), F.lit(False).alias("required"), F.lit(None).cast("string").alias("array_type"), F.lit(None).cast("int").alias("max_length"), F.lit(None).cast("string").alias("description"))
    registry = spark.range(100_000).select(F.col("id").cast("string").alias("collection"), F.array(row).alias("fields"))
    assert covering_collections(leaf(">", "x", 1), registry).count() == 33_334
