import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docketry.functions.times import is_date_only, literal_time, parse_time
from docketry.operators.metadata import Field, check_fields, registry_frame, schema_errors, validate_metadata, with_filename


def check(spark, fields, *objects):
    df = spark.createDataFrame([(i, o if isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objects)], "i int, metadata string")
    return validate_metadata(df, fields).orderBy("i").collect()


def one(spark, field, value):
    row = check(spark, [field], {field.name: value})[0]
    return (row.normalised[field.name], None) if row.valid else (None, row.errors[0])


@pytest.mark.parametrize(
    "field, value, want",
    [
        (Field("s", "string"), "  MiXed ", "mixed"),
        (Field("s", "string"), " \t ", None),
        (Field("s", "string"), None, None),
        (Field("d", "datetime"), "2015-06-15 10:30:00", datetime(2015, 6, 15, 10, 30)),
        (Field("d", "datetime"), "June 15, 2015 10:30 AM", datetime(2015, 6, 15, 10, 30)),
        (Field("d", "datetime"), "2023/01/20 14:15", datetime(2023, 1, 20, 14, 15)),
        (Field("d", "datetime"), "Jan 20, 2023 2:15 PM", datetime(2023, 1, 20, 14, 15)),
        (Field("d", "datetime"), " JANUARY 5, 2023 2:15pm ", datetime(2023, 1, 5, 14, 15)),
        (Field("d", "datetime"), "03/10/2024 09:45", datetime(2024, 3, 10, 9, 45)),
        (Field("d", "datetime"), "March 10, 2024", datetime(2024, 3, 10)),
        (Field("d", "datetime"), "2024-03-10T12:00:00.75+02:00", datetime(2024, 3, 10, 10)),
        (Field("b", "boolean"), "On", True),
        (Field("b", "boolean"), "0", False),
        (Field("b", "boolean"), 1, True),
        (Field("b", "boolean"), 0.0, False),
        (Field("b", "boolean"), True, True),
        (Field("n", "integer"), "12", 12),
        (Field("n", "integer"), 12.0, 12),
        (Field("n", "integer"), None, None),
        (Field("n", "float", required=True), " 1.5 ", 1.5),
        (Field("n", "number"), 3, 3.0),
        (Field("a", "array", array_type="string"), ["Red", " B "], ["red", " b "]),
        (Field("a", "array", array_type="integer"), [1, 2.0], [1, 2]),
        (Field("a", "array", array_type="float"), [1, 2.5], [1.0, 2.5]),
        (Field("a", "array", array_type="boolean"), [True, False], [True, False]),
        (Field("a", "array", array_type="string"), [], []),
        (Field("a", "array", array_type="string"), None, None),
    ],
)
def test_values_taken(spark, field, value, want):
    assert one(spark, field, value) == (want, None)


@pytest.mark.parametrize(
    "field, value",
    [
        (Field("s", "string"), 5),
        (Field("s", "string", required=True), "  "),
        (Field("s", "string", required=True), None),
        (Field("s", "string", max_length=3), "  abcd "),
        (Field("d", "datetime"), None),
        (Field("d", "datetime"), ""),
        (Field("d", "datetime"), "soon"),
        (Field("d", "datetime"), 20240101),
        (Field("b", "boolean"), None),
        (Field("b", "boolean"), ""),
        (Field("b", "boolean"), []),
        (Field("b", "boolean"), "yes"),
        (Field("b", "boolean"), 2),
        (Field("n", "integer"), 1.5),
        (Field("n", "integer", required=True), None),
        (Field("n", "float", required=True), " "),
        (Field("n", "float"), "many"),
        (Field("n", "float"), [1]),
        (Field("a", "array", array_type="string"), "x"),
        (Field("a", "array", array_type="string"), ["x", 1]),
        (Field("a", "array", array_type="integer"), [1.5]),
        (Field("a", "array", array_type="string", required=True), []),
        (Field("a", "array", array_type="string", max_length=1), ["x", "y"]),
    ],
)
def test_values_refused(spark, field, value):
    assert one(spark, field, value)[1] is not None


def test_whole_objects(spark):
    fields = [Field("title", "string", required=True), Field("when", "datetime"), Field("odd name's", "integer")]
    got = check(spark, fields, {"title": "A"}, {"title": "A", "other": 1, "more": 2}, {}, [1], "not json", {"title": "x", "odd name's": 4})
    assert [r.valid for r in got] == [True, False, False, False, False, True]
    assert got[1].errors == ["more: unknown field", "other: unknown field"]
    assert got[2].errors == ["title: is required"]
    assert got[3].errors == ["metadata must be an object"] and got[4].errors == got[3].errors
    assert got[5].normalised["odd name's"] == 4 and got[0].normalised["when"] is None


def test_no_schema(spark):
    assert [r.valid for r in check(spark, [], {"any": 1}, [1], "oops")] == [True, False, False]


GOOD = [Field("title", "string", max_length=10), Field("tags", "array", array_type="string", max_length=5)]


def test_schema_definitions(spark):
    bad = {
        "blank": [Field(" ", "string")],
        "kind": [Field("a", "decimal")],
        "bare array": [Field("a", "array")],
        "not array": [Field("a", "string", array_type="string")],
        "element": [Field("a", "array", array_type="datetime")],
        "length": [Field("a", "string", max_length=0)],
        "length kind": [Field("a", "integer", max_length=3)],
        "twice": [Field("a", "string"), Field("a ", "float")],
    }
    errors = schema_errors(registry_frame(spark, {"good": GOOD, "case": [Field("a", "string"), Field("A", "string")], **bad}))
    assert {r.collection for r in errors.collect()} == set(bad)
    for fields in bad.values():
        with pytest.raises(ValueError):
            check_fields(fields)
    assert check_fields(GOOD) == GOOD
    assert [f.name for f in with_filename(GOOD)] == ["title", "tags", "filename"]
    assert with_filename(with_filename(GOOD)) == with_filename(GOOD)


def test_times(spark):
    texts = ["2024-01-05", "'2024-01-05'", "10:30", "2024", "2024-13-40", "5 January 2024"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_time(F.col("t"))).collect()]
    assert got == [datetime(2024, 1, 5), datetime(2024, 1, 5), None, datetime(2024, 1, 1), None, datetime(2024, 1, 5)]
    assert literal_time("2024-01-05T02:00:00+02:00") == datetime(2024, 1, 5)
    assert not is_date_only("Jan 5, 2024 10 PM") and not is_date_only("20240105 1030") and is_date_only("Tuesday, 5 Mar 2024")
    assert is_date_only("October 5, 2024") and is_date_only("2024-10-05") and not is_date_only("2024-10-05T00:00:00Z")
    with pytest.raises(ValueError):
        literal_time("soon")


@pytest.mark.parametrize("text, want", [
    ("Jan 15 2024", "2024-01-15 00:00:00"), ("15-Jan-2024", "2024-01-15 00:00:00"), ("20240115", "2024-01-15 00:00:00"),
    ("2024-01-15 10:30 PM", "2024-01-15 22:30:00"), ("january 5, 2024 3:04 pm", "2024-01-05 15:04:00"), ("5 MAY 2024", "2024-05-05 00:00:00"),
    ("2024/1/5 7:08", "2024-01-05 07:08:00"), ("Sep 9, 2023", "2023-09-09 00:00:00"), ("1/15/2024 11:00 am", "2024-01-15 11:00:00"), ("2024-01-15", "2024-01-15 00:00:00"),
    ("Monday, January 15, 2024", "2024-01-15 00:00:00"), ("Jan 15, 2024 10:30:15 PM", "2024-01-15 22:30:15"), ("2024/01/15 10:30:00 AM", "2024-01-15 10:30:00"),
    ("15 Jan 2024 10:30:00 GMT", "2024-01-15 10:30:00"), ("Mon, 15 Jan 2024 10:30:00 GMT", "2024-01-15 10:30:00"), ("Mon Jan 15 10:30:00 2024", "2024-01-15 10:30:00"),
    ("2024.01.15", "2024-01-15 00:00:00"), ("15.01.2024", "2024-01-15 00:00:00"), ("1/15/24", "2024-01-15 00:00:00"), ("Sept 5 2024", "2024-09-05 00:00:00"),
    ("10:30 Jan 15 2024", "2024-01-15 10:30:00"), ("20240115T103000", "2024-01-15 10:30:00"), ("January 2024", "2024-01-01 00:00:00"), ("2024", "2024-01-01 00:00:00"),
    # zones, clocks and compact forms
    ("2024/01/15 10:30 +02:00", "2024-01-15 08:30:00"), ("2024/01/15T10:30-05", "2024-01-15 15:30:00"), ("15 Jan 2024 10:30:15.75Z", "2024-01-15 10:30:15"),
    ("15th of January 2024 at 3pm", "2024-01-15 15:00:00"), ("12 am Jan 1 2024", "2024-01-01 00:00:00"), ("12:15 a.m. Jan 1 2024", "2024-01-01 00:15:00"), ("202401151030", "2024-01-15 10:30:00"),
    # ambiguous ones, as the module says
    ("3/4/2024", "2024-03-04 00:00:00"), ("3.4.2024", "2024-03-04 00:00:00"), ("15/01/2024", "2024-01-15 00:00:00"), ("2024-13-01", "2024-01-13 00:00:00"),
    ("Jan 15 74", "2074-01-15 00:00:00"), ("15 Jan 75", "1975-01-15 00:00:00"), ("01/2024", "2024-01-01 00:00:00"),
    ("Janember 5 2024", None), ("Mayor 2024", None), ("20241315", None), ("soon", None), ("Jan 5", None), ("10:30", None), ("2/30/2024", None), ("1/2/3", None),
    ("14:30 pm 1/1/2024", None), ("1/15/2024 25:00", None), ("12345", None), ("15 Jan 2024 10:30 EST", None), ("...", None),
])
def test_spellings_of_times(spark, text, want):
    from docketry.functions.times import literal_time, parse_time

    got = spark.createDataFrame([(text,)], "t string").select(F.date_format(parse_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("t")).first().t
    assert got == want
    if want is None:
        with pytest.raises(ValueError, match="not a date"):
            literal_time(text)
    else:
        assert str(literal_time(text)) == want
