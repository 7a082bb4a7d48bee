"""Metadata schemas and the checking of metadata values against them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.rows import bind, exploded
from docketry.functions.text import trim_all
from docketry.functions.times import parse_time

# Field types, element types and default limits.
FIELD_TYPES = ("string", "datetime", "number", "integer", "float", "boolean", "array")
ARRAY_TYPES = ("string", "number", "integer", "float", "boolean")
NUMERIC_TYPES = ("number", "integer", "float")
MAX_STRING_LENGTH = 65_535
MAX_ARRAY_LENGTH = 1_000
TRUE_WORDS = ("true", "1", "on")
FALSE_WORDS = ("false", "0", "off")
# Column type of each field type.
SQL_TYPES = {
    "string": "string",
    "datetime": "timestamp",
    "number": "double",
    "integer": "bigint",
    "float": "double",
    "boolean": "boolean",
}
REGISTRY_TYPE = (
    "collection string, fields array<struct<name:string,type:string,required:boolean,"
    "array_type:string,max_length:int,description:string>>"
)


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    array_type: str | None = None
    max_length: int | None = None
    description: str | None = None

    @property
    def sql_type(self) -> str:
        if self.type == "array":
            return f"array<{SQL_TYPES[self.array_type or 'string']}>"
        return SQL_TYPES[self.type]


def with_filename(fields: list[Field]) -> list[Field]:
    """Every collection has a `filename` field."""
    if any(f.name == "filename" for f in fields):
        return list(fields)
    return [*fields, Field("filename", "string")]


def registry_frame(spark: SparkSession, schemas: dict[str, list[Field]]) -> DataFrame:
    rows = [
        (name, [(f.name, f.type, f.required, f.array_type, f.max_length, f.description) for f in fields])
        for name, fields in schemas.items()
    ]
    return spark.createDataFrame(rows, REGISTRY_TYPE)


def schema_errors(registry: DataFrame) -> DataFrame:
    """One row per fault in a registry's field definitions: collection, field, error."""
    flat = registry.select("collection", F.explode("fields").alias("f")).select("collection", "f.*")
    flat = flat.withColumn("name", trim_all(F.coalesce("name", F.lit(""))))
    is_array = F.col("type") == "array"
    checks = F.array(
        F.when(F.col("name") == "", "name is blank"),
        F.when(~F.coalesce(F.col("type").isin(*FIELD_TYPES), F.lit(False)), "type is not known"),
        F.when(is_array & F.col("array_type").isNull(), "array needs an element type"),
        F.when(~is_array & F.col("array_type").isNotNull(), "only an array has an element type"),
        F.when(~F.col("array_type").isin(*ARRAY_TYPES), "element type is not allowed"),
        F.when(F.col("max_length") <= 0, "max length must be positive"),
        F.when(
            F.col("max_length").isNotNull() & ~F.col("type").isin("string", "array"),
            "only strings and arrays have a max length",
        ),
    )
    faults = flat.select(
        "collection",
        F.col("name").alias("field"),
        F.explode(F.filter(checks, lambda e: e.isNotNull())).alias("error"),
    )
    twice = (
        flat.groupBy("collection", F.col("name").alias("field"))
        .count()
        .where("count > 1")
        .select("collection", "field", F.lit("name is used twice").alias("error"))
    )
    return faults.unionByName(twice)


def check_fields(fields: list[Field]) -> list[Field]:
    """Driver-side form of the same rules, for one schema given by hand."""
    names = [f.name.strip() for f in fields]
    if "" in names:
        raise ValueError("a field name is blank")
    if len(set(names)) != len(names):
        raise ValueError("a field name is used twice")
    for f in fields:
        if f.type not in FIELD_TYPES:
            raise ValueError(f"{f.name}: type {f.type} is not known")
        if (f.type == "array") != (f.array_type is not None):
            raise ValueError(f"{f.name}: an element type goes with an array, and only there")
        if f.array_type is not None and f.array_type not in ARRAY_TYPES:
            raise ValueError(f"{f.name}: element type {f.array_type} is not allowed")
        if f.max_length is not None and (f.max_length <= 0 or f.type not in ("string", "array")):
            raise ValueError(f"{f.name}: max length does not apply")
    return fields


def _say(field: Field, reason: str) -> Column:
    return F.lit(f"{field.name}: {reason}")


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _string(field: Field, value: Column, kind: Column) -> tuple[Column, Column]:
    cleaned = F.nullif(F.lower(trim_all(_text(value))), F.lit(""))
    limit = field.max_length or MAX_STRING_LENGTH
    error = F.when(~kind.isin("VOID", "STRING"), _say(field, "must be a string")).when(
        F.length(cleaned) > limit, _say(field, f"longer than {limit}")
    )
    if field.required:
        error = F.coalesce(error, F.when(cleaned.isNull(), _say(field, "must not be blank")))
    return cleaned, error


def _datetime(field: Field, value: Column, kind: Column) -> tuple[Column, Column]:
    moment = F.when(kind == "STRING", parse_time(_text(value)))
    blank = (kind == "VOID") | ((kind == "STRING") & (_text(value) == ""))
    error = F.when(blank, _say(field, "must not be null or blank")).when(
        moment.isNull(), _say(field, "not a date or time")
    )
    return moment, error


def _boolean(field: Field, value: Column, kind: Column) -> tuple[Column, Column]:
    word = F.lower(_text(value))
    number = F.try_variant_get(value, "$", "double")
    is_text = kind.isin("STRING", "BOOLEAN")
    flag = F.when(
        is_text, F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    ).when(
        ~is_text & ~kind.startswith("ARRAY") & ~kind.startswith("OBJECT"),
        F.when(number == 1, True).when(number == 0, False),
    )
    return flag, F.when(flag.isNull(), _say(field, "not a true or false value"))


def _array(field: Field, value: Column, kind: Column) -> tuple[Column, Column]:
    items = F.try_variant_get(value, "$", "array<variant>")
    limit = field.max_length or MAX_ARRAY_LENGTH
    item_type = SQL_TYPES[field.array_type or "string"]
    if field.array_type == "string":
        typed = F.transform(
            items, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.lower(_text(v)))
        )
    elif field.array_type == "integer":
        typed = F.transform(items, lambda v: _whole(F.try_variant_get(v, "$", "double")))
    else:
        typed = F.transform(items, lambda v: F.try_variant_get(v, "$", item_type))
    error = (
        F.when((kind != "VOID") & ~kind.startswith("ARRAY"), _say(field, "must be a list"))
        .when(F.exists(typed, lambda x: x.isNull()), _say(field, f"elements must be {field.array_type}"))
        .when(F.size(items) > limit, _say(field, f"more than {limit} elements"))
    )
    if field.required:
        empty = (kind == "VOID") | (F.size(items) == 0)
        error = F.coalesce(error, F.when(empty, _say(field, "must not be empty")))
    return typed, error


def _whole(number: Column) -> Column:
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def _number(field: Field, value: Column, kind: Column) -> tuple[Column, Column]:
    number = F.when(
        ~kind.startswith("ARRAY") & ~kind.startswith("OBJECT") & (kind != "BOOLEAN"),
        trim_all(_text(value)).try_cast("double"),
    ).when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double"))
    typed = _whole(number) if field.type == "integer" else number
    if field.required:
        error = F.when(typed.isNull(), _say(field, f"not a valid {field.type}"))
    else:
        error = F.when(typed.isNull() & (kind != "VOID"), _say(field, f"not a valid {field.type}"))
    return typed, error


_RULES = {
    "string": _string,
    "datetime": _datetime,
    "boolean": _boolean,
    "array": _array,
    "number": _number,
    "integer": _number,
    "float": _number,
}


def _field_result(field: Field, entries: Column) -> Column:
    """struct<typed,error> of one field, both null where the field is not given."""

    def judge(value: Column) -> Column:
        def with_kind(kind: Column) -> Column:
            typed, error = _RULES[field.type](field, value, kind)
            return F.struct(typed.cast(field.sql_type).alias("typed"), error.alias("error"))

        return bind(F.schema_of_variant(value), with_kind)

    given = F.try_element_at(entries, F.lit(field.name))
    return bind(given, lambda value: F.when(value.isNotNull(), judge(value)))


def validate_metadata(items: DataFrame, fields: list[Field], raw: str = "metadata") -> DataFrame:
    """Check one JSON object per row: adds `valid`, `errors` and the typed struct `normalised`.

    All checks are column expressions; a row with errors has a null struct.
    With no fields the only rule is that the value is an object.
    """
    entries = "raw_entries"
    out = items.withColumn(
        entries, F.try_variant_get(F.try_parse_json(F.col(raw)), "$", "map<string,variant>")
    )
    is_object = F.col(entries).isNotNull()
    not_object = F.when(~is_object, F.lit("metadata must be an object"))
    if not fields:
        out = out.withColumn("errors", F.array_compact(F.array(not_object)))
        return out.withColumn("valid", F.size("errors") == 0).drop(entries)

    check_fields(fields)
    errors, values = [not_object], []
    results = F.struct(*[_field_result(field, F.col(entries)).alias(f"f{i}") for i, field in enumerate(fields)])
    out = out.withColumn("results", results)
    given = F.when(is_object, F.map_keys(entries))
    for i, field in enumerate(fields):
        error = F.col(f"results.f{i}.error")
        if field.required:
            missing = F.when(~F.array_contains(given, field.name), _say(field, "is required"))
            error = F.coalesce(missing, error)
        errors.append(error)
        values.append(F.col(f"results.f{i}.typed").alias(field.name))
    known = F.array(*[F.lit(f.name) for f in fields])
    unknown = F.transform(
        F.array_sort(F.array_except(F.map_keys(entries), known)),
        lambda name: F.concat(name, F.lit(": unknown field")),
    )
    every = F.concat(
        F.array_compact(F.array(*errors)), F.coalesce(unknown, F.array().cast("array<string>"))
    )
    # as a row of its own the result is computed once; a filter on `valid` would otherwise be
    # pushed below and repeat every check
    checked = F.array(F.struct(every.alias("errors"), F.struct(*values).alias("typed")))
    out = exploded(out.withColumn("checks", checked).drop(entries, "results"), "checks", "checked").drop("checks")
    valid = F.size("checked.errors") == 0
    return out.select(
        *items.columns,
        F.col("checked.errors").alias("errors"),
        valid.alias("valid"),
        F.when(valid, F.col("checked.typed")).alias("normalised"),
    )
