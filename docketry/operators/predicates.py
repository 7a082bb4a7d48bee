"""Metadata filters: a nested spec, checked against a schema, becomes one Column.

A spec is a dict. A leaf is {"op", "field", "value"}; {"and": [...]}, {"or": [...]}
and {"not": spec} combine leaves. A leaf over an absent value is false, and its
negation true. Outside a `not`, Spark's own null handling drops the same rows, so
the bare comparison is used there and reaches the Parquet scan.
"""

from __future__ import annotations

import math
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.times import day_bounds, is_date_only, literal_time
from docketry.operators.metadata import ARRAY_TYPES, FIELD_TYPES, MAX_ARRAY_LENGTH, NUMERIC_TYPES, Field


class FilterError(ValueError):
    """The filter does not fit the schema."""


# Which operators each field type takes.
EQUALITY = ("==", "=", "!=")
ORDER = (">", ">=", "<", "<=")
MEMBERSHIP = ("in", "not in")
TYPE_OPERATORS = {
    "string": (*EQUALITY, "like", *MEMBERSHIP),
    "datetime": (*EQUALITY, *ORDER, "between", "before", "after"),
    "number": (*EQUALITY, *ORDER, "between", *MEMBERSHIP),
    "integer": (*EQUALITY, *ORDER, "between", *MEMBERSHIP),
    "float": (*EQUALITY, *ORDER, "between", *MEMBERSHIP),
    "boolean": EQUALITY,
    "array": (
        *EQUALITY, *MEMBERSHIP, "includes", "does not include", "array_contains",
        "array_contains_all", "array_contains_any", "array_length", "has", "has not",
    ),
}
COMPARE = {
    "==": operator.eq, "=": operator.eq, "!=": operator.ne, ">": operator.gt,
    ">=": operator.ge, "<": operator.lt, "<=": operator.le,
}
#: In a pattern a backslash only stands before %, _ or another backslash.
LIKE_PATTERN = re.compile(r"(?:[^\\]|\\[\\%_])*", re.DOTALL)
LIST_ONLY = ("in", "not in", "array_contains_all", "array_contains_any")
LIST_OR_SCALAR = ("includes", "does not include")


# ---------------------------------------------------------------- checking


def check_filter(spec: dict, fields: list[Field]) -> None:
    """Raise FilterError unless every leaf fits the schema. Runs on the driver only."""
    by_name = {f.name: f for f in fields}
    for leaf in _leaves(spec):
        _check_leaf(leaf, by_name)


def _leaves(spec):
    if not isinstance(spec, dict):
        raise FilterError(f"not a filter: {spec!r}")
    for word in ("and", "or"):
        if word in spec:
            if len(spec) != 1 or not spec[word]:
                raise FilterError(f"'{word}' takes a non-empty list of filters")
            for part in spec[word]:
                yield from _leaves(part)
            return
    if "not" in spec:
        yield from _leaves(spec["not"])
        return
    yield spec


def _check_leaf(leaf: dict, by_name: dict[str, Field]) -> None:
    op, name = str(leaf.get("op", "")).lower(), leaf.get("field")
    if op in ("is null", "is not null"):
        raise FilterError("null tests are not supported")
    if name not in by_name:
        raise FilterError(f"field {name!r} is not in the schema: {', '.join(sorted(by_name))}")
    field = by_name[name]
    if op not in TYPE_OPERATORS[field.type]:
        raise FilterError(f"operator {op!r} does not apply to {field.type} field {name!r}")
    value = leaf.get("value")
    if op == "between":
        _check_range(field, value)
    elif op == "array_length":
        _check_length(field, leaf.get("cmp", "=="), value)
    elif op in LIST_ONLY or (field.type == "array" and (op in EQUALITY or isinstance(value, list))):
        if op not in LIST_ONLY and op not in LIST_OR_SCALAR and op not in EQUALITY:
            raise FilterError(f"{op!r} takes one value, not a list")
        _check_list(field, value)
    elif field.type == "array":
        _check_scalar(field.name, field.array_type, value)
    elif op == "like":
        if not isinstance(value, str) or value == "":
            raise FilterError("'like' takes a pattern")
        if not LIKE_PATTERN.fullmatch(value):
            raise FilterError(f"{name}: in {value!r} a backslash stands before neither %, _ nor a backslash")
    else:
        _check_scalar(field.name, field.type, value)


def _check_scalar(name: str, kind: str, value) -> None:
    if value is None or (isinstance(value, str) and value.strip() == ""):
        raise FilterError(f"{name}: null and blank values are not supported")
    if isinstance(value, list):
        raise FilterError(f"{name}: one value is needed, not a list")
    is_number = isinstance(value, int | float) and not isinstance(value, bool)
    if kind == "boolean" and not isinstance(value, bool):
        raise FilterError(f"{name}: {value!r} is not true or false")
    if kind == "string" and not isinstance(value, str):
        raise FilterError(f"{name}: {value!r} is not a string")
    if kind in NUMERIC_TYPES and not is_number:
        raise FilterError(f"{name}: {value!r} is not a number")
    if is_number and not math.isfinite(value):
        raise FilterError(f"{name}: {value!r} is not a finite number")
    if kind == "integer" and value != int(value):
        raise FilterError(f"{name}: {value!r} is not a whole number")
    if kind == "datetime":
        _moment(name, value)


def _moment(name: str, value):
    try:
        return literal_time(value)
    except (TypeError, ValueError) as error:
        raise FilterError(f"{name}: {value!r} is not a date or time") from error


def _check_range(field: Field, value) -> None:
    if not isinstance(value, list | tuple) or len(value) != 2:
        raise FilterError("'between' takes a start and an end")
    for bound in value:
        _check_scalar(field.name, field.type, bound)
    start, end = value
    if field.type == "datetime":
        start, end = _moment(field.name, start), _moment(field.name, end)
    if start > end:
        raise FilterError(f"{field.name}: the range ends before it starts")


def _check_length(field: Field, cmp: str, value) -> None:
    if cmp not in COMPARE:
        raise FilterError(f"{cmp!r} is not a comparison")
    if isinstance(value, bool) or not isinstance(value, int) or value < 0:
        raise FilterError("array_length is compared with a whole number from 0")
    if value > (field.max_length or MAX_ARRAY_LENGTH):
        raise FilterError(f"{field.name}: no array is that long")
    if value == 0 and cmp in EQUALITY:
        raise FilterError("tests for an empty array are not supported")


def _check_list(field: Field, value) -> None:
    if not isinstance(value, list) or not value:
        raise FilterError(f"{field.name}: a non-empty list is needed")
    kind = field.array_type if field.type == "array" else field.type
    if len(value) > (field.max_length if field.type == "array" and field.max_length else MAX_ARRAY_LENGTH):
        raise FilterError(f"{field.name}: the list is too long")
    for item in value:
        _check_scalar(field.name, kind, item)


# ---------------------------------------------------------------- compiling


def compile_filter(df: DataFrame, spec: dict, fields: list[Field], prefix: str = "") -> Column:
    """The checked spec as a Column over df; fields are found under `prefix`."""
    check_filter(spec, fields)
    return _build(df, spec, {f.name: f for f in fields}, prefix, negated=False)


def _build(df, spec, by_name, prefix, negated) -> Column:
    for word, join in (("and", operator.and_), ("or", operator.or_)):
        if word in spec:
            parts = [_build(df, s, by_name, prefix, negated) for s in spec[word]]
            out = parts[0]
            for part in parts[1:]:
                out = join(out, part)
            return out
    if "not" in spec:
        return ~_build(df, spec["not"], by_name, prefix, negated=True)
    field = by_name[spec["field"]]
    path = f"{prefix}.`{field.name}`" if prefix else f"`{field.name}`"
    leaf = _leaf(df, path, field, spec)
    return F.coalesce(leaf, F.lit(False)) if negated else leaf


def _leaf(df: DataFrame, path: str, field: Field, leaf: dict) -> Column:
    op, value, col = leaf["op"].lower(), leaf.get("value"), F.col(path)
    if field.type == "datetime":
        return _datetime_leaf(df, path, op, value)
    if field.type == "array":
        return _array_leaf(df, path, op, value, leaf.get("cmp", "=="))
    if op == "like":
        return col.like(value)
    if op == "between":
        return col.between(*value)
    if op in MEMBERSHIP:
        hit = col.isin([v.lower() if isinstance(v, str) else v for v in value])
        return hit if op == "in" else ~hit
    return COMPARE[op](col, value.lower() if isinstance(value, str) else value)


def _datetime_leaf(df: DataFrame, path: str, op: str, value) -> Column:
    col = F.col(path)
    kind = df.select(path).schema[0].dataType
    zone = "" if kind.simpleString() == "timestamp_ntz" else "Z"

    def at(moment):
        return F.lit(moment.isoformat(sep=" ") + zone).cast(kind)

    if op == "between":
        return col.between(at(literal_time(value[0])), at(literal_time(value[1])))
    op = {"before": "<", "after": ">"}.get(op, op)
    moment = literal_time(value)
    if is_date_only(value):
        start, end = day_bounds(moment)
        if op in ("==", "="):
            return col.between(at(start), at(end))
        moment = end if op in (">", "<=") else start
    return COMPARE[op](col, at(moment))


def _array_leaf(df: DataFrame, path: str, op: str, value, cmp: str) -> Column:
    col = F.col(path)
    if op == "array_length":
        return COMPARE[cmp](F.size(F.when(col.isNotNull(), col)), value) & col.isNotNull()
    kind = df.select(path).schema[0].dataType

    def lowered(v):
        return v.lower() if isinstance(v, str) else v

    if isinstance(value, list):
        # membership and equality literals are lower-cased, those of the array functions are not
        keep = op.startswith("array_contains")
        listed = F.array(*[F.lit(v if keep else lowered(v)) for v in value]).cast(kind)
        contains_all = col.isNotNull() & (F.size(F.array_except(listed, col)) == 0)
        if op in EQUALITY:
            return COMPARE[op](col, listed)
        if op in ("includes", "array_contains_all"):
            return contains_all
        overlap = F.arrays_overlap(col, listed)
        return ~overlap if op in ("not in", "does not include") else overlap
    item = F.lit(lowered(value) if op in LIST_OR_SCALAR else value).cast(kind.elementType)
    hit = F.array_contains(col, item)
    return ~hit if op in ("does not include", "has not") else hit


# ---------------------------------------------------------------- using


def filter_chunks(df: DataFrame, spec, fields: list[Field], prefix: str = "content_metadata",
                  generated: bool = False) -> DataFrame:
    """Rows that pass. No spec or no schema changes nothing; a generated spec that fails is dropped."""
    if not spec or not fields:
        return df
    try:
        return df.where(compile_filter(df, spec, fields, prefix))
    except FilterError:
        if generated:
            return df
        raise


def accepting_collections(spec, schemas: dict[str, list[Field]], strict: bool = True) -> list[str]:
    """Collections that can take the filter, in the order given.

    Strict: one that cannot is an error. Otherwise those are left out, and it is
    an error if none is left.
    """
    if not spec:
        return list(schemas)
    kept, faults = [], []
    for name, fields in schemas.items():
        try:
            if fields:
                check_filter(spec, fields)
            kept.append(name)
        except FilterError as error:
            faults.append(f"{name}: {error}")
    if faults and (strict or not kept):
        raise FilterError("; ".join(faults))
    return kept


def leaf_needs(spec) -> list[tuple[int, str, str, str | None, int]]:
    """What a schema has to have for the filter, as (leaf, field, type, element type, least length).

    A leaf can be taken by several types of its field; then it has a row for each. `least length` is the
    length of array that the field must allow. A filter of the wrong form is an error, a leaf that
    no field could take has no row."""
    out = []
    for number, leaf in enumerate(_leaves(spec)):
        name = leaf.get("field")
        value, long = leaf.get("value"), 0
        if isinstance(value, list) or str(leaf.get("op", "")).lower() == "array_length":
            long = len(value) if isinstance(value, list) else value if isinstance(value, int) else 0
        for kind in FIELD_TYPES:
            for element in ARRAY_TYPES if kind == "array" else (None,):
                try:
                    _check_leaf(leaf, {name: Field(name, kind, array_type=element)})
                except FilterError:
                    continue
                out.append((number, name, kind, element, long if kind == "array" else 0))
    return out


def covering_collections(spec, registry: DataFrame) -> DataFrame:
    """(collection) of the registry's collections that can take the filter, however many there are.

    The same as `accepting_collections` without `strict`, as one join: the filter's needs, a handful of
    rows, meet the registry's fields, and a collection in which every leaf is met is kept. A
    collection without fields takes any filter; without a filter all are kept. No error is raised if
    none is left. The registry has a row per collection, as `registry_frame` gives it."""
    if not spec:
        return registry.select("collection")
    needs, leaves = leaf_needs(spec), sum(1 for _ in _leaves(spec))
    wanted = registry.sparkSession.createDataFrame(needs, "leaf int, name string, type string, array_type string, least int")
    fields = registry.select("collection", F.explode("fields").alias("f")).select("collection", "f.name", "f.type", "f.array_type", "f.max_length")
    allowed = F.coalesce(F.when(F.col("max_length") > 0, F.col("max_length")), F.lit(MAX_ARRAY_LENGTH))
    met = (
        fields.alias("f").join(F.broadcast(wanted.alias("w")), (F.col("f.name") == F.col("w.name")) & (F.col("f.type") == F.col("w.type")) & F.col("f.array_type").eqNullSafe(F.col("w.array_type")) & (allowed >= F.col("least")))
        .groupBy("collection").agg(F.count_distinct("leaf").alias("met")).where(F.col("met") == leaves).select("collection")
    )
    free = registry.where(F.coalesce(F.size("fields"), F.lit(0)) <= 0).select("collection")
    return met.unionByName(free)


def from_conditions(conditions: list[dict]) -> dict | None:
    """A list of term / range / terms / wildcard conditions, all of which must hold."""
    parts = []
    for condition in conditions:
        ((kind, body),) = condition.items()
        ((name, value),) = body.items()
        if kind == "term":
            parts.append({"op": "==", "field": name, "value": value})
        elif kind == "terms":
            parts.append({"op": "in", "field": name, "value": value})
        elif kind == "wildcard":
            pattern = value["value"] if isinstance(value, dict) else value
            escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
            parts.append(
                {"op": "like", "field": name, "value": escaped.replace("*", "%").replace("?", "_")}
            )
        elif kind == "range":
            signs = {"gt": ">", "gte": ">=", "lt": "<", "lte": "<="}
            parts.extend({"op": signs[k], "field": name, "value": v} for k, v in value.items())
        else:
            raise FilterError(f"condition {kind!r} is not supported")
    return {"and": parts} if parts else None
