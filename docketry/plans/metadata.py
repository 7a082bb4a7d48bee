"""Metadata values and filters over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.functions.times import parse_time
from docketry.operators.metadata import Field, validate_metadata
from docketry.operators.predicates import accepting_collections, covering_collections, filter_chunks, from_conditions
from docketry.plans.registry import query, stamp, table
from docketry.session import spread

PART_FIELDS = [
    Field("title", "string", required=True, max_length=14),
    Field("size", "integer", required=True),
    Field("price", "float"),
    Field("flag", "boolean"),
    Field("words", "array", array_type="string", max_length=10),
    Field("seen", "datetime"),
]


def _part_items(spark, sf):
    """Metadata objects whose faults follow the part's own values."""
    size = F.col("p_size").cast("string")
    seen = (
        F.when(F.col("p_type") == "ECONOMY", "March 5, 2024 2:30 PM")
        .when(F.col("p_type") == "PROMO", "2024/03/05 14:30")
        .when(F.col("p_type") == "STANDARD", "2024-03-05T14:30:00Z")
        .when(F.col("p_type") == "SMALL", "03/05/2024")
        .otherwise("not a date")
    )
    body = F.concat(
        F.lit('{"title": "  '), F.upper("p_name"), F.lit('  "'),
        F.when(F.col("p_size") > 3, F.concat(F.lit(', "size": '), F.when(F.col("p_size") > 47, F.concat(size, F.lit(".5"))).otherwise(size))).otherwise(""),
        F.lit(', "price": "'), F.col("p_size").cast("string"), F.lit('.25"'),
        F.lit(', "flag": "'), F.when(F.col("p_size") > 25, "ON").otherwise("false"), F.lit('"'),
        F.lit(', "words": ["'), F.replace(F.initcap("p_name"), F.lit(" "), F.lit('", "')), F.lit('"]'),
        F.lit(', "seen": "'), seen, F.lit('"'),
        F.when(F.col("p_size") == 10, ', "extra": 1').otherwise(""),
        F.lit("}"),
    )
    return spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size")).withColumn("metadata", body)


BAD = """
  (length(p_name) > 14) as long_title, (p_size <= 3) as no_size, (p_size > 47) as odd_size,
  (p_type not in ('ECONOMY', 'PROMO', 'STANDARD', 'SMALL')) as odd_date, (p_size = 10) as extra
"""


@query(f"""
with p as (select p_partkey, {BAD} from part)
select p_partkey, not (long_title or no_size or odd_size or odd_date or extra) as valid,
  concat_ws('; ', case when long_title then 'title: longer than 14' end,
    case when no_size then 'size: is required' end, case when odd_size then 'size: not a valid integer' end,
    case when odd_date then 'seen: not a date or time' end, case when extra then 'extra: unknown field' end) as errors
from p
""")
def metadata_checked(spark, sf):
    return validate_metadata(_part_items(spark, sf), PART_FIELDS).select(
        "p_partkey", "valid", F.array_join("errors", "; ").alias("errors")
    )


@query(f"""
with p as (select *, {BAD} from part)
select p_partkey, lower(p_name) as title, p_size::bigint as size, p_size + 0.25::double as price, p_size > 25 as flag,
  replace(lower(p_name), ' ', '|') as words,
  case when p_type = 'SMALL' then '2024-03-05 00:00:00' else '2024-03-05 14:30:00' end as seen
from p where not (long_title or no_size or odd_size or odd_date or extra)
""")
def metadata_normalised(spark, sf):
    return (
        validate_metadata(_part_items(spark, sf), PART_FIELDS)
        .where("valid")
        .select("p_partkey", "normalised.*")
        .withColumn("words", F.array_join("words", "|"))
        .withColumn("seen", stamp("seen"))
    )


@query("""
select event_id, true as valid, json_extract(props, '$.k')::bigint as k from events
""")
def metadata_event_props(spark, sf):
    checked = validate_metadata(
        table(spark, sf, "events").select("event_id", "props"), [Field("k", "integer", required=True)], raw="props"
    )
    return checked.select("event_id", "valid", F.col("normalised.k").alias("k"))


@query("select event_id, event_type <> 'error' as valid from events")
def metadata_without_schema(spark, sf):
    raw = F.when(F.col("event_type") == "error", F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    items = table(spark, sf, "events").select("event_id", raw.alias("metadata"))
    return validate_metadata(items, []).select("event_id", "valid")


# ---------------------------------------------------------------- filters

PARTS = [
    Field("title", "string"),
    Field("brand", "string"),
    Field("size", "integer"),
    Field("price", "float"),
    Field("words", "array", array_type="string"),
    Field("big", "boolean"),
    Field("label", "string"),
]
EVENTS = [Field("kind", "string"), Field("value", "float"), Field("ts", "datetime"), Field("note", "string")]


def parts(spark, sf):
    """Parts as chunks; `label` and `words` are absent for some."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.struct(
            F.lower("p_name").alias("title"),
            F.lower("p_brand").alias("brand"),
            F.col("p_size").alias("size"),
            F.col("p_retailprice").alias("price"),
            F.when(F.col("p_size") > 5, F.split(F.lower("p_name"), " ")).alias("words"),
            (F.col("p_size") > 25).alias("big"),
            F.when(F.col("p_type") != "PROMO", F.lower("p_type")).alias("label"),
        ).alias("content_metadata"),
    )


def events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.struct(
            F.col("event_type").alias("kind"),
            "value",
            "ts",
            F.when(F.col("event_type") != "click", F.col("event_type")).alias("note"),
        ).alias("content_metadata"),
    )


SQL_PARTS = """
with p as (select p_partkey as id, lower(p_name) as title, lower(p_brand) as brand, p_size as size, p_retailprice as price,
  case when p_size > 5 then string_split(lower(p_name), ' ') end as words, p_size > 25 as big,
  case when p_type <> 'PROMO' then lower(p_type) end as label from part)
select id from p where """
SQL_EVENTS = """
with e as (select event_id as id, event_type as kind, value, ts, case when event_type <> 'click' then event_type end as note from events)
select id from e where """


def _filter(name: str, rows, fields, spec, sql: str) -> None:
    def run(spark, sf):
        return filter_chunks(rows(spark, sf), spec, fields).select("id")

    run.__name__ = name
    query(sql)(run)


def leaf(op, field, value=None, **more):
    return {"op": op, "field": field, "value": value, **more}


for _name, _spec, _where in [
    ("equal", leaf("==", "brand", "Brand#2"), "brand = 'brand#2'"),
    ("not_equal", leaf("!=", "label", "ECONOMY"), "coalesce(label <> 'economy', false)"),
    ("boolean", leaf("=", "big", True), "big"),
    ("number_order", {"and": [leaf(">", "size", 10), leaf("<=", "price", 950.5)]}, "size > 10 and price <= 950.5"),
    ("number_between", leaf("between", "price", [910, 920.5]), "price between 910 and 920.5"),
    ("like", leaf("like", "title", "%ring"), "title like '%ring'"),
    ("like_keeps_case", leaf("like", "title", "%Ring"), "title like '%Ring'"),
    ("in_list", leaf("in", "brand", ["Brand#1", "BRAND#3"]), "brand in ('brand#1', 'brand#3')"),
    ("not_in_list", leaf("not in", "size", [1, 2, 3]), "size not in (1, 2, 3)"),
    ("not_in_absent", leaf("not in", "label", ["small"]), "coalesce(label not in ('small'), false)"),
    ("array_overlap", leaf("in", "words", ["Red", "ring"]), "coalesce(list_has_any(words, ['red', 'ring']), false)"),
    ("array_no_overlap", leaf("not in", "words", ["red"]), "coalesce(not list_has_any(words, ['red']), false)"),
    ("array_equal", leaf("==", "words", ["red", "widget"]), "coalesce(words = ['red', 'widget'], false)"),
    ("includes_all", leaf("includes", "words", ["RED", "ring"]), "coalesce(list_has_all(words, ['red', 'ring']), false)"),
    ("includes_one", leaf("includes", "words", "Red"), "coalesce(list_contains(words, 'red'), false)"),
    ("includes_none", leaf("does not include", "words", ["red", "ring"]), "coalesce(not list_has_any(words, ['red', 'ring']), false)"),
    ("includes_not_one", leaf("does not include", "words", "red"), "coalesce(not list_contains(words, 'red'), false)"),
    ("array_contains", leaf("array_contains", "words", "red"), "coalesce(list_contains(words, 'red'), false)"),
    ("array_contains_all", leaf("array_contains_all", "words", ["small", "ring"]), "coalesce(list_has_all(words, ['small', 'ring']), false)"),
    ("array_contains_any", leaf("array_contains_any", "words", ["small", "Ring"]), "coalesce(list_has_any(words, ['small', 'Ring']), false)"),
    ("array_length", leaf("array_length", "words", 2, cmp="=="), "coalesce(len(words) = 2, false)"),
    ("value_in_array", leaf("has", "words", "widget"), "coalesce(list_contains(words, 'widget'), false)"),
    ("value_not_in_array", leaf("has not", "words", "widget"), "coalesce(not list_contains(words, 'widget'), false)"),
    ("not_of_absent", {"not": leaf("==", "label", "small")}, "not coalesce(label = 'small', false)"),
    (
        "nested",
        {"or": [{"and": [leaf(">=", "size", 40), {"not": leaf("has", "words", "red")}]}, {"not": {"or": [leaf("<", "size", 45), leaf("in", "label", ["small", "economy"])]}}]},
        "(size >= 40 and not coalesce(list_contains(words, 'red'), false)) or not (size < 45 or coalesce(label in ('small', 'economy'), false))",
    ),
    (
        "conditions",
        from_conditions([
            {"terms": {"brand": ["brand#1", "brand#2", "brand#3", "brand#4"]}},
            {"range": {"size": {"gte": 5, "lt": 40}}},
            {"wildcard": {"title": "*ring*"}},
            {"term": {"big": True}},
        ]),
        "brand in ('brand#1', 'brand#2', 'brand#3', 'brand#4') and size >= 5 and size < 40 and title like '%ring%' and big",
    ),
]:
    _filter(f"filter_{_name}", parts, PARTS, _spec, SQL_PARTS + _where)

for _name, _spec, _where in [
    ("day", leaf("==", "ts", "2024-01-05"), "ts between '2024-01-05 00:00:00' and '2024-01-05 23:59:59'"),
    ("day_from", leaf(">=", "ts", "2024-01-20"), "ts >= '2024-01-20 00:00:00'"),
    ("day_until", leaf("<=", "ts", "Jan 20, 2024"), "ts <= '2024-01-20 23:59:59'"),
    ("day_above", leaf(">", "ts", "2024-01-20"), "ts > '2024-01-20 23:59:59'"),
    ("day_below", leaf("<", "ts", "2024/01/20"), "ts < '2024-01-20 00:00:00'"),
    ("before_time", leaf("before", "ts", "2024-01-10T12:30:00Z"), "ts < '2024-01-10 12:30:00'"),
    ("after_time", leaf("after", "ts", "2024-01-10T14:30:00+02:00"), "ts > '2024-01-10 12:30:00'"),
    ("time_between", leaf("between", "ts", ["2024-01-10", "2024-01-12T06:00:00"]), "ts between '2024-01-10 00:00:00' and '2024-01-12 06:00:00'"),
    ("absent_note", {"not": leaf("in", "note", ["error", "view"])}, "not coalesce(note in ('error', 'view'), false)"),
]:
    _filter(f"filter_{_name}", events, EVENTS, _spec, SQL_EVENTS + _where)


@query("select 'parts' as collection, p_partkey as id from part where p_size > 30")
def filter_flexible_collections(spark, sf):
    """Of two collections only one knows the field, so only that one is searched."""
    spec = leaf(">", "size", 30)
    sets = {"events": (events, EVENTS), "parts": (parts, PARTS)}
    kept = accepting_collections(spec, {name: fields for name, (_, fields) in sets.items()}, strict=False)
    found = [
        filter_chunks(sets[name][0](spark, sf), spec, sets[name][1]).select(F.lit(name).alias("collection"), "id")
        for name in kept
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


@query("""
with c as (select p_partkey, p_size, p_brand in ('Brand#1', 'Brand#2') as marked from part)
select 'part-' || p_partkey as collection from c where p_size % 4 = 3 or (p_size % 4 in (1, 2) and (p_size > 20 or marked))
""")
def covering_schemas(spark, sf):
    """Which of many schemas, one per part, can take a filter: a number `size` that takes an order, and
    a list `tags` of texts that may have three or more."""
    size = F.when(F.col("p_size") % 4 == 0, "string").when(F.col("p_size") % 4 == 1, "integer").otherwise("float")
    most = F.when((F.col("p_size") <= 20) & ~F.col("p_brand").isin("Brand#1", "Brand#2"), 2)
    field = lambda name, kind, element, most: F.struct(F.lit(name).alias("name"), kind.alias("type"), F.lit(False).alias("required"), element.cast("string").alias("array_type"), most.cast("int").alias("max_length"), F.lit(None).cast("string").alias("description"))
    fields = F.array(field("size", size, F.lit(None), F.lit(None)), field("tags", F.lit("array"), F.lit("string"), most))
    none = F.filter(fields, lambda f: F.lit(False))
    registry = table(spark, sf, "part").select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("collection"), F.when(F.col("p_size") % 4 == 3, none).otherwise(fields).alias("fields"))
    spec = {"and": [leaf(">", "size", 30), {"not": leaf("includes", "tags", ["a", "b", "c"])}]}
    return covering_collections(spec, registry)


@query("select event_id as id from events")
def filter_generated_rejected(spark, sf):
    """A machine-written filter that does not fit the schema filters nothing."""
    return filter_chunks(events(spark, sf), leaf("==", "author", "x"), EVENTS, generated=True).select("id")


@query("select event_id as id from events")
def filter_generated_broken_pattern(spark, sf):
    """Nor does one whose pattern ends within an escape."""
    return filter_chunks(events(spark, sf), leaf("like", "kind", "vi%\\"), EVENTS, generated=True).select("id")


#: Ways of writing a time, as formats of Spark.
SPELLED = (
    "EEEE, MMMM d, yyyy h:mm:ss a", "MMM d, yyyy h:mm:ss a", "yyyy/MM/dd hh:mm:ss a", "dd MMM yyyy HH:mm:ss 'GMT'", "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
    "EEE MMM d HH:mm:ss yyyy", "yyyy.MM.dd HH:mm:ss", "M/d/yy H:mm:ss", "HH:mm:ss MMM d yyyy", "yyyyMMdd'T'HHmmss", "yyyyMMddHHmmss", "d-MMM-yyyy HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "MMMM d yyyy 'at' h:mm:ss a",
)


@query(f"select event_id, (event_id % {len(SPELLED)})::int as spelling, date_trunc('second', ts) as ts from events")
def dates_by_tokens(spark, sf):
    """The events' times, each written in one of many ways and read again."""
    rows = table(spark, sf, "events").withColumn("spelling", (F.col("event_id") % len(SPELLED)).cast("int"))
    text = F.date_format("ts", SPELLED[0])
    for k, spelled in enumerate(SPELLED[1:], 1):
        text = F.when(F.col("spelling") == k, F.date_format("ts", spelled)).otherwise(text)
    return rows.select("event_id", "spelling", parse_time(text).cast("timestamp_ntz").alias("ts"))
