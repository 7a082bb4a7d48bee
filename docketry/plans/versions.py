"""Table maintenance: update, delete, merge, dedupe, versions, registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.operators.collections import add_filename_field, set_schemas
from docketry.plans.registry import query, table
from docketry.session import work_path
from docketry.sources.payloads import PAYLOAD_TYPE, delete_payloads, get_payloads, list_payloads, put_payloads
from docketry.sources.tables import VersionedTable, first_per_key, insert_new


def _stored(spark, sf, name: str, columns: list[str], **layout) -> VersionedTable:
    stored = VersionedTable(spark, work_path(spark, name), **layout)
    stored.overwrite(table(spark, sf, name).select(*columns))
    return stored


def _accounts(spark, sf):
    """Source of the merges: customers under the names of the supplier table."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("s_suppkey"),
        F.col("c_name").alias("s_name"),
        F.col("c_acctbal").alias("s_acctbal"),
    )


SUPPLIER = ["s_suppkey", "s_name", "s_acctbal"]


@query("""
select p_partkey, p_name, p_size,
  case when p_size > 40 then round(p_retailprice * 2, 4) else p_retailprice end as p_retailprice
from part
""")
def table_update(spark, sf):
    stored = _stored(spark, sf, "part", ["p_partkey", "p_name", "p_size", "p_retailprice"])
    stored.update(F.col("p_size") > 40, {"p_retailprice": F.round(F.col("p_retailprice") * 2, 4)})
    return stored.read()


@query("select c_custkey, c_acctbal from customer where not (c_acctbal < 0)")
def table_delete(spark, sf):
    stored = _stored(spark, sf, "customer", ["c_custkey", "c_acctbal"])
    stored.delete(F.col("c_acctbal") < 0)
    return stored.read()


@query("""
select coalesce(s_suppkey, c_custkey) as s_suppkey,
  case when s_suppkey is null then c_name else s_name end as s_name,
  case when c_custkey is null then s_acctbal else c_acctbal end as s_acctbal
from supplier full join customer on s_suppkey = c_custkey
""")
def table_merge(spark, sf):
    stored = _stored(spark, sf, "supplier", SUPPLIER, bucket_by=["s_suppkey"], buckets=16)
    stored.merge(_accounts(spark, sf), ["s_suppkey"], {"s_acctbal": F.col("s.s_acctbal")})
    return stored.read()


@query("""
select s_suppkey, s_name, s_acctbal from supplier
union all
select c_custkey, c_name, c_acctbal from customer where c_custkey not in (select s_suppkey from supplier)
""")
def merge_insert_only(spark, sf):
    target = table(spark, sf, "supplier").select(*SUPPLIER)
    return insert_new(target, _accounts(spark, sf), ["s_suppkey"])


@query("""
select l_partkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice from (
  select *, row_number() over (partition by l_partkey
    order by l_orderkey, l_linenumber, l_quantity, l_extendedprice) as rn
  from lineitem) where rn = 1
""")
def deduplicated_source(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return first_per_key(rows, ["l_partkey"], [F.col("l_orderkey"), F.col("l_linenumber")])


@query("""
select o_custkey, o_orderkey, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_orderkey) as rn from orders) where rn = 1
""")
def table_dedupe(spark, sf):
    stored = _stored(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_totalprice"])
    stored.dedupe(["o_custkey"], [F.col("o_orderkey")])
    return stored.read()


@query("""
select 0::bigint as version, s_suppkey, s_acctbal from supplier
union all
select 1::bigint, s_suppkey, case when s_acctbal < 0 then 0.0 else s_acctbal end from supplier
""")
def table_versions(spark, sf):
    stored = _stored(spark, sf, "supplier", ["s_suppkey", "s_acctbal"])
    stored.update(F.col("s_acctbal") < 0, {"s_acctbal": F.lit(0.0)})
    old = stored.read(0).select(F.lit(0).cast("long").alias("version"), "*")
    return old.unionByName(stored.read().select(F.lit(1).cast("long").alias("version"), "*"))


@query("""
with s as (select count(*) as n, count(*) filter (s_acctbal < 0) as neg,
             count(*) filter (s_suppkey in (select c_custkey from customer)) as matched from supplier),
     c as (select count(*) as new from customer where c_custkey not in (select s_suppkey from supplier))
select 0::bigint as version, 'write' as operation, n as rows_written, 0::bigint as rows_inserted, 0::bigint as rows_updated, 0::bigint as rows_deleted from s
union all select 1, 'update', n, 0, neg, 0 from s
union all select 2, 'merge', n + new, new, matched, 0 from s, c
union all select 3, 'delete', (select count(*) from customer where c_acctbal >= 1000 and c_custkey not in (select s_suppkey from supplier))
   + (select count(*) from supplier join customer on s_suppkey = c_custkey where c_acctbal >= 1000)
   + (select count(*) from supplier where s_suppkey not in (select c_custkey from customer) and greatest(s_acctbal, 0) >= 1000), 0, 0,
   (select count(*) from customer where c_acctbal < 1000 and c_custkey not in (select s_suppkey from supplier))
   + (select count(*) from supplier join customer on s_suppkey = c_custkey where c_acctbal < 1000)
   + (select count(*) from supplier where s_suppkey not in (select c_custkey from customer) and greatest(s_acctbal, 0) < 1000)
""")
def table_history(spark, sf):
    stored = _stored(spark, sf, "supplier", SUPPLIER)
    stored.update(F.col("s_acctbal") < 0, {"s_acctbal": F.lit(0.0)})
    stored.merge(_accounts(spark, sf), ["s_suppkey"], {"s_acctbal": F.col("s.s_acctbal")})
    stored.delete(F.col("s_acctbal") < 1000)
    return stored.history().select(
        "version", "operation", "rows_written", "rows_inserted", "rows_updated", "rows_deleted"
    )


def _fields_by_brand(part, name: str):
    """A schema per brand with one string field per distinct value of a column."""
    return (
        part.groupBy(F.lower("p_brand").alias("collection"))
        .agg(F.sort_array(F.collect_set(F.lower(name))).alias("names"))
        .select(
            "collection",
            F.expr(
                "transform(names, n -> named_struct('name', n, 'type', 'string', 'required', false, "
                "'array_type', cast(null as string), 'max_length', cast(null as int), "
                "'description', cast(null as string)))"
            ).alias("fields"),
        )
    )


@query("""
with old as (select distinct lower(p_brand) as collection, lower(p_type) as field from part),
     new as (select distinct lower(p_brand) as collection, lower(p_name) as field from part where p_size > 49)
select * from old where collection not in (select collection from new)
union all select * from new
union all select distinct collection, 'filename' from new
""")
def registry_upsert(spark, sf):
    part = table(spark, sf, "part")
    schemas = _fields_by_brand(part, "p_type")
    new = _fields_by_brand(part.where("p_size > 49"), "p_name")
    upserted = set_schemas(schemas, add_filename_field(new))
    return upserted.select("collection", F.explode("fields").alias("f")).select(
        "collection", F.col("f.name").alias("field")
    )


# ---------------------------------------------------------------- payloads


def _messages_as_payloads(spark, sf):
    """Each message stored under its conversation's key, so that later turns overwrite."""
    return table(spark, sf, "conversations").select(
        F.concat(F.lit("chat_::_"), "role", F.lit("_::_"), F.col("conv_id").cast("string")).alias("element_key"),
        F.lit("chat").alias("collection"),
        F.col("role").alias("file_name"),
        F.col("text").alias("content"),
        F.col("turn").alias("put_at"),
    )


def _all_payloads(spark, sf):
    return put_payloads(spark.createDataFrame([], PAYLOAD_TYPE), _messages_as_payloads(spark, sf))


STORED = """
select 'chat_::_' || role || '_::_' || conv_id as element_key, arg_max(text, turn) as content
from conversations group by role, conv_id
"""


@query(STORED)
def payload_put(spark, sf):
    every = _messages_as_payloads(spark, sf)
    return put_payloads(every.where("put_at < 2"), every.where("put_at >= 2")).select("element_key", "content")


@query(f"""
with stored as ({STORED}), asked as (select distinct 'chat_::_user_::_' || conv_id as element_key from conversations
  union select 'chat_::_system_::_' || conv_id from conversations)
select element_key, coalesce(content, '') as content from asked left join stored using (element_key)
""")
def payload_get(spark, sf):
    stored = _all_payloads(spark, sf)
    conv = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("c")).distinct()
    asked = conv.select(
        F.explode(
            F.array(F.concat(F.lit("chat_::_user_::_"), "c"), F.concat(F.lit("chat_::_system_::_"), "c"))
        ).alias("element_key")
    )
    return get_payloads(asked, stored)


@query(f"select element_key from ({STORED}) where starts_with(element_key, 'chat_::_system')")
def payload_list(spark, sf):
    stored = _all_payloads(spark, sf)
    return list_payloads(stored, "chat_::_system")


@query(f"select element_key, content from ({STORED}) where element_key not like 'chat%assistant%'")
def payload_delete(spark, sf):
    stored = _all_payloads(spark, sf)
    gone = list_payloads(stored, "chat_::_assistant")
    return delete_payloads(stored, gone).select("element_key", "content")
