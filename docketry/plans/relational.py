"""Joins, filters, aggregates and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.plans.registry import query, table
from docketry.session import cut_lineage, work_path
from docketry.sources.files import list_files, read_columns


@query("""
select o_orderkey, c_name, c_mktsegment, o_totalprice
from orders join customer on o_custkey = c_custkey
""")
def inner_join(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "custkey")
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "custkey")
    return orders.join(customers, "custkey", "inner").select(
        "o_orderkey", "c_name", "c_mktsegment", "o_totalprice"
    )


@query("select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem where l_quantity > 20 and l_discount >= 0.05")
def filter_comparison(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .filter((F.col("l_quantity") > 20) & (F.col("l_discount") >= 0.05))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    )


@query("select count(*) as n from lineitem where l_quantity > 20")
def row_count(spark, sf):
    return table(spark, sf, "lineitem").where("l_quantity > 20").agg(F.count("*").alias("n"))


@query("select o_orderpriority, round(avg(o_totalprice), 4) as avg_price, count(*) as n from orders group by 1")
def group_average(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(F.round(F.avg("o_totalprice"), 4).alias("avg_price"), F.count("*").alias("n"))
    )


@query("select s_suppkey, s_name as supplier_name from supplier")
def renamed_column(spark, sf):
    return table(spark, sf, "supplier").withColumnRenamed("s_name", "supplier_name").select(
        "s_suppkey", "supplier_name"
    )


@query("""
select l_returnflag as part, count(*) as n from lineitem where l_quantity > 25 group by 1
union all select 'all', count(*) from lineitem where l_quantity > 25
""")
def reused_result(spark, sf):
    """A result kept for two uses and released after them."""
    kept = table(spark, sf, "lineitem").where("l_quantity > 25").select(F.col("l_returnflag").alias("part")).persist()
    parts = cut_lineage(kept.groupBy("part").agg(F.count("*").alias("n")))
    every = cut_lineage(kept.agg(F.lit("all").alias("part"), F.count("*").alias("n")))
    kept.unpersist()
    return parts.unionByName(every)


@query("select p_brand, count(*) as n from part where p_size > 20 group by p_brand")
def view_with_sql(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("part_view")
    return spark.sql("select p_brand, count(*) as n from part_view where p_size > 20 group by p_brand")


@query("""
select r.k as custkey, count(o.o_orderkey) as n_orders
from (select unnest(range(0, (select max(o_custkey) + 1 from orders))) as k) r
left join orders o on o.o_custkey = r.k group by 1
""")
def range_of_keys(spark, sf):
    orders = table(spark, sf, "orders")
    top = orders.agg(F.max("o_custkey")).first()[0]
    keys = spark.range(0, top + 1).withColumnRenamed("id", "custkey")
    counts = orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias("n"))
    return keys.join(counts, "custkey", "left").select(
        "custkey", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def first_rows(spark, sf):
    return (
        table(spark, sf, "orders")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .select("o_orderkey", "o_totalprice")
        .limit(20)
    )


@query("select p_partkey, p_name from part")
def parquet_round_trip(spark, sf):
    path = work_path(spark, "part")
    table(spark, sf, "part").write.parquet(path)
    return read_columns(spark, path, ["p_partkey", "p_name"])


@query("""
select 'l_returnflag=' || l_returnflag as folder, true as has_files from lineitem group by l_returnflag
""")
def file_listing(spark, sf):
    path = work_path(spark, "files")
    table(spark, sf, "lineitem").write.partitionBy("l_returnflag").parquet(path)
    files = list_files(spark, path, [".PARQUET"])
    return files.groupBy(F.element_at(F.split("path", "/"), -2).alias("folder")).agg(
        (F.min("length") > 0).alias("has_files")
    )
