import pytest
from pyspark.sql import functions as F

from docketry.session import work_path
from docketry.sources import files
from docketry.sources.tables import (
    VersionedTable,
    delete_where,
    first_per_key,
    insert_new,
    merge_rows,
    replace_group,
    set_where,
)

AMOUNTS = "Name string, Amount long"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def amounts(spark):
    return spark.createDataFrame([("Alice", 100), ("Bob", 201), (None, 5)], AMOUNTS)


def test_merge_updates_and_inserts_copies(spark, amounts):
    source = spark.createDataFrame([("Alice", 75), ("Charlie", 300), ("Charlie", 301)], AMOUNTS)
    got = merge_rows(amounts.where("Name is not null"), source, ["Name"])
    assert rows(got) == [("Alice", 75), ("Bob", 201), ("Charlie", 300), ("Charlie", 301)]
    only = insert_new(amounts.where("Name is not null"), source, ["Name"])
    assert rows(only) == [("Alice", 100), ("Bob", 201), ("Charlie", 300), ("Charlie", 301)]


def test_merge_clash_is_an_error(spark, amounts):
    source = spark.createDataFrame([("Alice", 75), ("Alice", 76)], AMOUNTS)
    with pytest.raises(Exception, match="two source rows"):
        merge_rows(amounts, source, ["Name"]).collect()


def test_merge_null_keys_match_nothing(spark, amounts):
    source = spark.createDataFrame([(None, 9)], AMOUNTS)
    got = merge_rows(amounts, source, ["Name"]).collect()
    assert sorted((r.Name or "", r.Amount) for r in got) == [("", 5), ("", 9), ("Alice", 100), ("Bob", 201)]


def test_merge_update_expression(spark, amounts):
    source = spark.createDataFrame([("Bob", 1)], AMOUNTS)
    got = merge_rows(amounts, source, ["Name"], {"Amount": F.col("t.Amount") + F.col("s.Amount")}, insert=False)
    assert ("Bob", 202) in {tuple(r) for r in got.collect()}


def test_null_conditions(spark, amounts):
    assert delete_where(amounts, F.col("Name") == "Bob").count() == 2
    got = set_where(amounts, F.col("Name") == "Bob", {"Amount": F.lit(0)})
    assert {r.Amount for r in got.collect()} == {100, 0, 5}


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 7, None)], "k string, n int, v string")
    assert sorted(map(tuple, first_per_key(df, ["k"], [F.col("n")]).collect())) == [("a", 1, "y"), ("b", 7, None)]
    assert rows(first_per_key(df.where("k = 'a'"), ["k"], [-F.col("n")])) == [("a", 2, "x")]


def test_versions_and_history(spark, amounts):
    table = VersionedTable(spark, work_path(spark, "amounts"))
    with pytest.raises(ValueError):
        table.read()
    table.overwrite(amounts.where("Name is not null"))
    table.update(F.col("Name") == "Bob", {"Amount": F.lit(999)})
    table.merge(spark.createDataFrame([("Bob", 1), ("Eve", 2)], AMOUNTS), ["Name"])
    table.append(spark.createDataFrame([("Eve", 3)], AMOUNTS))
    table.dedupe(["Name"], [F.col("Amount")])
    table.delete(F.col("Name") == "Alice")
    assert rows(table.read(0)) == [("Alice", 100), ("Bob", 201)]
    assert rows(table.read(1)) == [("Alice", 100), ("Bob", 999)]
    assert rows(table.read(2)) == [("Alice", 100), ("Bob", 1), ("Eve", 2)]
    assert rows(table.read(3)) == [("Alice", 100), ("Bob", 1), ("Eve", 2), ("Eve", 3)]
    assert rows(table.read()) == [("Bob", 1), ("Eve", 2)]
    history = table.history().orderBy("version").collect()
    assert [r.operation for r in history] == ["write", "update", "merge", "append", "dedupe", "delete"]
    assert [r.rows_written for r in history] == [2, 2, 3, 4, 3, 2]
    assert (history[2].rows_updated, history[2].rows_inserted) == (1, 1)
    assert history[3].rows_inserted == 1 and history[5].rows_deleted == 1
    with pytest.raises(ValueError):
        table.read(17)


def test_only_touched_partitions_are_written(spark):
    table = VersionedTable(spark, work_path(spark, "chunks"), partition_by="collection")
    every = spark.createDataFrame([(c, i, f"t{i}") for i, c in enumerate(["a b", "a b", "x/y=1", "c", "c"])], "collection string, id long, text string")
    table.overwrite(every)
    table.update(F.col("id") == 2, {"text": F.lit("new")})
    folders = table.history().where("version = 1").first().folders
    assert sorted(f.split("/")[0] for f in folders) == ["version=0", "version=0", "version=1"]
    assert sorted(map(tuple, table.read().where("id = 2").collect())) == [("x/y=1", 2, "new")]
    table.delete(F.col("collection") == "a b")
    table.merge(
        spark.createDataFrame([("c", 3, "merged"), ("d", 9, "added")], "collection string, id long, text string"), ["id"],
        {"text": F.col("s.text")},
    )
    assert rows(table.read()) == [("c", 3, "merged"), ("c", 4, "t4"), ("d", 9, "added"), ("x/y=1", 2, "new")]
    assert rows(table.read(0)) == rows(every)
    assert [r.rows_written for r in table.history().orderBy("version").collect()] == [5, 5, 3, 4]
    table.delete(F.col("id") >= 0)
    assert table.read().count() == 0 and table.read().columns == ["collection", "id", "text"]


def test_merge_reads_and_writes_touched_buckets_only(spark):
    kind = "id long, text string"
    table = VersionedTable(spark, work_path(spark, "bucketed"), bucket_by=["id"], buckets=16)
    every = spark.createDataFrame([*((i, f"t{i}") for i in range(200)), (None, "none")], kind)
    table.overwrite(every)
    first = table.history().first()
    assert len(first.folders) == 16 and table.read().columns == ["id", "text"]
    # an int key falls into the bucket of the equal long one; a null key matches nothing
    source = spark.createDataFrame([(3, "three"), (900, "new"), (900, "newer"), (None, "also")], "id int, text string")
    table.merge(source, ["id"])
    want = [*((i, "three" if i == 3 else f"t{i}") for i in range(200)), (900, "new"), (900, "newer"), (None, "none"), (None, "also")]
    assert sorted(map(repr, map(tuple, table.read().collect()))) == sorted(map(repr, want))
    second = table.history().where("version = 1").first()
    old = {f for f in second.folders if f.startswith("version=0/")}
    new = {f.split("/")[1] for f in second.folders if f.startswith("version=1/")}
    assert len(new) <= 3 and len(old) == 16 - len(new) and not new & {f.split("/")[1] for f in old}
    assert (second.rows_written, second.rows_updated, second.rows_inserted) == (204, 1, 3)
    table.append(spark.createDataFrame([(5, "twice")], "id int, text string"))
    table.merge(spark.createDataFrame([(5, "five")], kind), ["id"], insert=False)
    assert [r.text for r in table.read().where("id = 5").collect()] == ["five", "five"]
    table.update(F.col("id") == 7, {"id": F.lit(5)})  # moves to another bucket
    table.merge(spark.createDataFrame([(5, "V")], kind), ["id"])
    assert [r.text for r in table.read().where("id = 5").collect()] == ["V"] * 3
    table.merge(every.where("false"), ["id"])
    assert table.read().count() == 205 and table.read(0).count() == 201
    table.dedupe(["id"], [F.col("text")])
    table.delete(F.col("id") < 900)
    assert rows(table.read().where("id is not null")) == [(900, "new")]
    with pytest.raises(ValueError):
        VersionedTable(spark, "x", partition_by="a", bucket_by=["b"])


def test_a_version_without_history_row_does_not_exist(spark, amounts):
    table = VersionedTable(spark, work_path(spark, "torn"))
    table.overwrite(amounts)
    amounts.limit(1).write.parquet(f"{table.root}/data/version=1")
    assert table.read().count() == 3
    table.append(amounts)
    assert table.read().count() == 6


def test_replace_group(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("c", 4)], "k string, v int")
    assert rows(replace_group(old, new, ["k"])) == [("a", 9), ("b", 3), ("c", 4)]


def test_list_files(spark, tmp_path):
    for name in ("b.TXT", "a.pdf", "sub/c.txt", "sub/noext"):
        target = tmp_path / name
        target.parent.mkdir(exist_ok=True)
        target.write_text("hello")
    got = [r.path.rsplit("/", 1)[1] for r in files.list_files(spark, str(tmp_path), [".txt"]).collect()]
    assert got == ["b.TXT", "c.txt"]
    assert files.list_files(spark, str(tmp_path), []).count() == 4


def test_relational_scripts(spark):
    people = spark.createDataFrame([("Ann", 25, "HR"), ("Ben", 19, "IT"), ("Cid", 40, "IT"), ("Dee", 33, "Ops")], "Name string, Age long, Dept string")
    places = spark.createDataFrame([("HR", "Rome"), ("IT", "Oslo"), ("Law", "Bern")], "Dept string, Location string")
    joined = people.join(places, "Dept", "inner")
    assert joined.count() == 3 and joined.filter(joined.Age > 20).count() == 2
    people.createOrReplaceTempView("people")
    got = spark.sql("select Dept, count(*) as n from people where Age > 20 group by Dept")
    assert rows(got) == [("HR", 1), ("IT", 1), ("Ops", 1)]
    kept = people.groupBy("Dept").avg("Age").persist()
    assert kept.count() == kept.count() == 3
    kept.unpersist()
