"""Every registered query beside its SQL, or at least with rows."""

import pytest
from compare import difference, duck

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", [n for n in queries() if n in SQL])
def test_agrees_with_sql(spark, sf, con, name):
    got = queries()[name](spark, sf).toPandas()
    assert difference(got, con.sql(SQL[name]).df()) is None


@pytest.mark.parametrize("name", [n for n in queries() if n not in SQL])
def test_has_rows(spark, sf, name):
    assert not queries()[name](spark, sf).isEmpty()


def test_entry(spark):
    assert entry(spark).columns == ["query_id", "collection", "chunk_id", "rank", "score", "document_name"]


@pytest.mark.parametrize("name", ["filtered_top_k", "keyword_top_k", "documents_deleted", "recall_by_question", "metadata_per_file", "upload_gates"])
def test_no_cross_join(spark, sf, name):
    plan = queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("name, pushed", [("filter_day", "GreaterThanOrEqual(ts"), ("filter_number_between", "LessThanOrEqual(p_retailprice"), ("filter_after_time", "GreaterThan(ts"), ("filter_not_in_list", "Not(In(p_size")])
def test_filter_reaches_the_scan(spark, sf, name, pushed):
    plan = queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert pushed in plan
