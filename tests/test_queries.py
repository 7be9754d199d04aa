"""Every named query against its SQL, and the plans of all of them."""

import re

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from scorefold.plans.oracle import SQL
from scorefold.plans.registry import QUERIES



@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


SEARCHES = [n for n in QUERIES if n.startswith(("table_search", "indexed_", "match_", "page_", "student_search", "subject_search", "career_analysis_search"))]


@pytest.mark.parametrize("name", SEARCHES)
def test_searches_find_something(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.01").head(1)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, con, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas", plan)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
