"""Every named query against its SQL on the smallest tables, and the shape of its plan."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck
from crawlmart.plans.oracles import ORACLES
from crawlmart.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
EMPTY_THERE = {"ingest_incremental"}  # its drawn columns hold known articles only


@pytest.fixture(scope="module")
def db():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    found = compare(spark, db, SF, name)
    assert found == "" or (found == "no rows" and name in EMPTY_THERE)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(queries()) >= set(QUERIES) and set(oracle_sql()) >= set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NARROW = "read_pages md5_key html_unescape rewrite_images slug_from_url parse_published".split()


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in _plan(queries()[name](spark, SF))


@pytest.mark.parametrize(
    "name",
    "explode_posts explode_members flatten_column_info html_table_rows first_write_wins flag_new "
    "load_fact until_first_seen crawl_summary".split(),
)
def test_no_python_in_the_plan(spark, name):
    plan = _plan(queries()[name](spark, SF))
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_first_write_wins_prunes_before_the_shuffle(spark):
    plan = _plan(queries()["first_write_wins"](spark, SF))
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning(md5")
    assert partial > exchange  # printed top down: the partial limit stands below the exchange


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(queries()["max_id"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
