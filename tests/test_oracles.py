"""Every named query at the smallest scale against its SQL, and what its plan must not hold."""

from __future__ import annotations

import os

import pytest
from check_oracles import connect, difference

import __spark_entry__ as entry
from streamlytics import catalog
from streamlytics.catalog import inputs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, name, SF) is None


@pytest.mark.parametrize("name", sorted(n for n in catalog.queries() if not n.startswith("stream_")))
def test_no_join_of_all_pairs(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def plan_of(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_top_n_is_cut_before_the_shuffle(spark):
    assert plan_of(spark, "topn_products").count("WindowGroupLimit") == 2


def test_scans_read_only_what_they_need(spark):
    assert "ReadSchema: struct<event_type:string>" in plan_of(spark, "union_bag")
    assert "ReadSchema: struct<url:string,html:string>" in plan_of(spark, "table_select_where").replace(
        "page_id:bigint,", "")


def test_filters_reach_the_scan(spark):
    views = inputs.events(spark, SF).filter("event_type = 'view'")
    assert "EqualTo(event_type,view)" in views._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", ["first_seen", "cumulative_pv_uv", "upsert_latest", "uv_bitmap", "running_sum", "ip_enrich"])
def test_nothing_is_sorted_to_be_grouped(spark, name):
    plan = plan_of(spark, name)
    # Bitmaps are byte arrays, which the sort-based aggregate merges; all else is hashed.
    assert "SortAggregate" not in plan or name == "uv_bitmap"
