"""Every query against the SQL of another engine, and the shape of its plan."""

from __future__ import annotations

import pytest
from oracle import compare

import __spark_entry__ as entry_points

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, tables, name):
    assert compare(spark, tables, QUERIES[name], ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark, tables):
    cube = entry_points.entry(spark)
    assert cube.columns == ["time", "query_type", "os", "source_type", "appid", "source", "active", "cnt"]
    assert not cube.isEmpty()


_LAZY = ["ad_cube", "zscore", "popularity_predict", "kmeans_assign", "class_priors", "idf", "kmeans_anomalies_fixed",
         "onehot_encode", "chi_square", "chi_square_edges", "triplets", "lsa_docs_for_query", "join_not_member"]


@pytest.mark.parametrize("name", _LAZY)
def test_plan_has_no_cross_join(spark, tables, name):
    plan = QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_json_is_parsed_once(spark, tables):
    plan = QUERIES["flatten_ad_payload"](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_terms_are_built_once(spark, tables):
    plan = QUERIES["term_freq"](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1


def test_scan_reads_only_needed_columns(spark, tables):
    plan = QUERIES["threshold_confusion"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1]
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema
