"""Registered queries against their SQL counterparts, and the shape of their plans."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks import oracles, queries
from checks.queries import Inputs
from tests.conftest import SF_SMALL
from tools.compare import TABLES, normal

QUERIES = queries.QUERIES
ORACLES = oracles.oracle_sql()
# Their columns are the zones and regions found in the data; the SQL names all
# 25 regions, which the smallest scale does not reach.
ALL_REGIONS = {"one_hot", "encode_features", "prepare_scoring"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return connection


def test_every_sql_key_is_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) == 106
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("key", sorted(set(ORACLES) - ALL_REGIONS))
def test_query_equals_sql(spark, duck, key):
    got = QUERIES[key](spark, SF_SMALL).toPandas()
    want = duck.sql(ORACLES[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got).equals(normal(want))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["account_windows", "purchase_interval", "order_channel", "claim_counts", "roc_auc", "activity_grid"])
def test_plans_have_no_cross_join_and_no_python(spark, key):
    text = plan(QUERIES[key](spark, SF_SMALL))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert banned not in text


def test_feature_build_has_no_python_and_no_cross_join(spark):
    text = plan(Inputs(spark, SF_SMALL).features)
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert banned not in text


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["churn_label"](spark, SF_SMALL))
    assert "l_extendedprice" not in text and "l_quantity" not in text and "o_totalprice" not in text
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(o_orderdate\)", text)


def test_stored_windows_bound_the_sales_scan_by_date(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(Inputs(spark, SF_SMALL).staged_life.window_sales)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.findall(r"PushedFilters: \[([^\]]*)", text)
    assert any("GreaterThanOrEqual(o_ord" in f for f in filters)


def test_ranked_input_is_read_once(spark):
    """The counted scores are stored, so the plan after them has no scan of the given tables."""
    text = plan(QUERIES["roc_auc"](spark, SF_SMALL))
    assert "lineitem" not in text and "counted-" in text


def test_pinned_reference_gives_the_same_windows(spark):
    import dataclasses
    import datetime as dt

    from tidewatch.plans import features as ft

    x = Inputs(spark, SF_SMALL)
    pinned = dataclasses.replace(x.settings, reference=dt.datetime(2001, 6, 30))
    a, b = x.life.windows, ft.build_lifecycle(x.catalog, pinned).windows
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_staged_and_lazy_builds_agree(spark):
    from tidewatch.plans import features as ft

    x = Inputs(spark, SF_SMALL)
    names = ["dealer_code", "`total_sales_cm-1`", "`online_cm-2`", "avg_days_between_purchase", "no_change", "churn_status"]
    lazy = ft.build_features(x.catalog, x.settings, ft.keep_lazy).select(*names)
    assert lazy.exceptAll(x.features.select(*names)).count() == 0 and lazy.count() > 0
