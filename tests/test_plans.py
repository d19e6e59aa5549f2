"""Plan-shape checks for the scale properties the README claims."""

import re

import pytest
from pyspark.sql import functions as F

from strata.plans import catalog
from strata.operators import growth, ordered, relational as R
from strata.sources import adapters as A
from strata.sources.readers import Tables
from tests.conftest import SF_SMALL

QUERIES = catalog.QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_funnel_has_no_range_self_join(spark):
    ev = A.web_events(Tables(spark, SF_SMALL))
    p = _plan(growth.funnel(ev, "/signup"))
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[([^\]]*)\], \[([^\]]*)\]", p)
    # one equi join of the units with the per-(user, day) aggregate; the time
    # comparison is a residual against that single row, not a range self-join
    assert len(joins) == 1, p
    assert "user_id" in joins[0][1] and "d#" in joins[0][1]


def test_scans_in_order_do_not_shuffle_the_sorted_table(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), "id")
    for out in (R.keyed_sequence(df, ["k"], [F.col("id")], "s"), ordered.next_event(df, ["k"], "id", [])):
        assert "Exchange" not in _plan(out)


def test_day_filter_reaches_scan(spark):
    from strata.operators import datelist
    ev = A.web_events(Tables(spark, SF_SMALL))
    p = _plan(datelist.datelist_step(None, ev, ["user_id"], "2024-01-05"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", p)
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,props:string>|ReadSchema: struct<[^>]*>", p)
