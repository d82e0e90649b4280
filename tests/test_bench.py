"""The benchmark starts, and every query it names exists and runs."""

import bench
from benchmarks.loops import LOOPS
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_headline_queries_exist():
    assert set(bench.HEADLINE) <= set(QUERIES)
    assert set(LOOPS) <= set(QUERIES)


def test_one_query_is_timed(spark):
    assert bench.seconds(QUERIES["tx_quality"], spark, SF_DIR, runs=1) > 0


def test_day_by_day_form_gives_the_same_rows(spark):
    daily, ranged = (sorted(map(tuple, run["merge_transactions"](spark, SF_DIR).select("account_id", "event_time", "date").collect()), key=str)
                     for run in (LOOPS, QUERIES))
    assert [r[0] for r in daily] == [r[0] for r in ranged] and len(daily) > 0
