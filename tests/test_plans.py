"""Shape of the physical plans: shuffles, scans, broadcasts."""

import re

import pytest

from tallybook.operators.chain import snapshot_chain
from tallybook.operators.ledger import ledger
from tallybook.operators.merge import merge_upsert
from tallybook.operators.quality import dedup_latest, key_quality
from tallybook.operators.snapshot import daily_snapshot
from tallybook.schemas import CURATED_TRANSACTIONS, PAYOUTS, RATES, TRANSACTION_KEY
from tallybook.sources import sinks
from tallybook.sources.tables import empty_table, read_table
from tests.fixtures import curated_frame, plan_of, rate_frame


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    tx = [("u", a, f"2024-01-{d:02d}T10:00:00", "50.00") for a in "abc" for d in range(1, 20)]
    sinks.write_partitioned(curated_frame(spark, tx), f"{base}/tx")
    sinks.write_table(rate_frame(spark, {f"2024-01-{d:02d}": 0.04 for d in range(5, 20)}), f"{base}/r")
    return read_table(spark, f"{base}/tx", CURATED_TRANSACTIONS), read_table(spark, f"{base}/r", RATES)


def account_shuffles(plan):
    return len(re.findall(r"Exchange hashpartitioning\([^)]*account_id", plan))


def scans(plan, path):
    """Scans of a table in the main plan, which ends where subqueries are printed."""
    return len(re.findall(rf"FileScan parquet .*{path}\]", plan))


def test_ledger_shuffles_twice(tables):
    plan = plan_of(ledger(*tables))
    assert account_shuffles(plan) == 2
    assert scans(plan, "/tx") == 1
    assert "partial_sum(amount" in plan
    assert "BroadcastHashJoin" in plan and "Python" not in plan


def test_chain_shuffles_twice(tables):
    plan = plan_of(snapshot_chain(*tables))
    assert account_shuffles(plan) == 2
    assert scans(plan, "/tx") == 1
    assert "partial_sum" in plan and "Python" not in plan


def test_chain_prunes_days_after_the_range(tables):
    plan = plan_of(snapshot_chain(*tables, to_date="2024-01-10"))
    assert re.search(r"PartitionFilters: \[[^\]]*date[^\]]*<=", plan)


def test_snapshot_shuffles_once_and_prunes(spark, tables):
    plan = plan_of(daily_snapshot(*tables, empty_table(spark, PAYOUTS), "2024-01-10"))
    assert account_shuffles(plan) <= 2  # the sums, and the previous payouts unless broadcast
    assert scans(plan, "/tx") == 1
    assert "2024-01-10" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<user_id:string,account_id:string,amount:decimal(18,2)>" in plan


def test_dedup_and_quality_combine_before_the_shuffle(tables):
    tx, _ = tables
    dedup = plan_of(dedup_latest(tx, TRANSACTION_KEY, ["amount"]))
    assert "partial_max" in dedup and "Window" not in dedup
    assert "partial_count" in plan_of(key_quality(tx, TRANSACTION_KEY))


def test_small_source_is_broadcast_into_the_target(tables):
    tx, _ = tables
    plan = plan_of(merge_upsert(tx, tx.limit(5), TRANSACTION_KEY, on_duplicate="keep_all"))
    assert "LeftOuter, BuildRight" in plan
