"""Totals per account: their sums, what a day reads through them, and restatement after late movements."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators.chain import snapshot_chain
from tallybook.operators.totals import carried_movements, totals_by_day
from tallybook.plans.curate import curate_transactions_range
from tallybook.plans.payouts import payouts_day, payouts_range, restate_payouts, restated_rows
from tallybook.plans.totals import history, mark_touched, read_touched, refresh_totals
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS, PAYOUTS, TOTALS
from tallybook.sources import files, sinks
from tallybook.sources.tables import empty_table, read_table
from tests.fixtures import as_set, curated_frame, plan_of, rate_frame, tx_frame

RATES = {f"2024-01-{d:02d}": 0.04 + d / 1000 for d in range(3, 20) if d not in (6, 7, 13, 14)}


@pytest.fixture
def zones(spark, tmp_path):
    zones = Zones(str(tmp_path))
    sinks.write_table(rate_frame(spark, RATES), zones.rates)
    return zones


def movements(seed, n=120, accounts="abcdef", days=range(1, 20)):
    draw = random.Random(seed)
    return [
        ("u", draw.choice(accounts), f"2024-01-{draw.choice(days):02d}T{draw.randint(0, 23):02d}:{draw.randint(0, 59):02d}:{i % 60:02d}",
         f"{draw.randint(-9000, 20000) / 100:.2f}")
        for i in range(n)
    ]


def curate(spark, zones, rows):
    """Deliver rows and curate all of their days."""
    days = sorted(dt.date.fromisoformat(r[2][:10]) for r in rows)
    curate_transactions_range(spark, zones, tx_frame(spark, rows), days[0], days[-1], on_duplicate="replace")


def recomputed(spark, zones):
    tx = read_table(spark, zones.transactions, CURATED_TRANSACTIONS)
    return as_set(snapshot_chain(tx, rate_frame(spark, RATES)))


def slow_totals(rows, day):
    sums = defaultdict(Decimal)
    for user, account, time, amount in rows:
        if time[:10] <= day:
            sums[user, account] += Decimal(amount or 0)
    return {(*k, v, dt.date.fromisoformat(day)) for k, v in sums.items()}


@pytest.mark.parametrize("days", [["2024-01-10"], ["2024-01-02", "2024-01-05", "2024-01-06", "2024-01-31"]])
def test_totals_by_day(spark, days):
    rows = movements(1) + [("u", "n", "2024-01-04T00:00:00", None), (None, None, "2024-01-04T00:00:00", "1.00")]
    none = empty_table(spark, TOTALS)
    got = totals_by_day(carried_movements(none, curated_frame(spark, rows)), [dt.date.fromisoformat(d) for d in days])
    assert got.columns == TOTALS.fieldNames()
    assert {tuple(r) for r in got.collect()} == set().union(*(slow_totals(rows, d) for d in days))
    assert totals_by_day(carried_movements(none, curated_frame(spark, [])), [dt.date(2024, 1, 1)]).isEmpty()


def test_totals_stand_for_all_history(spark, zones):
    rows = movements(2)
    curate(spark, zones, rows)
    for until in ("2024-01-08", "2024-01-12", "2024-01-11"):
        refresh_totals(spark, zones, until)
    assert files.partition_days(spark, zones.totals) == [dt.date(2024, 1, d) for d in (8, 11, 12)]
    stored = read_table(spark, zones.totals, TOTALS)
    for day in ("2024-01-08", "2024-01-11", "2024-01-12"):
        assert {tuple(r) for r in stored.where(F.col("date") == day).collect()} == slow_totals(rows, day)


def test_a_day_reads_its_partition_and_the_last_totals_only(spark, zones):
    curate(spark, zones, movements(3))
    for day in ("2024-01-09", "2024-01-10", "2024-01-11"):
        payouts_day(spark, zones, day)
    read = history(spark, zones, dt.date(2024, 1, 12), dt.date(2024, 1, 12))
    folders = {"/".join(f.split("/")[-3:-1]) for f in read.inputFiles()}
    assert folders == {"totals/date=2024-01-11", "transactions/date=2024-01-12"}
    plan = plan_of(read.groupBy("account_id").agg(F.sum("amount")))
    assert plan.count("FileScan") == 2


def test_days_through_totals_equal_the_chain(spark, zones):
    rows = movements(4)
    curate(spark, zones, rows)
    payouts_range(spark, zones, "2024-01-01", "2024-01-08")
    for day in range(9, 18):
        payouts_day(spark, zones, f"2024-01-{day:02d}")
    payouts_range(spark, zones, "2024-01-18", "2024-01-19")
    assert as_set(read_table(spark, zones.payouts, PAYOUTS)) == recomputed(spark, zones)


@pytest.mark.parametrize("seed", [5, 6])
def test_restatement_equals_full_recomputation(spark, zones, seed):
    curate(spark, zones, movements(seed, n=90))
    payouts_range(spark, zones, "2024-01-01", "2024-01-19")
    before = as_set(read_table(spark, zones.payouts, PAYOUTS))
    late = movements(seed + 10, n=6, accounts="abz", days=range(5, 18))
    curate(spark, zones, late)
    touched = {r.account_id for r in read_touched(spark, zones, "payouts").collect()}
    assert touched == {r[1] for r in late}
    restate_payouts(spark, zones)
    after = as_set(read_table(spark, zones.payouts, PAYOUTS))
    assert after == recomputed(spark, zones) != before
    assert [r for r in after if r[1] not in "abz"] == [r for r in before if r[1] not in "abz"]
    assert read_touched(spark, zones, "payouts").isEmpty() and read_touched(spark, zones, "totals").isEmpty()
    restate_payouts(spark, zones)
    assert as_set(read_table(spark, zones.payouts, PAYOUTS)) == after


def test_only_touched_accounts_are_folded(spark, zones):
    curate(spark, zones, movements(7))
    payouts_range(spark, zones, "2024-01-01", "2024-01-19")
    first = dt.date(2024, 1, 9)
    touched = spark.createDataFrame([("u", "a", first)], "user_id string, account_id string, date date")
    days = [d for d in files.partition_days(spark, zones.payouts) if d >= first]
    rows = restated_rows(spark, zones, touched, first, days)
    assert {r.account_id for r in rows.collect()} == {"a"}
    plan = plan_of(rows)
    assert "LeftSemi" in plan


def test_usual_days_leave_no_marks(spark, zones):
    curate(spark, zones, movements(8, days=range(1, 10)))
    payouts_range(spark, zones, "2024-01-01", "2024-01-09")
    curate(spark, zones, movements(9, days=range(10, 12)))
    assert read_touched(spark, zones, "payouts").isEmpty()
    unread = curated_frame(spark, []).withColumn("amount", F.raise_error(F.lit("read")).cast("decimal(18,2)"))
    mark_touched(spark, zones, unread, [dt.date(2024, 1, 12)])


def test_nothing_to_restate(spark, zones):
    restate_payouts(spark, zones)
    refresh_totals(spark, zones)
    payouts_day(spark, zones, "2024-01-09")
    assert files.partition_days(spark, zones.totals) == files.partition_days(spark, zones.payouts) == []
