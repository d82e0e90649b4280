"""The ledger continued from stored state equals one run over all days."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators.ledger import continue_ledger, ledger, ledger_state
from tallybook.plans.ledger import ledger_until
from tallybook.plans.zones import Zones
from tallybook.schemas import LEDGER, LEDGER_COLUMNS, LEDGER_STATE
from tallybook.sources import files, sinks
from tallybook.sources.tables import empty_table, read_days, read_table
from tests.fixtures import as_set, curated_frame, plan_of, rate_frame, tx_frame

RATES = {f"2024-01-{d:02d}": 0.05 for d in range(1, 31) if d % 6}


def movements(seed, accounts="abcd"):
    draw = random.Random(seed)
    return [
        ("u", draw.choice(accounts), f"2024-01-{draw.randint(1, 28):02d}T{draw.randint(0, 23):02d}:{i % 60:02d}:00", f"{draw.randint(-90, 300)}.00")
        for i in range(80)
    ] + [("u", "early", "2024-01-02T10:00:00", "500.00"), ("u", "late", "2024-01-27T10:00:00", "500.00")]


@pytest.mark.parametrize("cuts", [[14], [1, 2, 3], [5, 9, 10, 28], [30]])
def test_parts_equal_one_run(spark, cuts):
    tx, rates = tx_frame(spark, movements(1)), rate_frame(spark, RATES)
    want = as_set(ledger(tx, rates))
    state, got = empty_table(spark, LEDGER_STATE).drop("date"), []
    day = F.dayofmonth("event_time")
    for first, last in zip([0, *cuts], [*cuts, 31]):
        rows = continue_ledger(tx.where((day > first) & (day <= last)), rates, state)
        state = spark.createDataFrame(ledger_state(rows, state).collect(), ledger_state(rows, state).schema)
        assert rows.columns == LEDGER_COLUMNS
        got += rows.collect()
    assert sorted(map(tuple, got)) == want
    assert {r.account_id: r.balance for r in state.collect()} == {r[1]: r[-1] for r in want}


@pytest.fixture
def zones(spark, tmp_path):
    zones = Zones(str(tmp_path))
    sinks.write_table(rate_frame(spark, RATES), zones.rates)
    return zones


def stored(spark, zones):
    return as_set(read_table(spark, zones.ledger, LEDGER).select(*LEDGER_COLUMNS))


def test_runs_go_on_and_back(spark, zones):
    rows = movements(2)
    sinks.write_partitioned(curated_frame(spark, rows), zones.transactions)
    for day in (5, 6, 20, 20, 28):
        ledger_until(spark, zones, dt.date(2024, 1, day))
    want = as_set(ledger(tx_frame(spark, rows), rate_frame(spark, RATES)))
    assert stored(spark, zones) == want
    assert files.partition_days(spark, zones.ledger_state) == [dt.date(2024, 1, d) for d in (5, 6, 20, 28)]
    late = rows + [("u", "a", "2024-01-12T01:02:03", "1000.00"), ("u", "new", "2024-01-11T01:02:03", "7.00")]
    sinks.write_partitioned(curated_frame(spark, late), zones.transactions)
    ledger_until(spark, zones, "2024-01-28", from_date="2024-01-11")
    assert stored(spark, zones) == as_set(ledger(tx_frame(spark, late), rate_frame(spark, RATES))) != want


def test_a_run_reads_new_days_and_one_state(spark, zones):
    sinks.write_partitioned(curated_frame(spark, movements(3)), zones.transactions)
    ledger_until(spark, zones, "2024-01-20")
    state = read_days(spark, zones.ledger_state, LEDGER_STATE, [dt.date(2024, 1, 20)])
    tx = read_table(spark, zones.transactions)
    rows = continue_ledger(tx.where(F.col("date") > F.lit(dt.date(2024, 1, 20))), rate_frame(spark, RATES), state)
    plan = plan_of(rows)
    assert plan.count("FileScan") == 2 and "Python" not in plan
    assert rows.count() == sum(r[2].date() > dt.date(2024, 1, 20) for r in as_set(ledger(tx_frame(spark, movements(3)), rate_frame(spark, RATES))))


def test_no_movements(spark, zones):
    ledger_until(spark, zones, "2024-01-20")
    assert files.partition_days(spark, zones.ledger) == []
