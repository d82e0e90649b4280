"""The calendar-day snapshot, one day and whole ranges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators import balances as bal
from tallybook.operators.chain import snapshot_chain
from tallybook.operators.snapshot import daily_snapshot
from tallybook.schemas import PAYOUTS
from tallybook.sources.tables import empty_table
from tests.fixtures import as_set, curated_frame, payout_frame, rate_frame

DAY = dt.date(2024, 1, 17)


def payout(opening, movement, eligible, interest, closing, day, user="u", account="a"):
    return (user, account, opening, movement, eligible, interest, closing, dt.date.fromisoformat(day))


def snapshot(spark, tx, rates, previous=None, day="2024-01-17"):
    previous = empty_table(spark, PAYOUTS) if previous is None else previous
    return as_set(daily_snapshot(curated_frame(spark, tx), rate_frame(spark, rates), previous, day))


def test_minimum_is_inclusive(spark):
    got = snapshot(spark, [("u", "a", "2024-01-10T10:00:00", "100.00")], {"2024-01-17": 0.05})
    assert got == [payout(100.0, 0.0, 100.0, 0.05, 100.05, "2024-01-17")]


def test_small_balances_are_kept_without_interest(spark):
    got = snapshot(spark, [
        ("u", "a", "2024-01-10T10:00:00", "99.99"), ("u", "a", "2024-01-17T10:00:00", "1.00"),
    ], {"2024-01-17": 0.05})
    assert got == [payout(99.99, 1.0, 0.0, 0.0, 100.99, "2024-01-17")]


def test_first_movement_on_the_day(spark):
    got = snapshot(spark, [("u", "a", "2024-01-17T10:00:00", "50.00")], {"2024-01-17": 0.05})
    assert got == [payout(0.0, 50.0, 0.0, 0.0, 50.0, "2024-01-17")]


def test_null_amounts_and_null_accounts(spark):
    tx = [
        ("u", "a", "2024-01-17T10:00:00", None),
        ("u", None, "2024-01-17T10:00:00", "10.00"),
        ("u", "late", "2024-01-18T10:00:00", "10.00"),
        ("u", "never", None, "10.00"),
    ]
    want = {
        payout(0.0, 0.0, 0.0, 0.0, 0.0, "2024-01-17"),
        payout(0.0, 0.0, 0.0, 0.0, 0.0, "2024-01-17", account=None),
    }
    rates = {"2024-01-17": 0.05}
    day = daily_snapshot(
        curated_frame(spark, tx), rate_frame(spark, rates), empty_table(spark, PAYOUTS), DAY
    )
    assert {tuple(r) for r in day.collect()} == want
    chain = snapshot_chain(curated_frame(spark, tx), rate_frame(spark, rates))
    assert {tuple(r) for r in chain.collect()} == want


@pytest.mark.parametrize("rates", [{}, {"2024-01-16": 0.05}, {"2024-01-17": None}])
def test_no_rate_no_rows(spark, rates):
    assert snapshot(spark, [("u", "a", "2024-01-10T10:00:00", "100.00")], rates) == []


def test_previous_payout_wins_over_history(spark):
    previous = payout_frame(spark, [
        payout(1.0, 2.0, 3.0, 4.0, 200.0, "2024-01-16"),
        payout(1.0, 2.0, 3.0, 4.0, 900.0, "2024-01-15", account="b"),
    ])
    tx = [("u", "a", "2024-01-10T10:00:00", "5.00"), ("u", "b", "2024-01-10T10:00:00", "6.00")]
    got = snapshot(spark, tx, {"2024-01-17": 0.05}, previous)
    assert got == [
        payout(200.0, 0.0, 200.0, 0.1, 200.1, "2024-01-17"),
        payout(6.0, 0.0, 0.0, 0.0, 6.0, "2024-01-17", account="b"),
    ]


def chain(spark, tx, rates, **kwargs):
    return as_set(snapshot_chain(curated_frame(spark, tx), rate_frame(spark, rates), **kwargs))


def test_gap_reopens_from_raw_sums(spark):
    got = chain(
        spark, [("u", "a", "2024-01-04T10:00:00", "1000.00")],
        {"2024-01-05": 0.04, "2024-01-08": 0.04},
    )
    assert got == [
        payout(1000.0, 0.0, 1000.0, 0.4, 1000.4, "2024-01-05"),
        payout(1000.0, 0.0, 1000.0, 0.4, 1000.4, "2024-01-08"),
    ]


def test_consecutive_days_carry(spark):
    got = chain(
        spark, [("u", "a", "2024-01-07T10:00:00", "1000.00")],
        {"2024-01-08": 0.04, "2024-01-09": 0.04},
    )
    assert got == [
        payout(1000.0, 0.0, 1000.0, 0.4, 1000.4, "2024-01-08"),
        payout(1000.4, 0.0, 1000.4, 0.40016, 1000.80016, "2024-01-09"),
    ]


def random_inputs(seed, accounts=12):
    days = 38 if seed == 0 else 16
    rng = random.Random(seed)
    start = dt.date(2024, 1, 1)
    tx = [
        ("u", f"a{rng.randrange(accounts)}",
         f"{start + dt.timedelta(days=rng.randrange(days))}T{rng.randrange(24):02d}:00:00",
         f"{rng.uniform(-100, 160):.2f}")
        for _ in range(150)
    ]
    # Account a0 dominates and a1 acts once, so spans of every length occur.
    tx += [("u", "a0", f"{start}T01:00:00", "1.00")] * 100 + [("u", "once", f"{start}T00:00:00", "500.00")]
    rates = {
        str(start + dt.timedelta(days=i)): round(rng.uniform(0.01, 0.09), 4)
        for i in range(3, days + 2) if rng.random() < 0.8 or seed == 0
    }
    return tx, rates


def loop_over_days(spark, tx, rates, previous=None):
    """The literal daily run: each day reads what the day before wrote."""
    done = [] if previous is None else [tuple(r) for r in previous.collect()]
    before = len(done)
    for day in sorted(rates):
        rows = daily_snapshot(
            tx, rate_frame(spark, rates), payout_frame(spark, done), day
        ).collect()
        done += [tuple(r) for r in rows]
    return sorted(done[before:])


@pytest.mark.parametrize("seed", [0, 1])
def test_chain_equals_daily_runs(spark, seed):
    rows, rates = random_inputs(seed)
    tx = curated_frame(spark, rows).cache()
    assert as_set(snapshot_chain(tx, rate_frame(spark, rates))) == loop_over_days(spark, tx, rates)


def test_chain_continues_from_previous_payouts(spark):
    rows, rates = random_inputs(0)
    tx = curated_frame(spark, rows).cache()
    whole = snapshot_chain(tx, rate_frame(spark, rates))
    cut = dt.date(2024, 1, 12)
    first = payout_frame(
        spark, [tuple(r) for r in whole.where(F.col("date") <= F.lit(cut)).collect()]
    )
    rest = snapshot_chain(
        tx, rate_frame(spark, rates), previous=first, from_date=cut + dt.timedelta(days=1)
    )
    assert as_set(rest) == as_set(whole.where(F.col("date") > F.lit(cut)))


def test_chain_without_rates_or_transactions(spark):
    assert chain(spark, [("u", "a", "2024-01-07T10:00:00", "1.00")], {}) == []
    assert chain(spark, [], {"2024-01-08": 0.04}) == []


def test_day_sums_agree_with_the_single_pass(spark):
    rows, rates = random_inputs(3)
    tx = curated_frame(spark, rows)
    eve = DAY - dt.timedelta(days=1)
    movement = {tuple(r) for r in bal.movement_of_day(tx, DAY).collect()}
    history = {tuple(r) for r in bal.balance_until(tx, eve).collect()}
    accounts = {tuple(r) for r in bal.accounts_today(tx, DAY).collect()}
    assert accounts == {m[:2] for m in movement} | {h[:2] for h in history}
    day = daily_snapshot(
        tx, rate_frame(spark, {str(DAY): 0.05}), empty_table(spark, PAYOUTS), DAY
    ).collect()
    assert {(r.user_id, r.account_id) for r in day} == accounts
    sums = {h[:2]: float(h[2]) for h in history}
    assert {(r.user_id, r.account_id): r.saldo_a_mais_24_horas for r in day} == {
        a: sums.get(a, 0.0) for a in accounts
    }
