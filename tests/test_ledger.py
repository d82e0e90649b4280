"""The 24-hour ledger: a published 19-day table and edge cases."""

import datetime as dt
import random

import pytest

from tallybook.functions.running import CHUNK
from tallybook.operators.ledger import ledger, ledger_report
from tallybook.schemas import LEDGER_COLUMNS, LEDGER_REPORT_COLUMNS
from tests.fixtures import rate_frame, tx_frame

USER = "b7c5b9c6-48f5-5ead-bd92-54e699e8913f"
ACCOUNT = "0386e6ab-62e2-558a-96e9-7ae11605bb66"
# --- fixed values: time, movement, rate, opening, interest, total of the published table ---
PUBLISHED = [
    ("2024-04-30T22:12:50.877-03:00", "43.75", 0.040168, 0.0, 0.0, 43.75),
    ("2024-05-01T22:15:42.856-03:00", "31.80", 0.0, 43.75, 0.0, 75.55),
    ("2024-05-02T10:14:38.527-03:00", "52.60", 0.040168, 75.55, 0.0, 128.15),
    ("2024-05-03T06:58:16.117-03:00", "235.15", 0.040168, 128.15, 0.0, 363.30),
    ("2024-05-04T19:55:36.753-03:00", "-290.63", 0.0, 363.30, 0.0, 72.67),
    ("2024-05-05T22:05:47.548-03:00", "32.85", 0.0, 72.67, 0.0, 105.52),
    ("2024-05-06T18:14:08.838-03:00", "-244.82", 0.040168, 105.52, 0.0, -139.30),
    ("2024-05-07T23:06:06.852-03:00", "313.48", 0.040168, -139.30, 0.0, 174.18),
    ("2024-05-08T19:47:11.777-03:00", "39.73", 0.040168, 174.18, 0.0, 213.91),
    ("2024-05-09T22:50:08.433-03:00", "-47.36", 0.03927, 213.91, 0.084002, 166.63),
    ("2024-05-10T22:19:16.695-03:00", "733.29", 0.03927, 166.63, 0.0, 899.92),
    ("2024-05-11T10:49:21.391-03:00", "572.62", 0.0, 899.9240024569999, 0.0, 1472.5440024569998),
    ("2024-05-12T23:44:20.200-03:00", "-811.04", 0.0, 1472.5440024569998, 0.0, 661.5040024569998),
    ("2024-05-13T23:59:53.935-03:00", "193.90", 0.03927,
     661.5040024569998, 0.2597726217648638, 855.6637750787647),
    ("2024-05-14T18:53:01.821-03:00", "-503.31", 0.03927, 855.6637750787647, 0.0, 352.3537750787647),
    ("2024-05-15T22:15:27.070-03:00", "-243.70", 0.03927,
     352.3537750787647, 0.13836932747343092, 108.79214440623817),
    ("2024-05-16T14:05:47.442-03:00", "-6.86", 0.03927, 108.79214440623817, 0.0, 101.93214440623817),
    ("2024-05-17T19:40:12.213-03:00", "253.40", 0.03927,
     101.93214440623817, 0.04002875310832973, 355.3721731593465),
    ("2024-05-18T23:21:46.544-03:00", "-414.61", 0.0, 355.3721731593465, 0.0, -59.2378268406535),
]
ROUNDED_IN_PRINT = (9, 10)
# --- end of fixed values ---


@pytest.fixture
def sao_paulo(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_published_table(spark, sao_paulo):
    tx = tx_frame(spark, [(USER, ACCOUNT, row[0], row[1]) for row in PUBLISHED])
    rates = rate_frame(spark, {row[0][:10]: row[2] for row in PUBLISHED if row[2]})
    rows = ledger(
        tx, rates, accounts=[ACCOUNT], from_date="2024-04-30", to_date="2024-05-25"
    )
    assert rows.columns == LEDGER_COLUMNS
    assert dict(rows.dtypes)["saldo_dia_anterior"].startswith("decimal")
    report = ledger_report(rows)
    assert report.columns == LEDGER_REPORT_COLUMNS
    got = rows.orderBy("event_date").selectExpr("to_date(event_date) AS day", "*").collect()
    assert len(got) == len(PUBLISHED)
    previous_movement = 0.0
    for i, (row, want) in enumerate(zip(got, PUBLISHED)):
        near = 0.005 if i in ROUNDED_IN_PRINT else 1e-9
        assert row.day == dt.date.fromisoformat(want[0][:10])
        assert float(row.saldo_dia_anterior) == previous_movement
        assert row.valor_cdi == want[2]
        assert (row.horario_saldo_elegivel is None) == (i == 0)
        assert row.saldo_dia_anterior_corrigido == pytest.approx(want[3], abs=near)
        assert row.cdi_diario == pytest.approx(want[4], abs=near)
        assert row.total == pytest.approx(want[5], abs=near)
        previous_movement = float(want[1])
    assert got[9].cdi_diario == pytest.approx(0.084002457, abs=1e-9)
    assert got[9].total == pytest.approx(166.634002457, abs=1e-9)
    assert got[10].total == pytest.approx(899.924002457, abs=1e-9)


def test_day_depends_on_time_zone(spark, sao_paulo):
    tx = tx_frame(spark, [(USER, ACCOUNT, "2024-04-30T22:12:50.877-03:00", "1.00")])
    assert tx.selectExpr("to_date(event_time) AS d").first().d == dt.date(2024, 4, 30)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tx.selectExpr("to_date(event_time) AS d").first().d == dt.date(2024, 5, 1)


def interest(spark, first_amount, second_time, rates=None, first_time="2024-01-01T00:00:00"):
    tx = tx_frame(spark, [("u", "a", first_time, first_amount), ("u", "a", second_time, "0.00")])
    rates = {second_time[:10]: 0.05} if rates is None else rates
    rows = ledger(tx, rate_frame(spark, rates)).orderBy("event_date").collect()
    return rows[1].cdi_diario


def test_minimum_is_exclusive(spark):
    assert interest(spark, "100.00", "2024-01-02T06:00:00") == 0.0
    assert interest(spark, "100.01", "2024-01-02T06:00:00") == pytest.approx(0.050005)


@pytest.mark.parametrize("time, expected", [
    ("2024-01-02T00:00:00", 0.0),
    ("2024-01-02T00:00:01", 0.1),
    ("2024-01-02T00:00:00.900", 0.0),
])
def test_hold_counts_whole_seconds(spark, time, expected):
    assert interest(spark, "200.00", time) == pytest.approx(expected, abs=1e-12)


def test_missing_rate_pays_nothing_and_chain_goes_on(spark):
    tx = tx_frame(spark, [
        ("u", "a", "2024-01-01T00:00:00", "200.00"),
        ("u", "a", "2024-01-02T06:00:00", "1.00"),
        ("u", "a", "2024-01-03T12:00:00", "0.00"),
    ])
    rows = ledger(tx, rate_frame(spark, {"2024-01-03": 0.05})).orderBy("event_date").collect()
    assert [r.cdi_diario for r in rows] == [0.0, 0.0, pytest.approx(0.1005)]
    assert rows[2].saldo_dia_anterior_corrigido == 201.0


def test_accounts_are_independent_and_inactive_days_absent(spark):
    tx = tx_frame(spark, [
        ("u", "a", "2024-01-01T10:00:00", "500.00"),
        ("u", "b", "2024-01-02T10:00:00", "7.00"),
        ("u", "a", "2024-01-04T10:00:01", "1.00"),
    ])
    rates = rate_frame(spark, {"2024-01-02": 0.05, "2024-01-04": 0.05})
    got = {
        (r.account_id, str(r.event_date)[:10]): (r.saldo_dia_anterior_corrigido, r.cdi_diario)
        for r in ledger(tx, rates).collect()
    }
    assert got == {
        ("a", "2024-01-01"): (0.0, 0.0),
        ("b", "2024-01-02"): (0.0, 0.0),
        ("a", "2024-01-04"): (500.0, pytest.approx(0.25)),
    }


def test_look_back_reaches_before_the_range(spark):
    tx = tx_frame(spark, [
        ("u", "a", "2024-01-01T10:00:00", "500.00"),
        ("u", "a", "2024-01-02T10:00:00", "3.00"),
        ("u", "a", "2024-01-03T11:00:00", "4.00"),
    ])
    rows = ledger(
        tx, rate_frame(spark, {}), from_date="2024-01-02", to_date="2024-01-02"
    ).collect()
    assert len(rows) == 1
    assert rows[0].saldo_dia_anterior == 500.0
    assert rows[0].horario_saldo_elegivel is not None
    assert rows[0].saldo_dia_anterior_corrigido == 0.0


@pytest.mark.parametrize("days", [1, CHUNK - 1, CHUNK, CHUNK + 1, 3 * CHUNK, 100])
def test_long_accounts_match_a_plain_loop(spark, days):
    rng = random.Random(days)
    start = dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc)
    rows, rates = [], {}
    for i in range(days):
        day = start + dt.timedelta(days=i, seconds=rng.randrange(86400))
        rows.append(("u", "a", day.isoformat(), f"{rng.uniform(-80, 120):.2f}"))
        rates[day.date().isoformat()] = round(rng.uniform(0.01, 0.09), 4)
    balance, previous, want = 0.0, None, []
    for _, _, text, amount in rows:
        now = dt.datetime.fromisoformat(text)
        held = previous is not None and int((now - previous).total_seconds()) > 24 * 3600
        gain = rates[text[:10]] / 100.0 * balance if held and balance > 100 else 0.0
        want.append((balance, gain, balance + float(amount) + gain))
        balance, previous = want[-1][2], now
    got = ledger(tx_frame(spark, rows), rate_frame(spark, rates)).orderBy("event_date").collect()
    assert [(r.saldo_dia_anterior_corrigido, r.cdi_diario, r.total) for r in got] == want
