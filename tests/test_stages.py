"""Landing, curation and payout stages on files."""

import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tallybook.operators.balances import curate_transactions
from tallybook.operators.snapshot import daily_snapshot
from tallybook.plans.curate import curate_day
from tallybook.plans.daily import run_day
from tallybook.plans.payouts import payouts_day, payouts_range
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS, PAYOUTS, RATE_PAYLOAD, RATES
from tallybook.sources import rates as rate_source
from tallybook.sources import sinks
from tallybook.sources.manifest import read_transactions
from tallybook.sources.tables import empty_table, read_table, table_exists
from tests.fixtures import as_set, curated_frame, plan_of, rate_frame, tx_frame


@pytest.fixture
def zones(tmp_path):
    return Zones(str(tmp_path))


def land(spark, zones, rates):
    rows = [
        (dt.date.fromisoformat(d),
         json.dumps([{"data": dt.date.fromisoformat(d).strftime("%d/%m/%Y"), "valor": v}]))
        for d, v in rates.items()
    ]
    rate_source.land_rates(spark.createDataFrame(rows, "date date, payload string"), zones.raw_rates)


def raw(spark, zones, rows):
    tx_frame(spark, rows).write.mode("append").parquet(zones.raw_transactions)


TX = [
    ("u", "a", "2024-01-08T10:00:00", "1000.00"),
    ("u", "a", "2024-01-09T10:00:00", "5.00"),
    ("u", "b", "2024-01-09T11:00:00", "7.00"),
    ("u", "b", "2024-01-10T00:00:00", "1.00"),
]


def test_landing_layout_and_replacement(spark, zones):
    land(spark, zones, {"2024-01-09": "0.04", "2024-01-10": "0.05"})
    assert sorted(d for d in os.listdir(zones.raw_rates) if "=" in d) == [
        "data=2024-01-09", "data=2024-01-10",
    ]
    land(spark, zones, {"2024-01-09": "0.06"})
    empty = spark.createDataFrame(
        [(dt.date(2024, 1, 10), "[]"), (dt.date(2024, 1, 11), None)], "date date, payload string"
    )
    rate_source.land_rates(empty, zones.raw_rates)
    assert as_set(rate_source.read_landed_rates(spark, zones.raw_rates)) == [
        ("09/01/2024", "0.06"), ("10/01/2024", "0.05"),
    ]
    one = rate_source.read_landed_rates(spark, zones.raw_rates, "2024-01-10")
    assert as_set(one) == [("10/01/2024", "0.05")]
    assert one.schema == RATE_PAYLOAD


def test_only_a_missing_day_is_tolerated(spark, zones):
    missing = rate_source.read_landed_rates(spark, zones.raw_rates, "2024-01-10")
    assert missing.isEmpty() and missing.schema == RATE_PAYLOAD
    with pytest.raises(Exception, match="nosuchscheme"):
        rate_source.read_landed_rates(spark, "nosuchscheme://x", "2024-01-10")


def test_payload_arrays_records_and_bad_text(spark):
    payloads = spark.createDataFrame([
        ('[{"data": "30/04/2024", "valor": "0.040168"}, {"data": "02/05/2024", "valor": "x"}]',),
        ('[{"data": "2024-05-03", "valor": "0.1"}]',), ("[]",), (None,),
    ], "payload string")
    got = {(str(r.data), r.valor) for r in rate_source.normalize_rates(payloads).collect()}
    assert got == {("2024-04-30", 0.040168), ("2024-05-02", None), ("None", 0.1)}
    records = rate_source.rates_from_records(spark, [{"data": "30/04/2024", "valor": "0.04"}])
    assert [tuple(r) for r in records.collect()] == [(dt.date(2024, 4, 30), 0.04)]


def test_one_line_file_with_two_records(spark, zones):
    text = '[{"data": "30/04/2024", "valor": "0.1"}, {"data": "30/04/2024", "valor": "0.2"}]'
    rows = spark.createDataFrame([(dt.date(2024, 4, 30), text)], "date date, payload string")
    rate_source.land_rates(rows, zones.raw_rates)
    landed = rate_source.read_landed_rates(spark, zones.raw_rates, "2024-04-30")
    assert [r.valor for r in landed.orderBy("valor").collect()] == ["0.1", "0.2"]


def test_repeated_rates_never_multiply_rows(spark):
    rates = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 0.1), (dt.date(2024, 1, 1), 0.2), (None, 1.0)], RATES
    )
    assert [tuple(r) for r in rate_source.rate_lookup(rates, "2024-01-01").collect()] == [(0.002,)]


def test_curate_day(spark, zones):
    raw(spark, zones, TX + TX[:1])
    land(spark, zones, {"2024-01-08": "0.04", "2024-01-09": "oops"})
    for day in ("2024-01-08", "2024-01-09", "2024-01-08"):
        curate_day(spark, zones, day, on_duplicate="latest", latest_by=["amount"])
    stored = read_table(spark, zones.transactions, CURATED_TRANSACTIONS)
    assert sorted((r.account_id, str(r.date), float(r.amount)) for r in stored.collect()) == [
        ("a", "2024-01-08", 1000.0), ("a", "2024-01-09", 5.0), ("b", "2024-01-09", 7.0),
    ]
    assert as_set(read_table(spark, zones.rates, RATES)) == [
        (dt.date(2024, 1, 8), 0.04), (dt.date(2024, 1, 9), None),
    ]


def test_movements_of_one_instant_all_stay(spark, zones):
    twice = [("u", "b", "2024-01-09T10:00:00", "5.00"), ("u", "b", "2024-01-09T10:00:00", "7.00")]
    raw(spark, zones, twice)
    curate_day(spark, zones, "2024-01-09")
    stored = read_table(spark, zones.transactions, CURATED_TRANSACTIONS)
    assert sorted(float(r.amount) for r in stored.collect()) == [5.0, 7.0]
    with pytest.raises(Exception, match="several source rows"):
        curate_day(spark, zones, "2024-01-09")


def test_undeclared_columns_and_double_amounts_are_curated(spark, zones):
    rows = tx_frame(spark, [("u", "b", "2024-01-09T10:00:00", "5.25")])
    rows = rows.withColumn("amount", F.col("amount").cast("double")).withColumn("channel", F.lit("app"))
    rows.write.parquet(zones.raw_transactions)
    curate_day(spark, zones, "2024-01-09")
    stored = read_table(spark, zones.transactions).first()
    assert (str(stored.amount), stored.channel) == ("5.25", "app")


def test_redelivered_day_updates_and_adds(spark, zones):
    raw(spark, zones, TX)
    curate_day(spark, zones, "2024-01-09")
    tx_frame(spark, [
        ("u", "b", "2024-01-09T11:00:00", "70.00"), ("u", "c", "2024-01-09T12:00:00", "1.00"),
    ]).write.mode("overwrite").parquet(zones.raw_transactions)
    curate_day(spark, zones, "2024-01-09")
    stored = read_table(spark, zones.transactions, CURATED_TRANSACTIONS)
    assert sorted((r.account_id, float(r.amount)) for r in stored.collect()) == [
        ("a", 5.0), ("b", 70.0), ("c", 1.0),
    ]


def test_day_without_transactions_still_curates_its_rate(spark, zones):
    raw(spark, zones, TX)
    land(spark, zones, {"2024-02-01": "0.04"})
    curate_day(spark, zones, "2024-02-01")
    assert not table_exists(spark, zones.transactions, CURATED_TRANSACTIONS)
    assert as_set(read_table(spark, zones.rates, RATES)) == [(dt.date(2024, 2, 1), 0.04)]


def test_payouts_skip_until_there_is_data(spark, zones):
    payouts_day(spark, zones, "2024-01-09")
    land(spark, zones, {"2024-01-09": "0.04"})
    raw(spark, zones, TX)
    curate_day(spark, zones, "2024-01-10")
    payouts_day(spark, zones, "2024-01-10")
    payouts_range(spark, zones, "2024-01-09", "2024-01-10")
    assert not table_exists(spark, zones.payouts, PAYOUTS)


def test_daily_runs_equal_one_range_run(spark, tmp_path):
    rates = {"2024-01-08": "0.04", "2024-01-09": "0.04", "2024-01-11": "0.05"}
    days = ["2024-01-08", "2024-01-09", "2024-01-10", "2024-01-11"]
    daily, ranged, mixed = (Zones(str(tmp_path / n)) for n in ("daily", "ranged", "mixed"))
    raw(spark, daily, TX)
    land(spark, daily, rates)
    for day in days:
        curate_day(spark, daily, day)
    for zones in (ranged, mixed):
        shutil.copytree(daily.base, zones.base)
    for day in days + days[-1:]:
        payouts_day(spark, daily, day)
    for _ in range(2):
        payouts_range(spark, ranged, days[0], days[-1])
    payouts_day(spark, mixed, days[0])
    payouts_range(spark, mixed, days[1], days[-1])
    want = as_set(read_table(spark, daily.payouts, PAYOUTS))
    assert len(want) == 5
    assert want[0][:7] == ("u", "a", 0.0, 1000.0, 0.0, 0.0, 1000.0)
    assert want[1][:7] == ("u", "a", 1000.0, 5.0, 1000.0, 0.4, 1005.4)
    assert as_set(read_table(spark, ranged.payouts, PAYOUTS)) == want
    assert as_set(read_table(spark, mixed.payouts, PAYOUTS)) == want


def test_run_day_with_and_without_a_rate(spark, zones):
    raw(spark, zones, TX)
    answer = '[{"data": "%s", "valor": "0.04"}]'
    payloads = {"2024-01-08": answer % "08/01/2024", "2024-01-09": answer % "09/01/2024",
                "2024-01-10": "[]", "2024-01-11": None}
    for day, payload in [*payloads.items(), ("2024-01-09", payloads["2024-01-09"])]:
        run_day(spark, zones, day, payload)
    got = [(r[1], r[6], str(r[7])) for r in as_set(read_table(spark, zones.payouts, PAYOUTS))]
    assert got == [
        ("a", 1000.0, "2024-01-08"), ("a", 1005.4, "2024-01-09"), ("b", 7.0, "2024-01-09"),
    ]
    assert read_table(spark, zones.transactions, CURATED_TRANSACTIONS).count() == 4


def test_late_transactions_enter_on_a_rerun(spark, zones):
    raw(spark, zones, TX)
    land(spark, zones, {"2024-01-09": "0.04"})
    for day in ("2024-01-08", "2024-01-09"):
        curate_day(spark, zones, day)
    payouts_day(spark, zones, "2024-01-09")
    raw(spark, zones, [("u", "a", "2024-01-09T20:00:00", "100.00")])
    curate_day(spark, zones, "2024-01-09")
    payouts_day(spark, zones, "2024-01-09")
    got = {r.account_id: r.movimentacao_dia
           for r in read_table(spark, zones.payouts, PAYOUTS).collect()}
    assert got == {"a": 105.0, "b": 7.0}


def test_day_filter_is_pushed_to_the_raw_scan(spark, zones):
    raw(spark, zones, TX)
    day = curate_transactions(read_transactions(spark, zones.raw_transactions), "2024-01-09")
    plan = plan_of(day)
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan


def test_snapshot_prunes_partitions_and_scans_once(spark, zones):
    sinks.write_partitioned(curated_frame(spark, TX), zones.transactions)
    tx = read_table(spark, zones.transactions, CURATED_TRANSACTIONS)
    rows = daily_snapshot(
        tx, rate_frame(spark, {"2024-01-09": 0.04}), empty_table(spark, PAYOUTS), "2024-01-09"
    )
    plan = plan_of(rows)
    assert plan.count("FileScan") == 1
    assert "(date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_partition_dates_keep_their_type(spark, zones):
    raw(spark, zones, TX)
    curate_day(spark, zones, "2024-01-09")
    assert dict(read_table(spark, zones.transactions, CURATED_TRANSACTIONS).dtypes)["date"] == "date"
    assert read_table(spark, zones.transactions).select(F.max("date")).first()[0] == dt.date(2024, 1, 9)
