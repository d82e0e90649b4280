"""The manifest of raw files, and curation of ranges through it."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tallybook.plans.curate import curate_day, curate_range
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS, RATES
from tallybook.sources import manifest as m
from tallybook.sources import rates as rate_source
from tallybook.sources.tables import read_table
from tests.fixtures import as_set, plan_of, tx_frame


@pytest.fixture
def zones(tmp_path):
    return Zones(str(tmp_path / "a zone + more"))


def deliver(spark, zones, rows, change=lambda frame: frame):
    change(tx_frame(spark, rows)).coalesce(1).write.mode("append").parquet(zones.raw_transactions)


def rows_of(days, seed=1, n=12):
    draw = random.Random(seed)
    return [("u", draw.choice("abc"), f"2024-01-{draw.choice(days):02d}T10:{seed:02d}:{i:02d}", f"{i}.25") for i in range(n)]


def files_of(spark, zones):
    return m.refresh_manifest(spark, zones.raw_transactions, zones.manifest)


def test_days_rows_and_undated_rows_of_each_file(spark, zones):
    assert files_of(spark, zones).isEmpty()
    deliver(spark, zones, [("u", "a", "2024-01-03T00:00:00", "1.00"), ("u", "a", "2024-01-05T23:59:59", "1.00"), ("u", "a", None, "1.00")])
    deliver(spark, zones, [])
    deliver(spark, zones, [("u", "b", "2024-01-09T12:00:00", None)])
    found = {(str(r.first_day), str(r.last_day), r.rows, r.undated) for r in files_of(spark, zones).collect()}
    assert found == {("2024-01-03", "2024-01-05", 3, 1), ("2024-01-09", "2024-01-09", 1, 0), ("None", "None", 0, 0)}


def test_old_files_are_not_opened_again(spark, zones, monkeypatch):
    opened = []
    real = m.file_groups

    def recording(session, paths):
        opened.append(len(paths))
        return real(session, paths)

    monkeypatch.setattr(m, "file_groups", recording)
    for n in range(3):
        deliver(spark, zones, rows_of([n + 1], seed=n))
        files_of(spark, zones)
    files_of(spark, zones)
    assert opened == [1, 1, 1]
    assert files_of(spark, zones).count() == 3


def test_changed_and_removed_files(spark, zones):
    deliver(spark, zones, rows_of([1]))
    deliver(spark, zones, rows_of([2], seed=2))
    first, second = sorted(files_of(spark, zones).collect(), key=lambda r: r.first_day)
    os.remove(second.path.removeprefix("file:"))
    tx_frame(spark, rows_of([7])).coalesce(1).write.mode("overwrite").parquet(f"{zones.base}/other")
    (other,) = [f for f in os.listdir(f"{zones.base}/other") if f.endswith(".parquet")]
    target = first.path.removeprefix("file:")
    os.replace(f"{zones.base}/other/{other}", target)
    os.remove(f"{os.path.dirname(target)}/.{os.path.basename(target)}.crc")
    (left,) = files_of(spark, zones).collect()
    assert (left.path, str(left.first_day)) == (first.path, "2024-01-07")


def test_only_files_of_the_days_are_read_in_one_scan(spark, zones):
    for n in range(1, 6):
        deliver(spark, zones, rows_of([2 * n, 2 * n + 1], seed=n))
    groups = m.files_of_days(files_of(spark, zones), dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    rows = m.read_groups(spark, groups)
    assert len(rows.inputFiles()) == 2
    plan = plan_of(rows.where(F.to_date("event_time") == F.lit(dt.date(2024, 1, 5))))
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(event_time" in plan


@pytest.mark.parametrize("policy", [{"on_duplicate": "replace"}, {"on_duplicate": "latest", "latest_by": ["amount"]}])
def test_a_range_equals_its_days(spark, tmp_path, policy):
    daily, ranged = Zones(str(tmp_path / "daily")), Zones(str(tmp_path / "ranged"))
    for zones in (daily, ranged):
        for n in range(3):
            deliver(spark, zones, rows_of(range(1, 12), seed=n, n=30) + [("u", "a", "2024-01-04T10:00:00", f"{n}.00")])
        landed = [(dt.date(2024, 1, d), f'[{{"data": "{d:02d}/01/2024", "valor": "0.{d}"}}]') for d in (3, 4, 5, 9)]
        rate_source.land_rates(spark.createDataFrame(landed, "date date, payload string"), zones.raw_rates)
    for day in range(3, 9):
        curate_day(spark, daily, dt.date(2024, 1, day), **policy)
    for _ in range(2):
        curate_range(spark, ranged, "2024-01-03", "2024-01-08", **policy)
    for table, schema in (("transactions", CURATED_TRANSACTIONS), ("rates", RATES)):
        got = as_set(read_table(spark, getattr(ranged, table), schema))
        assert got and got == as_set(read_table(spark, getattr(daily, table), schema))


def test_files_of_different_types_are_one_relation(spark, zones):
    deliver(spark, zones, [("u", "a", "2024-01-03T10:00:00", "1.25")])
    deliver(spark, zones, [("u", "b", "2024-01-03T10:00:00", "2.50")], lambda f: f.withColumn("amount", F.col("amount").cast("double")).withColumn("code", F.lit(7)))
    deliver(spark, zones, [("u", "c", "2024-01-03T10:00:00", "3.75")], lambda f: f.withColumn("amount", F.col("amount").cast("string")).withColumn("code", F.lit("x")))
    want = [("a", "1.25", None), ("b", "2.50", "7"), ("c", "3.75", "x")]
    curate_range(spark, zones, "2024-01-01", "2024-01-05")
    stored = read_table(spark, zones.transactions)
    assert sorted((r.account_id, str(r.amount), r.code) for r in stored.collect()) == want
    directory = m.read_transactions(spark, zones.raw_transactions)
    assert sorted((r.account_id, str(r.amount), r.code) for r in directory.collect()) == want


def test_days_and_rates_without_data(spark, zones):
    curate_range(spark, zones, "2024-01-01", "2024-01-31")
    deliver(spark, zones, rows_of([2]))
    curate_range(spark, zones, "2024-02-01", "2024-02-28")
    assert not os.path.exists(zones.transactions) and not os.path.exists(zones.rates)
