"""Arriving files end up in the curated table exactly as daily runs leave them."""

from tallybook.plans.curate import curate_day
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS, RATES
from tallybook.sources.tables import read_table
from tallybook.streaming.arrivals import curate_arrivals
from tallybook.streaming.rates import curate_rate_arrivals
from tests.fixtures import as_set, tx_frame

FIRST = [("u", "a", "2024-01-08T10:00:00", "1.00"), ("u", "a", "2024-01-09T10:00:00", "2.00")]
SECOND = [
    ("u", "a", "2024-01-08T10:00:00", "9.00"),
    ("u", "b", "2024-01-10T10:00:00", "3.00"),
    ("u", "b", None, "4.00"),
]


def test_arrivals_equal_daily_runs(spark, tmp_path):
    streamed, daily = Zones(str(tmp_path / "streamed")), Zones(str(tmp_path / "daily"))
    checkpoint = str(tmp_path / "progress")
    for delivery in (FIRST, SECOND, []):
        if delivery:
            tx_frame(spark, delivery).coalesce(1).write.mode("append").parquet(
                streamed.raw_transactions
            )
        curate_arrivals(spark, streamed, checkpoint, max_files=1).awaitTermination()
    for delivery in (FIRST, SECOND):
        tx_frame(spark, delivery).write.mode("overwrite").parquet(daily.raw_transactions)
        for day in ("2024-01-08", "2024-01-09", "2024-01-10"):
            curate_day(spark, daily, day)
    got = as_set(read_table(spark, streamed.transactions, CURATED_TRANSACTIONS))
    assert len(got) == 3
    assert got == as_set(read_table(spark, daily.transactions, CURATED_TRANSACTIONS))


def deliver(spark, zones, rows):
    tx_frame(spark, rows).coalesce(1).write.mode("append").parquet(zones.raw_transactions)


def land(spark, zones, rates):
    rows = [(day, f'[{{"data": "{day[8:]}/{day[5:7]}/{day[:4]}", "valor": "{valor}"}}]') for day, valor in rates]
    spark.createDataFrame(rows, "data string, value string").coalesce(1).write.mode("append").partitionBy("data").text(zones.raw_rates)


def test_results_do_not_depend_on_the_batches(spark, tmp_path):
    """Rows and rates that come again, later or with other values, in batches of one file, of two, and all at once."""
    deliveries = [FIRST, SECOND, FIRST[:1] * 2, [("u", "a", "2024-01-08T10:00:00", "9.00"), ("u", None, "2024-01-08T10:00:00", None)] * 2, SECOND]
    answers = [[("2024-01-08", "0.9"), ("2024-01-09", "0.1")], [("2024-01-08", "0.2"), ("2024-01-10", "x")], [("2024-01-09", "0.3")]]
    found = []
    for max_files, calls in ((1, 5), (2, 1), (None, 1), (None, 5)):
        zones = Zones(str(tmp_path / f"batches-{max_files}-{calls}"))
        for n, rows in enumerate(deliveries):
            deliver(spark, zones, rows)
            if n < len(answers):
                land(spark, zones, answers[n])
            if calls == 5:
                curate_arrivals(spark, zones, f"{zones.base}/seen", max_files, on_duplicate="distinct").awaitTermination()
                curate_rate_arrivals(spark, zones, f"{zones.base}/rates", max_files).awaitTermination()
        if calls == 1:
            curate_arrivals(spark, zones, f"{zones.base}/seen", max_files, on_duplicate="distinct").awaitTermination()
            curate_rate_arrivals(spark, zones, f"{zones.base}/rates", max_files).awaitTermination()
        stored = read_table(spark, zones.transactions, CURATED_TRANSACTIONS).collect()
        rates = as_set(read_table(spark, zones.rates, RATES))
        found.append((sorted(map(repr, stored)), [(str(day), valor) for day, valor in rates]))
    assert len(found[0][0]) == 5
    assert found[0][1] == [("2024-01-08", 0.9), ("2024-01-09", 0.3), ("2024-01-10", None)]
    assert all(f == found[0] for f in found)
