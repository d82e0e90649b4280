"""Deliveries of the streamed query are written and read by several tasks."""

import datetime as dt
import glob
import os

from registry.queries import QUERIES

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def test_deliveries_are_not_written_by_one_task(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, 9, tzinfo=dt.timezone.utc)
    rows = [(n, start + dt.timedelta(days=n % 30, seconds=n % 7), n % 5, "view", float(n % 3), None) for n in range(240)]
    rows += rows[:40] + [(500, start, None, "view", None, None)] * 2
    spark.createDataFrame(rows, EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(glob.glob(f"{root}/tallybook-stream-*"))
    got = QUERIES["stream_in_batches"](spark, str(tmp_path)).collect()
    (zone,) = set(glob.glob(f"{root}/tallybook-stream-*")) - before
    raw = [f for f in glob.glob(f"{zone}/**/*.parquet", recursive=True) if f"{os.sep}raw{os.sep}" in f]
    assert len(raw) == 2 * spark.sparkContext.defaultParallelism
    want = {
        (None if u is None else str(u), None if u is None else str(u * 10 + n % 2), f"{t:%Y-%m-%d %H:%M:%S.%f}", v)
        for n, t, u, _, v, _ in rows
    }
    assert len(got) == len(want)
    assert {(r["user_id"], r["account_id"], r["event_time"], r["amount"]) for r in got} == want
