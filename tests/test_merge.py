"""Upserts: matching, duplicates, NULL keys, evolution, and what they rewrite."""

import datetime as dt
import os
import uuid
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallybook.operators.merge import matched_rows, merge_upsert, upsert_partitioned, upsert_table
from tallybook.operators.quality import dedup_latest, key_quality
from tallybook.schemas import (
    CURATED_TRANSACTIONS,
    RATE_KEY,
    RATES,
    TRANSACTION_KEY,
)
from tallybook.sources import files as folders
from tallybook.sources import sinks
from tallybook.sources.tables import read_table
from tests.fixtures import curated_frame, plan_of, rate_frame

T1, T2, T3 = "2024-01-01T10:00:00", "2024-01-02T10:00:00", "2024-01-03T10:00:00"


def amounts(frame):
    return sorted(
        ((r.account_id, None if r.amount is None else float(r.amount)) for r in frame.collect()),
        key=repr,
    )


def test_update_insert_keep(spark):
    target = curated_frame(spark, [("u", "a", T1, "1.00"), ("u", "b", T1, "2.00")])
    source = curated_frame(spark, [("u", "b", T1, "9.00"), ("u", "b", T2, "3.00")])
    merged = merge_upsert(target, source, TRANSACTION_KEY)
    assert amounts(merged) == [("a", 1.0), ("b", 3.0), ("b", 9.0)]


def test_updates_may_set_null(spark):
    target = curated_frame(spark, [("u", "a", T1, "1.00")])
    source = curated_frame(spark, [("u", "a", T1, None)])
    assert amounts(merge_upsert(target, source, TRANSACTION_KEY)) == [("a", None)]


REPEATED = [("u", "a", T1, "5.00"), ("u", "a", T1, "7.00")]


def test_repeated_source_key(spark):
    target = curated_frame(spark, [("u", "a", T1, "1.00")])
    source = curated_frame(spark, REPEATED)
    with pytest.raises(PySparkException, match="several source rows match one target row"):
        merge_upsert(target, source, TRANSACTION_KEY, on_duplicate="error").collect()
    keep_all = merge_upsert(target, source, TRANSACTION_KEY, on_duplicate="keep_all")
    assert amounts(keep_all) == [("a", 5.0), ("a", 7.0)]
    latest = merge_upsert(
        target, source, TRANSACTION_KEY, on_duplicate="latest", latest_by=["amount"]
    )
    assert amounts(latest) == [("a", 7.0)]


def test_repeated_source_key_without_match_inserts_all(spark):
    target = curated_frame(spark, [("u", "b", T1, "1.00")])
    merged = merge_upsert(target, curated_frame(spark, REPEATED), TRANSACTION_KEY)
    assert amounts(merged) == [("a", 5.0), ("a", 7.0), ("b", 1.0)]


def test_repeated_target_rows_are_all_updated(spark):
    target = curated_frame(spark, REPEATED)
    source = curated_frame(spark, [("u", "a", T1, "2.00")])
    assert amounts(merge_upsert(target, source, TRANSACTION_KEY)) == [("a", 2.0), ("a", 2.0)]


@pytest.mark.parametrize("policy", ["error", "keep_all", "latest"])
def test_null_keys_never_match(spark, policy):
    rows = curated_frame(spark, [("u", None, T1, "1.00"), ("u", "a", T1, "2.00")])
    latest_by = ["amount"] if policy == "latest" else ()
    merged = merge_upsert(rows, rows, TRANSACTION_KEY, on_duplicate=policy, latest_by=latest_by)
    assert amounts(merged) == [("a", 2.0), (None, 1.0), (None, 1.0)]


def test_columns_of_one_side_only(spark):
    target = curated_frame(spark, [("u", "a", T1, "1.00"), ("u", "b", T1, "2.00")])
    extra = curated_frame(spark, [("u", "a", T1, "9.00"), ("u", "c", T1, "3.00")]).withColumn(
        "note", F.lit("new")
    )
    merged = merge_upsert(target, extra, TRANSACTION_KEY)
    assert merged.columns == target.columns + ["note"]
    assert {(r.account_id, r.note) for r in merged.collect()} == {
        ("a", "new"), ("b", None), ("c", "new"),
    }
    lacking = curated_frame(spark, [("u", "a", T1, None), ("u", "c", T1, None)]).drop("amount")
    merged = merge_upsert(target, lacking, TRANSACTION_KEY)
    assert amounts(merged) == [("a", 1.0), ("b", 2.0), ("c", None)]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def files(path, day):
    return sorted(f for f in os.listdir(f"{path}/date={day}") if f.endswith(".parquet"))


def test_partitioned_upsert_rewrites_touched_days_only(spark, path):
    sinks.write_partitioned(
        curated_frame(spark, [("u", "a", T1, "1.00"), ("u", "a", T2, "2.00"), ("u", "a", T3, "3.00")]),
        path,
    )
    untouched = files(path, "2024-01-02")
    source = curated_frame(spark, [("u", "a", T1, "8.00"), ("u", "b", T3, "9.00")])
    for _ in range(2):
        upsert_partitioned(spark, path, source, TRANSACTION_KEY, CURATED_TRANSACTIONS)
        assert amounts(read_table(spark, path, CURATED_TRANSACTIONS)) == [
            ("a", 2.0), ("a", 3.0), ("a", 8.0), ("b", 9.0),
        ]
    assert files(path, "2024-01-02") == untouched


def test_partitioned_upsert_creates_and_adds_days(spark, path):
    for rows in ([("u", "a", T1, "1.00")], [("u", "a", T2, "2.00")]):
        upsert_partitioned(
            spark, path, curated_frame(spark, rows + rows), TRANSACTION_KEY, CURATED_TRANSACTIONS,
            on_duplicate="latest", latest_by=["amount"],
        )
    assert amounts(read_table(spark, path, CURATED_TRANSACTIONS)) == [("a", 1.0), ("a", 2.0)]


def test_the_latest_must_be_told(spark, path):
    rows = curated_frame(spark, [("u", "a", T1, "1.00")])
    with pytest.raises(ValueError, match="latest_by"):
        merge_upsert(rows, rows, TRANSACTION_KEY, on_duplicate="latest")
    with pytest.raises(ValueError, match="latest_by"):
        upsert_partitioned(spark, path, rows, TRANSACTION_KEY, CURATED_TRANSACTIONS, on_duplicate="latest")


def test_upsert_of_nothing(spark, path):
    sinks.write_partitioned(curated_frame(spark, [("u", "a", T1, "1.00")]), path)
    upsert_partitioned(
        spark, path, curated_frame(spark, []), TRANSACTION_KEY, CURATED_TRANSACTIONS
    )
    assert amounts(read_table(spark, path, CURATED_TRANSACTIONS)) == [("a", 1.0)]


def test_rows_outside_the_given_days_are_refused(spark, path):
    sinks.write_partitioned(curated_frame(spark, [("u", "a", T1, "1.00")]), path)
    source = curated_frame(spark, [("u", "b", T1, "2.00"), ("u", "b", T2, "3.00")])
    with pytest.raises(Exception, match="outside the given date partitions"):
        upsert_partitioned(
            spark, path, source, TRANSACTION_KEY, CURATED_TRANSACTIONS,
            days=[dt.date(2024, 1, 1)],
        )
    assert amounts(read_table(spark, path, CURATED_TRANSACTIONS)) == [("a", 1.0)]


def test_undated_rows_survive(spark, path):
    sinks.write_partitioned(
        curated_frame(spark, [("u", "a", None, "1.00"), ("u", "a", T1, "2.00")]), path
    )
    source = curated_frame(spark, [("u", "b", None, "3.00"), ("u", "b", T1, "4.00")])
    upsert_partitioned(spark, path, source, TRANSACTION_KEY, CURATED_TRANSACTIONS)
    assert amounts(read_table(spark, path, CURATED_TRANSACTIONS)) == [
        ("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 4.0),
    ]


def test_evolved_partitions_read_back(spark, path):
    sinks.write_partitioned(curated_frame(spark, [("u", "a", T1, "1.00")]), path)
    source = curated_frame(spark, [("u", "a", T2, "2.00")]).withColumn("note", F.lit("new"))
    sinks.overwrite_partitions(source, path)
    assert {(str(r.date), r.note) for r in read_table(spark, path).collect()} == {
        ("2024-01-01", None), ("2024-01-02", "new"),
    }


def test_upsert_adds_a_column(spark, path):
    sinks.write_partitioned(
        curated_frame(spark, [("u", "a", T1, "1.00"), ("u", "b", T2, "2.00")]), path
    )
    source = curated_frame(spark, [("u", "b", T2, "5.00"), ("u", "c", T2, "6.00")]).withColumn(
        "note", F.lit("new")
    )
    upsert_partitioned(spark, path, source, TRANSACTION_KEY, CURATED_TRANSACTIONS)
    evolved = read_table(spark, path, source.schema)
    assert {(r.account_id, float(r.amount), r.note) for r in evolved.collect()} == {
        ("a", 1.0, None), ("b", 5.0, "new"), ("c", 6.0, "new"),
    }
    # Later rows without the column leave it as it was.
    plain = curated_frame(spark, [("u", "b", T2, "7.00"), ("u", "a", T1, "8.00")])
    upsert_partitioned(spark, path, plain, TRANSACTION_KEY, CURATED_TRANSACTIONS)
    evolved = read_table(spark, path, source.schema)
    assert {(r.account_id, float(r.amount), r.note) for r in evolved.collect()} == {
        ("a", 8.0, None), ("b", 7.0, "new"), ("c", 6.0, "new"),
    }


def test_rate_upsert(spark, path):
    upsert_table(spark, path, rate_frame(spark, {"2024-01-01": 0.1}), RATE_KEY, RATES)
    for _ in range(2):
        upsert_table(
            spark, path, rate_frame(spark, {"2024-01-01": 0.2, "2024-01-02": 0.3}), RATE_KEY, RATES
        )
    got = {(str(r.date), r.valor) for r in read_table(spark, path, RATES).collect()}
    assert got == {("2024-01-01", 0.2), ("2024-01-02", 0.3)}


def test_quality_counts(spark):
    rows = curated_frame(
        spark, REPEATED + [("u", None, T1, "1.00"), ("u", None, T1, "1.00"), ("u", "b", T1, "1.00")]
    )
    assert tuple(key_quality(rows, TRANSACTION_KEY).first()) == (5, 2, 1, 1)
    assert tuple(key_quality(rows.limit(0), TRANSACTION_KEY).first()) == (0, 0, 0, 0)


def test_dedup_keeps_latest_and_all_null_keys(spark):
    rows = curated_frame(
        spark, REPEATED + [("u", None, T1, "1.00"), ("u", None, T1, "1.00")]
    )
    kept = dedup_latest(rows, TRANSACTION_KEY, ["amount"])
    assert amounts(kept) == [("a", 7.0), (None, 1.0), (None, 1.0)]


def test_one_key_with_a_third_of_all_rows(spark):
    """A hot key, a hot day and hot NULL keys: counted exactly, no group collected."""
    n = 30000
    base = spark.range(n).select(
        F.lit("u").alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("a"), F.col("id")))
        .alias("account_id"),
        F.lit(dt.datetime(2024, 1, 1, 10)).alias("event_time"),
        (F.col("id") % 1000).cast("decimal(18,2)").alias("amount"),
        F.lit(dt.date(2024, 1, 1)).alias("date"),
    )
    target = base.where(F.col("account_id") != "hot")
    merged = merge_upsert(
        target, base, TRANSACTION_KEY, on_duplicate="latest", latest_by=["amount"]
    )
    counted = merged.groupBy(F.coalesce("account_id", F.lit("none")).alias("a")).agg(
        F.count(F.lit(1)).alias("n"), F.max("amount").alias("top")
    )
    hot = counted.where("a = 'hot'").first()
    assert (hot.n, hot.top) == (1, Decimal("999.00"))
    assert counted.where("a = 'none'").count() == 1
    assert counted.where("a = 'none'").first().n == n // 3
    assert merged.count() == 1 + n // 3 + n // 3


@pytest.mark.parametrize("columns", [[], ["note"]])
def test_replace_can_be_repeated(spark, columns):
    target = curated_frame(spark, [("u", "a", T1, "1.00"), ("u", "b", T1, "3.00"), ("u", None, T1, "4.00")])
    for name in columns:
        target = target.withColumn(name, F.lit("kept"))
    source = curated_frame(spark, REPEATED)
    once = merge_upsert(target, source, TRANSACTION_KEY, on_duplicate="replace")
    twice = merge_upsert(once, source, TRANSACTION_KEY, on_duplicate="replace")
    assert amounts(once) == amounts(twice) == [("a", 5.0), ("a", 7.0), ("b", 3.0), (None, 4.0)]
    for name in columns:
        assert [r[name] for r in twice.collect()] == ["kept"] * 4


def test_one_scan_and_one_shuffle_of_the_target(spark, path):
    rows = [("u", f"a{i}", T1, "1.00") for i in range(50)]
    sinks.write_partitioned(curated_frame(spark, rows), path)
    target = read_table(spark, path, CURATED_TRANSACTIONS)
    source = curated_frame(spark, rows[:20])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for policy in ("error", "keep_all", "replace"):
            plan = plan_of(matched_rows(target, source, TRANSACTION_KEY, on_duplicate=policy))
            assert plan.count("FileScan") == 1 and plan.count("SortMergeJoin") == 1
            assert plan.count("Exchange") == 2  # one of the target, one of the source
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_a_key_are_spread(spark):
    rows = curated_frame(spark, [("u", None, T1, f"{i}.00") for i in range(1000)])
    source = curated_frame(spark, [("u", "a", T1, "2.00")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = matched_rows(rows, source, TRANSACTION_KEY).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 1000 and max(sizes) < 400


def test_a_hot_key_is_split_over_tasks(spark):
    """A key with a third of the target: adaptive execution splits its side of the left join."""
    hot = spark.range(120_000).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS account_id", "TIMESTAMP '2024-01-01 10:00:00' AS event_time", "id", "repeat('x', 50) AS pad"
    )
    source = hot.where("id < 30").selectExpr("account_id", "event_time", "-id AS id").dropDuplicates(["account_id"])
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        joined = matched_rows(hot.repartition(8), source, TRANSACTION_KEY, on_duplicate="keep_all")
        by_task = joined.groupBy(F.spark_partition_id().alias("task"))
        sizes = [r["count"] for r in by_task.agg(F.count(F.when(F.col("account_id") == "hot", 1)).alias("count")).collect()]
    finally:
        for name in changed:
            spark.conf.unset(name)
    assert sum(sizes) == 40_000 and max(sizes) < 30_000


def _stops_at(monkeypatch, name, call):
    """Let the given call of a file operation fail, as if the driver had died there."""
    real, calls = getattr(folders, name), []

    def failing(*args):
        calls.append(args)
        if len(calls) == call:
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(folders, name, failing)


@pytest.mark.parametrize(("operation", "call", "new"), [("rename", 1, False), ("rename", 2, True), ("remove", 1, False), ("remove", 2, True)])
def test_a_replacement_that_is_cut_off_loses_nothing(spark, path, monkeypatch, operation, call, new):
    old, revised = {"2024-01-01": 0.1, "2024-01-02": 0.2}, {"2024-01-02": 0.9}
    sinks.write_table(rate_frame(spark, old), path)
    with monkeypatch.context() as patched:
        _stops_at(patched, operation, call)
        with pytest.raises(OSError, match="lost"):
            upsert_table(spark, path, rate_frame(spark, revised), RATE_KEY, RATES)
    sinks.settle_table(spark, path)
    want = {**old, **revised} if new else old
    assert {str(d): v for d, v in read_table(spark, path, RATES).collect()} == want
    upsert_table(spark, path, rate_frame(spark, {"2024-01-03": 0.3}), RATE_KEY, RATES)
    assert {str(d): v for d, v in read_table(spark, path, RATES).collect()} == {**want, "2024-01-03": 0.3}
    assert not os.path.exists(f"{path}.next") and not os.path.exists(f"{path}.former")


def test_a_write_that_fails_leaves_the_old_rates(spark, path):
    sinks.write_table(rate_frame(spark, {"2024-01-01": 0.1}), path)
    bad = rate_frame(spark, {"2024-01-02": 0.2}).withColumn("valor", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(PySparkException, match="lost"):
        sinks.rewrite_table(bad, path)
    sinks.settle_table(spark, path)
    assert read_table(spark, path, RATES).collect() == [(dt.date(2024, 1, 1), 0.1)]


def test_upserts_leave_no_scratch_behind(spark, path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    for amount in ("1.00", "2.00"):
        upsert_partitioned(
            spark, path, curated_frame(spark, [("u", "a", T1, amount)]), TRANSACTION_KEY, CURATED_TRANSACTIONS, materialize=True
        )
    assert amounts(read_table(spark, path, CURATED_TRANSACTIONS)) == [("a", 2.0)]
    assert set(os.listdir(root)) == before
