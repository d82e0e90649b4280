"""Task balance on skewed transactions: a third on one account, a quarter on one day.

    python -m benchmarks.skew [rows]

Prints the seconds of each job and, per stage, the median and the longest task.
"""

from __future__ import annotations

import datetime as dt
import json
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.chain import snapshot_chain
from tallybook.operators.ledger import ledger
from tallybook.operators.merge import upsert_partitioned
from tallybook.operators.quality import dedup_latest
from tallybook.operators.snapshot import daily_snapshot
from tallybook.schemas import CURATED_TRANSACTIONS, PAYOUTS, TRANSACTION_KEY
from tallybook.session import build_session
from tallybook.sources import sinks
from tallybook.sources.tables import empty_table, read_table

FIRST, DAYS, ACCOUNTS = dt.date(2023, 1, 1), 300, 100_000


def skewed_transactions(spark: SparkSession, rows: int) -> DataFrame:
    def pick(salt: int, n: int):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))

    hot_account, hot_day = F.col("id") % 3 == 0, F.col("id") % 4 == 1
    account = F.when(hot_account, F.lit("hot")).otherwise(
        F.concat(F.lit("a"), pick(0, ACCOUNTS).cast("string"))
    )
    day = F.date_add(F.lit(FIRST), F.when(hot_day, F.lit(100)).otherwise(pick(1, DAYS)).cast("int"))
    time_of_day = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), pick(2, 86_400).cast("decimal(18,6)"))
    return spark.range(rows, numPartitions=32).select(
        F.lit("u").alias("user_id"),
        account.alias("account_id"),
        (day.cast("timestamp") + time_of_day).alias("event_time"),
        ((pick(3, 20_000) - 9_500) / 100).cast("decimal(18,2)").alias("amount"),
        day.alias("date"),
    )


def noop(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def stage_times(log_dir: str) -> dict[tuple[str, int], list[int]]:
    names, times = {}, defaultdict(list)
    for file in Path(log_dir).rglob("events_*"):
        for line in file.read_text().splitlines():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage in event["Stage IDs"]:
                    names.setdefault(stage, event["Properties"].get("spark.jobGroup.id"))
            elif event["Event"] == "SparkListenerTaskEnd":
                info = event["Task Info"]
                stage = event["Stage ID"]
                times[names.get(stage), stage].append(info["Finish Time"] - info["Launch Time"])
    return times


def main(rows: int) -> None:
    base = tempfile.mkdtemp(prefix="tallybook-skew-")
    logs = tempfile.mkdtemp(prefix="tallybook-skew-log-")
    spark = build_session("tallybook-skew", master="local[8]", initial_partitions=64, extra={
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "64",
        "spark.ui.showConsoleProgress": "false",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": logs,
        "spark.eventLog.compress": "false",
        "spark.checkpoint.dir": base,
    })
    spark.sparkContext.setLogLevel("ERROR")
    sinks.write_partitioned(skewed_transactions(spark, rows), f"{base}/tx")
    tx = read_table(spark, f"{base}/tx", CURATED_TRANSACTIONS)
    days = spark.range(DAYS).select(F.date_add(F.lit(FIRST), F.col("id").cast("int")).alias("date"))
    rates = days.where(F.weekday("date") < 5).withColumn("valor", F.lit(0.04))
    redelivered = tx.where(
        F.col("date").between(F.lit(dt.date(2023, 4, 1)), F.lit(dt.date(2023, 4, 20)))
    ).withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    jobs = {
        "ledger": lambda: noop(ledger(tx, rates)),
        "chain": lambda: noop(snapshot_chain(tx, rates)),
        "snapshot": lambda: noop(daily_snapshot(tx, rates, empty_table(spark, PAYOUTS), "2023-07-12")),
        "dedup": lambda: noop(dedup_latest(tx, ["account_id", "date"], ["amount"])),
        "upsert": lambda: upsert_partitioned(
            spark, f"{base}/tx", redelivered, TRANSACTION_KEY, CURATED_TRANSACTIONS
        ),
    }
    for name, job in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        started = time.perf_counter()
        job()
        print(f"{name}: {time.perf_counter() - started:.1f} s")
    spark.stop()
    for (name, stage), times in sorted(stage_times(logs).items(), key=lambda item: item[0][1]):
        if name in jobs and max(times) >= 1000:
            print(f"{name} stage {stage}: {len(times)} tasks, "
                  f"median {statistics.median(times):.0f} ms, longest {max(times)} ms")


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000)
