"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores. BENCH_LOOPS=1 also times the
day-by-day forms of the same results, for comparison.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry.queries import QUERIES  # noqa: E402
from tallybook.session import build_session  # noqa: E402

HEADLINE = [
    "ledger", "snapshot_chain", "merge_transactions", "daily_snapshot", "activity_with_rate",
    "ledger_orders", "snapshot_chain_orders", "curate_day", "payouts_of_days",
    "merge_payouts", "dedup_latest", "tx_quality",
]


def seconds(run, spark, sf_dir, runs: int = 2) -> float:
    """Best of a few runs, so that compiling a plan for the first time does not count."""
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tallybook-bench",
        master=f"local[{cpus}]",
        initial_partitions=int(cpus),
        extra={
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallybook-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {name: seconds(QUERIES[name], spark, sf_dir) for name in HEADLINE}
    line = {
        "metric": "headline queries, total",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if os.environ.get("BENCH_LOOPS") == "1":
        from benchmarks.loops import LOOPS

        line["day_by_day"] = {name: seconds(run, spark, sf_dir) for name, run in LOOPS.items()}
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
