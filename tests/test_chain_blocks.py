"""Blocks of rate days, compiled instead of folded, and the sums over their rows."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tallybook.functions.interest import exact_sum, rounded
from tallybook.operators.chain import BLOCK, snapshot_chain
from tallybook.schemas import MONEY_SCALE
from tests.fixtures import as_set, curated_frame, plan_of, rate_frame

MONDAY = dt.date(2024, 1, 1)


def working_days(weeks, days):
    return {str(MONDAY + dt.timedelta(days=7 * w + d)): 0.04 for w in range(weeks) for d in range(days)}


def test_no_fold_where_islands_fit_a_block(spark):
    tx = curated_frame(spark, [("u", "a", "2024-01-03T10:00:00", "500.00"), ("u", "b", "2024-01-20T10:00:00", "-5.00")])
    plan = plan_of(snapshot_chain(tx, rate_frame(spark, working_days(4, 5))))
    assert "aggregate(" not in plan and "lambda" not in plan


def test_an_account_starts_within_a_block_and_is_carried_over_long_islands(spark):
    tx = curated_frame(spark, [("u", "a", "2024-01-03T10:00:00", "500.00"), (None, "n", "2024-01-02T10:00:00", "9.00")])
    length = 2 * BLOCK + 3
    rates = {str(MONDAY + dt.timedelta(days=n)): 0.04 for n in range(length)}
    got = as_set(snapshot_chain(tx, rate_frame(spark, rates)).where("user_id IS NOT NULL"))
    want, opening = [], 0.0
    for n in range(2, length):
        movement, eligible = (500.0 if n == 2 else 0.0), (opening if opening >= 100 else 0.0)
        closing = round(opening + movement + eligible * (0.04 / 100), 8)
        want.append(("u", "a", opening, movement, eligible, round(eligible * (0.04 / 100), 8), closing, MONDAY + dt.timedelta(days=n)))
        opening = closing
    assert got == sorted(want, key=lambda r: r[2])
    nameless = snapshot_chain(tx, rate_frame(spark, rates)).where("user_id IS NULL")
    assert nameless.agg(F.count("*"), F.max("saldo_final")).first()[:] == (length - 1, 0.0)


def amounts():
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 12) for _ in range(4000)]
    # Halves between two neighbours, and the doubles beside them.
    values += [(2 * rng.randrange(10 ** rng.randint(1, 15)) + 1) / 2e8 for _ in range(4000)]
    values += [float(f"{rng.uniform(-9e6, 9e6):.9f}") for _ in range(4000)]
    return [*values, *[v * (1 + 2.0**-52) for v in values], 0.0, -0.0, -1e-10, 2.0**23, 1e300, float("nan"), float("inf"), float("-inf"), None]


def test_rounded_is_round(spark):
    rows = spark.createDataFrame([(v,) for v in amounts()], "v double")
    got = rows.select("v", rounded(F.col("v")).alias("got"), F.round("v", MONEY_SCALE).alias("want"))
    assert got.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
    assert got.where("v < 0 AND want = 0 AND cast(got AS string) <> cast(want AS string)").isEmpty()


def test_exact_sum_is_the_sum_of_decimals(spark):
    data = [(n % 3, round(v, 8)) for n, v in enumerate(v for v in amounts() if v is not None and abs(v) < 1e15)]
    data += [(3, 8e6 + 0.00000001)] * 2000 + [(3, 9e7 + 0.5), (4, None), (5, None), (5, -0.00000001), (6, 1e16)]
    rows = spark.createDataFrame(data, "k int, v double")
    want = F.sum(F.col("v").cast("decimal(28,8)")).cast("decimal(38,8)")
    got = rows.groupBy("k").agg(exact_sum(F.col("v")).alias("got"), want.alias("want")).collect()
    assert len(got) == 7 and all(str(r["got"]) == str(r["want"]) for r in got)
    assert {r["k"]: r["got"] for r in got}[3] == Decimal("16090000000.50002000")
