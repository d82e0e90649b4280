"""Daily snapshots of a whole range of days at once."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.interest import accrued, as_date, closing_balance, rate_fraction, rounded, unrounded_closing
from tallybook.functions.keys import all_present, event_day
from tallybook.operators.snapshot import payout_columns
from tallybook.schemas import ACCOUNT_KEY, MINIMUM_BALANCE, PAYOUTS
from tallybook.sources.rates import unique_rates

# Rate days of one block: the folding of a block is written out day by day, so this bounds the plan.
BLOCK = 8


def rate_calendar(rates: DataFrame) -> DataFrame:
    """Rate days in order: ``idx, rate_day, before, rate, reopens``.

    ``before`` is the rate day before this one. Consecutive days form an island: inside one
    the closing balance is carried, its first day ``reopens`` from raw sums.
    One row per day with a rate, so the calendar bounds it.
    """
    before = F.when(F.col("pos") > 0, F.col("days")[F.col("pos") - 1]["date"])
    ordered = unique_rates(rates).agg(
        F.sort_array(F.collect_list(F.struct("date", "valor"))).alias("days")
    )
    return (
        ordered.select("days", F.posexplode("days"))
        .select(
            F.col("pos").alias("idx"),
            F.col("col.date").alias("rate_day"),
            before.alias("before"),
            rate_fraction(F.col("col.valor")).alias("rate"),
            (before.isNull() | (F.date_add(before, 1) < F.col("col.date"))).alias("reopens"),
        )
    )


@dataclass(frozen=True)
class Blocks:
    """The calendar in blocks of consecutive rate days, at most ``BLOCK`` each and of one island.

    ``days``: one row a rate day, ``block, pos, rate_day, before``. ``blocks``: one row a block, ``block, reopens`` and
    its ``rate_days`` and ``rates``, NULL behind its last day. ``longest`` is the days of the longest block; ``carries``
    says whether a block starts within an island. At most one row per calendar day comes to the driver for it.
    """

    days: DataFrame
    blocks: DataFrame
    first: dt.date | None
    last: dt.date | None
    count: int
    longest: int
    carries: bool


def calendar_blocks(calendar: DataFrame) -> Blocks:
    blocks: list[list] = []
    for day in calendar.orderBy("idx").collect():
        if day["reopens"] or len(blocks[-1]) == BLOCK:
            blocks.append([])
        blocks[-1].append(day)
    longest = max(map(len, blocks), default=1)
    pad = [[None] * (longest - len(block)) for block in blocks]
    days = [(n, pos, day["rate_day"], day["before"]) for n, block in enumerate(blocks) for pos, day in enumerate(block)]
    rows = [
        (n, block[0]["reopens"], [d["rate_day"] for d in block] + rest, [d["rate"] for d in block] + rest)
        for n, (block, rest) in enumerate(zip(blocks, pad, strict=True))
    ]
    spark = calendar.sparkSession
    return Blocks(
        spark.createDataFrame(days, "block int, pos int, rate_day date, before date"),
        spark.createDataFrame(rows, "block int, reopens boolean, rate_days array<date>, rates array<double>"),
        blocks[0][0]["rate_day"] if blocks else None, blocks[-1][-1]["rate_day"] if blocks else None,
        len(blocks), longest, not all(block[0]["reopens"] for block in blocks),
    )


def payout_slots(calendar: Blocks) -> DataFrame:
    """Every calendar day with the block and the rate day that first sees its movements."""
    since = F.coalesce(F.date_add("before", 1), F.col("rate_day"))
    return calendar.days.select(
        F.explode(F.sequence(since, F.col("rate_day"))).alias("day"), "block", "pos", "rate_day"
    )


def snapshot_chain(
    tx: DataFrame,
    rates: DataFrame,
    *,
    previous: DataFrame | None = None,
    from_date: str | dt.date | None = None,
    to_date: str | dt.date | None = None,
    minimum: float = MINIMUM_BALANCE,
) -> DataFrame:
    """The rows ``daily_snapshot`` gives when run for each day, every run reading the last.

    Equal to that loop as long as no transaction arrives after its day was processed.
    ``previous`` supplies payouts from before the range. Two shuffles whatever the number
    of days: sums per account and block of rate days, then one ordering per account.
    """
    if from_date is not None:
        rates = rates.where(F.col("date") >= F.lit(as_date(from_date)))
    if to_date is not None:
        rates = rates.where(F.col("date") <= F.lit(as_date(to_date)))
    calendar = calendar_blocks(rate_calendar(rates))
    spans = account_spans(account_sums(tx, calendar), calendar)
    if previous is not None:
        spans = continue_from(spans, calendar, previous)
    opened = opened_blocks(spans, calendar)
    if calendar.carries:
        opened = carried_blocks(opened, minimum)
    return payout_rows(opened, calendar, minimum)


def account_sums(tx: DataFrame, calendar: Blocks) -> DataFrame:
    """Movements summed per account and block.

    ``on_N`` fell on the Nth rate day of the block, ``off_day`` between its first one and the rate day before;
    ``skip`` rate days of the block come before the first with any.
    """
    day = event_day(tx)
    # NULL ids stay in the account base, but no sum ever matches them.
    amount = F.when(all_present(ACCOUNT_KEY), F.col("amount"))
    placed = (
        tx.where(day <= F.lit(calendar.last).cast("date"))
        .select(
            *ACCOUNT_KEY,
            day.alias("tx_day"),
            F.greatest(day, F.lit(calendar.first).cast("date")).alias("day"),
            amount.alias("amount"),
        )
        .join(F.broadcast(payout_slots(calendar)), "day")
    )
    on_day = F.col("tx_day") == F.col("rate_day")

    def summed(where: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("amount"))), F.lit(0)).alias(name)

    return placed.groupBy(*ACCOUNT_KEY, "block").agg(
        *[summed(on_day & (F.col("pos") == n), f"on_{n}") for n in range(calendar.longest)],
        summed(~on_day, "off_day"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total"),
        F.min("pos").alias("skip"),
    )


def account_spans(sums: DataFrame, calendar: Blocks) -> DataFrame:
    """Runs of blocks in which only the first, ``start``, may have movements; a run lasts until the account's next sums.

    ``opening`` is the raw sum before the first day of the run, ``later`` the one before its other blocks. ``skip``
    days come before the account's first.
    """
    w = Window.partitionBy(*ACCOUNT_KEY).orderBy("block")
    earlier = F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, -1))
    following = F.coalesce(F.lead("block").over(w), F.lit(calendar.count))
    first = F.lag("block").over(w).isNull()
    whole = sums.select(
        "*",
        F.coalesce(earlier, F.lit(0)).alias("history"),
        (following - 1).alias("last"),
        F.when(first, F.col("skip")).otherwise(0).alias("unseen"),
    )
    return whole.select(
        *ACCOUNT_KEY,
        F.col("block").alias("start"),
        "last",
        F.col("unseen").alias("skip"),
        (F.col("history") + F.col("off_day")).cast("double").alias("opening"),
        (F.col("history") + F.col("total")).cast("double").alias("later"),
        *[F.col(f"on_{n}").cast("double").alias(f"on_{n}") for n in range(calendar.longest)],
    )


def continue_from(spans: DataFrame, calendar: Blocks, previous: DataFrame) -> DataFrame:
    """Open the first rate day from the payouts of the day before it, where there are any."""
    first_day = F.lit(calendar.first).cast("date")
    before = previous.where(F.col("date") == F.date_sub(first_day, 1)).select(
        *ACCOUNT_KEY, F.col("saldo_final").alias("carried")
    )
    carried = F.when((F.col("start") == 0) & (F.col("skip") == 0), F.col("carried"))
    return (
        spans.join(before, ACCOUNT_KEY, "left")
        .withColumn("opening", F.coalesce(carried, F.col("opening")))
        .drop("carried")
    )


def opened_blocks(spans: DataFrame, calendar: Blocks) -> DataFrame:
    """Every block of every span, with its rates, movements and the raw sum it opens from if it ``reopens``."""
    own = F.col("block") == F.col("start")
    return (
        spans
        .withColumn("block", F.explode(F.sequence("start", "last")))
        .select(
            *ACCOUNT_KEY,
            "block",
            F.when(own, F.col("skip")).otherwise(0).alias("skip"),
            F.when(own, F.col("opening")).otherwise(F.col("later")).alias("opening"),
            *[F.when(own, F.col(f"on_{n}")).otherwise(F.lit(0.0)).alias(f"on_{n}") for n in range(calendar.longest)],
        )
        .join(F.broadcast(calendar.blocks), "block")
    )


def carried_blocks(opened: DataFrame, minimum: float) -> DataFrame:
    """Open blocks that start within an island from the closing balance before them.

    Only needed where islands are longer than a block. Gathers one row per account: its elements are blocks, which
    the calendar bounds however many transactions the account has. The window's partitioning already fits. Only the
    balance after each block is kept here; blocks are told their days' balances as all others are.
    """
    others = [c for c in opened.columns if c not in (*ACCOUNT_KEY, "block")]
    movements = sorted((c for c in others if c.startswith("on_")), key=lambda c: int(c[3:]))
    per_account = opened.groupBy(*ACCOUNT_KEY).agg(
        F.sort_array(F.collect_list(F.struct("block", *others))).alias("blocks")
    )

    def fold_block(done: Column, block: Column) -> Column:
        def add(balance: Column, day: Column) -> Column:
            return F.when(day["rate"].isNull(), balance).otherwise(
                closing_balance(balance, day["movement"], day["rate"], minimum)
            )

        opening = F.when(block["reopens"], block["opening"]).otherwise(F.element_at(done, -1))
        days = F.arrays_zip(block["rates"].alias("rate"), F.array(*[block[c] for c in movements]).alias("movement"))
        return F.array_append(done, F.aggregate(days, opening, add))

    closings = F.aggregate("blocks", F.array(F.lit(0.0)), fold_block)
    return (
        per_account
        .select(*ACCOUNT_KEY, "blocks", F.slice(closings, 1, F.size("blocks")).alias("carried"))
        .select(*ACCOUNT_KEY, F.inline(F.arrays_zip("blocks", "carried")))
        .select(*ACCOUNT_KEY, "blocks.*", "carried")
        .withColumn("opening", F.when(F.col("reopens"), F.col("opening")).otherwise(F.col("carried")))
        .drop("carried")
    )


def payout_rows(opened: DataFrame, calendar: Blocks, minimum: float) -> DataFrame:
    """Fold every block from its opening, spread it over its days and compute the payout columns.

    The days are written out one after the other rather than folded by ``F.aggregate``: Spark compiles that, and
    interprets a fold.
    """
    opening, folded, days = F.col("opening"), opened, []
    for n in range(calendar.longest):
        movement, rate = F.col(f"on_{n}"), F.col("rates")[n]
        folded = (
            folded
            .withColumn("raw", unrounded_closing(opening, movement, rate, minimum))
            .withColumn(f"closing_{n}", rounded(F.col("raw")))
            .drop("raw")
        )
        closing = F.col(f"closing_{n}")
        days.append(F.struct(
            F.lit(n).alias("pos"), F.col("rate_days")[n].alias("rate_day"), rate.alias("rate"),
            opening.alias("opening"), movement.alias("movement"), closing.alias("closing"),
        ))
        opening = closing
    priced = (
        folded
        .select(*ACCOUNT_KEY, "skip", F.inline(F.array(*days)))
        .where((F.col("pos") >= F.col("skip")) & F.col("rate_day").isNotNull())
        .withColumn("accrued", accrued(F.col("opening"), F.col("rate"), minimum))
    )
    rows = priced.select(*payout_columns(
        F.col("opening"), F.col("movement"), rounded(F.col("accrued")), F.col("closing"),
        F.col("rate_day"), minimum,
    ))
    return rows.select(*PAYOUTS.fieldNames())
