"""Daily balance and interest of every account, for one business date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.interest import (
    as_date,
    closing_balance,
    daily_interest,
    eligible_balance,
    opening_balance,
)
from tallybook.functions.keys import all_present, event_day
from tallybook.operators.balances import previous_closing
from tallybook.schemas import ACCOUNT_KEY, MINIMUM_BALANCE, PAYOUTS
from tallybook.sources.rates import rate_lookup


def payout_columns(
    opening: Column, movement: Column, interest: Column, closing: Column, day: Column, minimum: float
) -> list[Column]:
    """The payout row of one account and day."""
    return [
        *[F.col(c) for c in ACCOUNT_KEY],
        opening.alias("saldo_a_mais_24_horas"),
        movement.alias("movimentacao_dia"),
        eligible_balance(opening, minimum).alias("saldo_elegivel"),
        interest.alias("juros_calculado"),
        closing.alias("saldo_final"),
        day.alias("date"),
    ]


def account_totals(tx: DataFrame, business_date: dt.date) -> DataFrame:
    """History and movement of every account known by the day, in one pass and one shuffle.

    ``history`` is NULL for accounts without earlier rows. Accounts with a NULL id stay in
    the base but match no sums, as an equality join would have it.
    """
    day = event_day(tx)
    today = F.lit(business_date)
    earlier = day < today
    known = all_present(ACCOUNT_KEY)
    sums = (
        tx.where(day <= today)
        .groupBy(*ACCOUNT_KEY)
        .agg(
            F.bool_or(earlier).alias("has_history"),
            F.sum(F.when(earlier, F.col("amount"))).alias("earlier_sum"),
            F.sum(F.when(~earlier, F.col("amount"))).alias("today_sum"),
        )
    )
    return sums.select(
        *ACCOUNT_KEY,
        F.when(
            known & F.col("has_history"),
            F.coalesce(F.col("earlier_sum").cast("double"), F.lit(0.0)),
        ).alias("history"),
        F.coalesce(F.when(known, F.col("today_sum").cast("double")), F.lit(0.0)).alias("movement"),
    )


def daily_snapshot(
    tx: DataFrame,
    rates: DataFrame,
    previous: DataFrame,
    business_date: str | dt.date,
    *,
    minimum: float = MINIMUM_BALANCE,
) -> DataFrame:
    """Payout rows of one day; no rows when the day has no rate.

    ``previous`` holds earlier payouts (possibly none): only those of the day before count.
    """
    today = as_date(business_date)
    priced = (
        account_totals(tx, today)
        .join(previous_closing(previous, today), ACCOUNT_KEY, "left")
        # At most one row: the rate of this day.
        .crossJoin(F.broadcast(rate_lookup(rates, today)))
        .withColumn("opening", opening_balance(F.col("prev_saldo_final"), F.col("history")))
    )
    opening, movement, rate = F.col("opening"), F.col("movement"), F.col("rate")
    interest = daily_interest(opening, rate, minimum)
    closing = closing_balance(opening, movement, rate, minimum)
    rows = priced.select(
        *payout_columns(opening, movement, interest, closing, F.lit(today), minimum)
    )
    return rows.select(*PAYOUTS.fieldNames())
