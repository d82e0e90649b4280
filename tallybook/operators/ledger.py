"""Ledger over active days with the 24-hour rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.interest import held_interest, held_rate
from tallybook.functions.running import running_openings
from tallybook.operators.activity import (
    activity_between,
    activity_lag,
    activity_with_rate,
    daily_activity,
    only_accounts,
)
from tallybook.schemas import (
    ACCOUNT_KEY,
    HELD_HOURS,
    LEDGER_COLUMNS,
    LEDGER_REPORT_COLUMNS,
    LEDGER_STATE,
    MINIMUM_BALANCE,
)

_MOVEMENT = LEDGER_STATE["movimentacao_dia"].dataType


def ledger(
    tx: DataFrame,
    rates: DataFrame,
    *,
    accounts: DataFrame | Sequence[str] | None = None,
    from_date: str | dt.date | None = None,
    to_date: str | dt.date | None = None,
    minimum: float = MINIMUM_BALANCE,
    held_hours: float = HELD_HOURS,
) -> DataFrame:
    """One row per account and active day, each account carrying its own balance.

    The balance starts at zero on the first day in range. It earns the day's rate when it
    is above ``minimum`` and the previous active day ended more than ``held_hours`` ago.
    """
    active = activity_between(
        activity_lag(daily_activity(only_accounts(tx, accounts))), from_date, to_date
    )
    return running_ledger(activity_with_rate(active, rates), minimum, held_hours)


def continue_ledger(
    tx: DataFrame,
    rates: DataFrame,
    state: DataFrame,
    *,
    minimum: float = MINIMUM_BALANCE,
    held_hours: float = HELD_HOURS,
) -> DataFrame:
    """Ledger rows of movements that come after the days ``state`` has seen.

    ``state`` is that of ``ledger_state``: each account goes on from its balance, with its last active day for
    the look-back, as if all days had been folded at once. Accounts without a state start at zero.
    """
    stored = state.select(
        *ACCOUNT_KEY, "event_date", "movimentacao_dia", "event_time", F.col("balance").alias("stored_balance")
    )
    # An account's state is its first element: it sets the balance, and gives no row.
    known = daily_activity(tx).unionByName(stored, allowMissingColumns=True)
    active = activity_between(activity_lag(known))
    return running_ledger(activity_with_rate(active, rates), minimum, held_hours)


def ledger_state(rows: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Where each account stands after ledger rows: its last active day, and the balance after it.

    Accounts without new rows keep the former state. The greatest day is taken by a combinable maximum.
    """
    last = rows.select(
        *ACCOUNT_KEY, "event_date", F.col("movimentacao_dia").cast(_MOVEMENT).alias("movimentacao_dia"), "event_time",
        F.col("total").alias("balance"),
    )
    if state is not None:
        last = state.select(*last.columns).unionByName(last)
    stand = [c for c in last.columns if c not in ACCOUNT_KEY]
    kept = last.groupBy(*ACCOUNT_KEY).agg(F.max(F.struct(*stand)).alias("kept"))
    return kept.select(*ACCOUNT_KEY, "kept.*")


def running_ledger(
    active: DataFrame, minimum: float = MINIMUM_BALANCE, held_hours: float = HELD_HOURS
) -> DataFrame:
    """Carry the balance over the rows of ``activity_with_rate``.

    An account's array has one element per active day, so the calendar bounds it however
    many transactions the account has. The rows still have the look-back's partitioning
    by account, so collecting them needs no further shuffle. Rows with a ``stored_balance`` only set the balance.
    """
    stored = F.col("stored_balance") if "stored_balance" in active.columns else F.lit(None)
    day = F.struct(
        "event_date", "saldo_dia_anterior", "movimentacao_dia", "horario_saldo_elegivel",
        "event_time", "valor_cdi",
        stored.cast("double").alias("stored"),
        F.col("movimentacao_dia").cast("double").alias("movement"),
        held_rate(
            F.col("valor_cdi"), F.col("event_time"), F.col("horario_saldo_elegivel"), held_hours
        ).alias("rate"),
    )
    per_account = active.groupBy(*ACCOUNT_KEY).agg(
        F.sort_array(F.collect_list(day)).alias("days")
    )
    opening = running_openings(
        F.col("days"),
        F.lit(0.0),
        lambda balance, d: F.coalesce(
            d["stored"], balance + d["movement"] + held_interest(balance, d["rate"], minimum)
        ),
    )
    carried = F.col("saldo_dia_anterior_corrigido")
    return (
        per_account
        .withColumn("saldo_dia_anterior_corrigido", opening)
        .select(*ACCOUNT_KEY, F.inline(F.arrays_zip("days", "saldo_dia_anterior_corrigido")))
        .select(*ACCOUNT_KEY, "days.*", "saldo_dia_anterior_corrigido")
        .where(F.col("stored").isNull())
        .withColumn("cdi_diario", held_interest(carried, F.col("rate"), minimum))
        .withColumn("total", carried + F.col("movement") + F.col("cdi_diario"))
        .select(*LEDGER_COLUMNS)
    )


def ledger_report(rows: DataFrame) -> DataFrame:
    """Columns and order of the printed ledger."""
    return rows.select(*LEDGER_REPORT_COLUMNS).orderBy("event_date", *ACCOUNT_KEY)
