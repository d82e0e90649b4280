"""Column expressions for balances and interest."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.schemas import HELD_HOURS, MINIMUM_BALANCE, MONEY_SCALE

# Below this a double has more than nine decimals.
FINE_BELOW = 2.0**23


def as_date(value: str | dt.date) -> dt.date:
    """Accept a run date as ``YYYY-MM-DD`` text or as a date."""
    if isinstance(value, dt.datetime):
        return value.date()
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def rate_fraction(valor: Column) -> Column:
    """Percent per day to a fraction."""
    return valor / F.lit(100.0)


def opening_balance(previous_closing: Column, history: Column) -> Column:
    """Yesterday's closing balance, else the sum of all earlier movements, else zero."""
    return F.coalesce(previous_closing, history, F.lit(0.0))


def eligible_balance(opening: Column, minimum: float = MINIMUM_BALANCE) -> Column:
    return F.when(opening >= minimum, opening).otherwise(F.lit(0.0))


def accrued(opening: Column, rate: Column, minimum: float = MINIMUM_BALANCE) -> Column:
    """Unrounded interest of the calendar-day rule."""
    return F.when(opening >= minimum, opening * rate).otherwise(F.lit(0.0))


def daily_interest(opening: Column, rate: Column, minimum: float = MINIMUM_BALANCE) -> Column:
    return F.round(accrued(opening, rate, minimum), MONEY_SCALE)


def unrounded_closing(
    opening: Column, movement: Column, rate: Column, minimum: float = MINIMUM_BALANCE
) -> Column:
    """Opening plus movement plus the interest before its own rounding."""
    return opening + movement + accrued(opening, rate, minimum)


def closing_balance(
    opening: Column, movement: Column, rate: Column, minimum: float = MINIMUM_BALANCE
) -> Column:
    return F.round(unrounded_closing(opening, movement, rate, minimum), MONEY_SCALE)


def rounded(value: Column) -> Column:
    """``F.round(value, MONEY_SCALE)``, which goes through decimal text, by arithmetic where that tells the same.

    ``half`` is the double nearest to the half between two neighbours: a value beside it lies on that side of
    the half itself, so the shortest text does as well. Only values on it are left to ``F.round``, and those
    so large that their last digits are coarser. Names ``value`` several times: give it a column.
    """
    scale = 10.0**MONEY_SCALE
    size = F.abs(value)
    units = F.floor(size * F.lit(scale))
    half = (units * 2 + 1) / F.lit(2 * scale)
    nearest = units + F.when(size > half, 1).otherwise(0)
    plain = (size < F.lit(FINE_BELOW)) & (size != half)
    return F.when(plain, F.when(value < 0, -nearest).otherwise(nearest) / F.lit(scale)).otherwise(F.round(value, MONEY_SCALE))


def exact_sum(value: Column) -> Column:
    """Sum of amounts rounded to ``MONEY_SCALE`` as ``decimal(38,8)``, without a decimal for every row.

    Whole parts and units of the last decimal add up as integers. Values too large for that many digits are summed
    as decimals, as all would be by ``sum(cast(value as decimal(28,8)))``.
    """
    fine = F.abs(value) < F.lit(FINE_BELOW)
    whole = value.cast("long")
    units = F.rint((value - whole) * F.lit(10.0**MONEY_SCALE)).cast("long")
    unit = F.lit(Decimal(1).scaleb(-MONEY_SCALE))
    # One digit less than the result, so that adding the two keeps every decimal.
    kind = f"decimal(37,{MONEY_SCALE})"
    small = (F.sum(F.when(fine, whole)).cast("decimal(20,0)") + F.sum(F.when(fine, units)).cast("decimal(20,0)") * unit).cast(kind)
    large = F.sum(F.when(~fine, value).cast(f"decimal(28,{MONEY_SCALE})")).cast(kind)
    return F.coalesce(small + large, small, large).cast(f"decimal(38,{MONEY_SCALE})")


def gap_hours(later: Column, earlier: Column) -> Column:
    """Hours between two timestamps, counted in whole seconds."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 3600


def held_rate(
    valor: Column, event_time: Column, held_since: Column, hours: float = HELD_HOURS
) -> Column:
    """Rate an active day may pay: zero unless the balance was held longer than ``hours``."""
    held = held_since.isNotNull() & (gap_hours(event_time, held_since) > hours)
    return F.when(held, rate_fraction(valor)).otherwise(F.lit(0.0))


def held_interest(opening: Column, rate: Column, minimum: float = MINIMUM_BALANCE) -> Column:
    """Interest of the 24-hour rule; unlike the calendar-day rule the minimum is exclusive."""
    return F.when(opening > minimum, rate * opening).otherwise(F.lit(0.0))
