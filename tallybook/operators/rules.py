"""Rules that raw rows must keep, evaluated in one pass; rows that break one are set apart with the reasons."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.schemas import TRANSACTION_KEY, TRANSACTIONS

REPEATED = "key: repeated"


@dataclass(frozen=True)
class Rules:
    """``schema``: declared types. ``required``: columns that must not be NULL. ``ranges``: least and greatest allowed
    value, either of which may be None. ``allowed``: the only values of a column. ``keys``: columns no two rows share."""

    schema: StructType
    required: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[object, object]] = field(default_factory=dict)
    allowed: Mapping[str, tuple[object, ...]] = field(default_factory=dict)
    keys: tuple[str, ...] = ()


TRANSACTION_RULES = Rules(TRANSACTIONS, required=tuple(TRANSACTIONS.fieldNames()), keys=tuple(TRANSACTION_KEY))


def _reasons(raw: DataFrame, rules: Rules) -> list[Column]:
    """One reason, or NULL, for each column and rule; a column that cannot be read breaks no other rule."""
    found = []
    for declared in rules.schema.fields:
        name = declared.name
        given = F.col(name) if name in raw.columns else F.lit(None).cast(declared.dataType)
        value = given.try_cast(declared.dataType)
        broken = F.when(given.isNotNull() & value.isNull(), F.lit(f"{name}: type"))
        if name in rules.required:
            broken = broken.when(given.isNull(), F.lit(f"{name}: missing"))
        low, high = rules.ranges.get(name, (None, None))
        outside = F.lit(False)
        if low is not None:
            outside = outside | (value < F.lit(low))
        if high is not None:
            outside = outside | (value > F.lit(high))
        if low is not None or high is not None:
            broken = broken.when(outside, F.lit(f"{name}: range"))
        if name in rules.allowed:
            broken = broken.when(~value.isin(*rules.allowed[name]), F.lit(f"{name}: value"))
        found.append(broken)
    return found


def checked(raw: DataFrame, rules: Rules) -> DataFrame:
    """Every row with declared columns in their types, all others, ``reasons``, and the ``raw`` row as JSON if there are any.

    A projection: no shuffle, one pass. Values that cannot be cast are NULL, with a reason. Columns
    ``reasons`` and ``raw`` of the input are kept in the JSON only.
    """
    reasons = F.array_compact(F.array(*_reasons(raw, rules)))
    typed = [
        (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in rules.schema.fields
    ]
    own = {*rules.schema.fieldNames(), "reasons", "raw"}
    others = [c for c in raw.columns if c not in own]
    whole = F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    return raw.select(*typed, *others, reasons.alias("reasons"), F.when(F.size(reasons) > 0, whole).alias("raw"))


def mark_repeated(rows: DataFrame, rules: Rules) -> DataFrame:
    """Rows without a reason that share a key get one, but for the greatest of each key.

    Equal rows are counted first, the greatest row of a key is a combinable maximum, and rows are compared with
    it in a join that adaptive execution can split: a key with very many rows is gathered nowhere.
    """
    keys = list(rules.keys)
    sound = rows.where(F.size("reasons") == 0)
    content = [c for c in rows.columns if c not in ("reasons", "raw")]
    counted = sound.groupBy(*content).agg(F.count("*").alias("__n"))
    rest = F.struct(*[c for c in content if c not in keys])
    greatest = counted.groupBy(*keys).agg(F.max(rest).alias("__greatest"))
    first = (F.col("__at") == 0) & (rest == F.col("__greatest"))
    single = counted.join(greatest, keys).withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    again = F.when(first, F.array().cast("array<string>")).otherwise(F.array(F.lit(REPEATED)))
    shown = F.to_json(F.struct(*content), {"ignoreNullFields": "false"})
    marked = single.select(*content, again.alias("reasons"), F.when(~first, shown).alias("raw"))
    return rows.where(F.size("reasons") > 0).select(*content, "reasons", "raw").unionByName(marked)


def validated(
    raw: DataFrame, rules: Rules, stage: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected ones with ``reasons`` and ``raw``; together as many as ``raw`` has.

    ``stage`` writes the checked rows once, so that the raw rows are not read for either side.
    """
    rows = checked(raw, rules)
    rows = stage(mark_repeated(rows, rules) if rules.keys else rows)
    accepted = rows.where(F.size("reasons") == 0).drop("reasons", "raw")
    return accepted, rows.where(F.size("reasons") > 0)


def reasons_report(rejected: DataFrame) -> DataFrame:
    """How many rows each reason rejected; a row with several counts for each."""
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))
