"""Rules on raw rows: reasons, routing, repeated keys, and curation by them."""

import json
import random
from collections import Counter, defaultdict
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.rules import TRANSACTION_RULES, Rules, checked, mark_repeated, reasons_report, validated
from tallybook.plans.curate import curate_validated
from tallybook.plans.zones import Zones
from tallybook.schemas import CURATED_TRANSACTIONS
from tallybook.sources.tables import read_table
from tests.fixtures import as_set, plan_of

RULES = Rules(
    T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("size", T.DecimalType(6, 2))]),
    required=("id",), ranges={"size": (0, 50)}, allowed={"kind": ("a", "b")}, keys=("id",),
)
RAW = "id string, kind string, size string, reasons string, note string"


def slow(rows):
    """Reasons of each row, those that share a key judged by the greatest."""
    out, sound = [], defaultdict(list)
    for i, kind, size, *_, note in rows:
        reasons = []
        if i is None:
            reasons.append("id: missing")
        elif not i.strip().isdigit():
            reasons.append("id: type")
        if kind is not None and kind not in ("a", "b"):
            reasons.append("kind: value")
        try:
            value = None if size is None else round(Decimal(size), 2)
            if value is not None and not 0 <= value <= 50:
                reasons.append("size: type" if abs(value) >= 10_000 else "size: range")
        except InvalidOperation:
            reasons.append("size: type")
        if reasons:
            out.append((note, tuple(reasons)))
        else:
            sound[int(i)].append(((kind is not None, kind or ""), (value is not None, value or 0), (note is not None, note or "")))
    for same in sound.values():
        for n, row in enumerate(sorted(same, reverse=True)):
            out.append((row[2][1] or None, () if n == 0 else ("key: repeated",)))
    return Counter(out)


def raw_rows(seed, n=400):
    draw = random.Random(seed)
    ids = [str(i) for i in range(60)] + [None, "x", "", " 7"]
    return [
        (draw.choice(ids), draw.choice(["a", "b", "c", None]), draw.choice(["1.25", "50", "50.01", "-1", "1e9", "ten", None]), "clash", draw.choice("pqr"))
        for _ in range(n)
    ] + [("3", "a", "1", "clash", "q")] * 300


@pytest.mark.parametrize("seed", [1, 2])
def test_reasons_equal_brute_force_and_counts_add_up(spark, seed):
    rows = raw_rows(seed)
    accepted, rejected = validated(spark.createDataFrame(rows, RAW), RULES)
    assert accepted.columns == ["id", "kind", "size", "note"]
    got = Counter([(r.note, ()) for r in accepted.collect()] + [(r.note, tuple(r.reasons)) for r in rejected.collect()])
    assert got == slow(rows) and sum(got.values()) == len(rows)
    report = {r.reason: r["rows"] for r in reasons_report(rejected).collect()}
    assert report == Counter(reason for (_, reasons), n in slow(rows).items() for reason in reasons for _ in range(n))


def test_the_raw_row_is_kept(spark):
    (row,) = validated(spark.createDataFrame([("x", "a", "ten", "own", None)], RAW), RULES)[1].collect()
    assert json.loads(row.raw) == {"id": "x", "kind": "a", "size": "ten", "reasons": "own", "note": None}
    assert (row.id, row["size"], list(row.reasons)) == (None, None, ["id: type", "size: type"])


def test_row_rules_need_no_shuffle_and_key_rules_no_window(spark):
    raw = spark.createDataFrame(raw_rows(3), RAW)
    assert "Exchange" not in plan_of(checked(raw, RULES))
    plan = plan_of(mark_repeated(checked(raw, RULES), RULES))
    assert "Window" not in plan and "partial_max" in plan and "Python" not in plan


def test_missing_columns_and_no_rows(spark):
    raw = spark.createDataFrame([("1",)], "id string")
    accepted, rejected = validated(raw, RULES)
    assert [tuple(r) for r in accepted.collect()] == [(1, None, None)] and rejected.isEmpty()
    accepted, rejected = validated(raw.where("false"), RULES)
    assert accepted.isEmpty() and rejected.isEmpty()
    strict = Rules(RULES.schema, required=("size",))
    assert [list(r.reasons) for r in validated(raw, strict)[1].collect()] == [["size: missing"]]


def test_curation_by_rules_can_be_repeated(spark, tmp_path):
    zones = Zones(str(tmp_path))
    schema = "user_id string, account_id string, event_time string, amount string"
    first = [
        ("u", "a", "2024-01-08 10:00:00", "1.00"), ("u", "b", "2024-01-08 10:00:00", "one"), ("u", None, "2024-01-09 10:00:00", "1.00"),
        ("u", "c", "soon", "1.00"), ("u", "d", None, "1.00"), ("u", "e", "2024-02-01 10:00:00", "none"),
    ]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(zones.raw_transactions)
    for _ in range(2):
        curate_validated(spark, zones, "2024-01-08", "2024-01-09", on_duplicate="replace")
    stored = read_table(spark, zones.transactions, CURATED_TRANSACTIONS)
    assert [(r.account_id, float(r.amount)) for r in stored.collect()] == [("a", 1.0)]
    rejected = {(str(r.date), r.account_id, *r.reasons) for r in read_table(spark, zones.rejected).collect()}
    assert rejected == {
        ("2024-01-08", "b", "amount: type"), ("2024-01-09", None, "account_id: missing"),
        ("None", "c", "event_time: type"), ("None", "d", "event_time: missing"),
    }
    sound = [("u", "b", "2024-01-08 10:00:00", "2.00"), ("u", "f", "2024-01-09 10:00:00", "3.00")]
    spark.createDataFrame(sound, schema).coalesce(1).write.mode("overwrite").parquet(zones.raw_transactions)
    curate_validated(spark, zones, "2024-01-08", "2024-01-09", on_duplicate="replace")
    assert len(as_set(stored.sparkSession.read.parquet(zones.transactions))) == 3
    left = {str(r.date) for r in read_table(spark, zones.rejected).collect()}
    assert left == {"None"}


def test_transaction_rules_name_every_column():
    assert TRANSACTION_RULES.required == ("user_id", "account_id", "event_time", "amount")
