"""Random upserts against a plain model of the rules."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException

from tallybook.operators.merge import merge_upsert

SCHEMA = "a string, b int, v int, w string"
KEYS = ["a", "b"]


def rows(rng, n):
    return [
        (rng.choice(["x", "y", "z", None]), rng.choice([1, 2, 3, None]),
         rng.choice([1, 2, 3, None]), rng.choice(["p", "q", None]))
        for _ in range(n)
    ]


def order(row):
    """NULL sorts first, as in Spark."""
    return tuple((x is not None, x if x is not None else 0) for x in (row[2],)) + tuple(
        (x is not None, x or "") for x in (row[3],)
    )


def model(target, source, policy):
    changes = defaultdict(list)
    loose = []
    for r in source:
        (loose if None in r[:2] else changes[r[:2]]).append(r)
    if policy == "latest":
        changes = {k: [max(v, key=order)] for k, v in changes.items()}
    known = {r[:2] for r in target if None not in r[:2]}
    if policy == "error" and any(len(v) > 1 and k in known for k, v in changes.items()):
        return None
    out = []
    for r in target:
        out += changes.get(r[:2], [r]) if None not in r[:2] else [r]
    out += [r for k, v in changes.items() if k not in known for r in v]
    return Counter(out + loose)


@pytest.mark.parametrize("policy", ["error", "keep_all", "latest"])
@pytest.mark.parametrize("seed", range(3))
def test_random_upserts(spark, policy, seed):
    rng = random.Random(seed)
    target, source = rows(rng, rng.randrange(25)), rows(rng, rng.randrange(15))
    merged = merge_upsert(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA),
        KEYS, on_duplicate=policy, latest_by=["v"],
    )
    want = model(target, source, policy)
    if want is None:
        with pytest.raises(PySparkException):
            merged.collect()
    else:
        assert Counter(tuple(r) for r in merged.collect()) == want
