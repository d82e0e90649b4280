"""Similarity digests of improbable byte windows in chained Bloom filters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallybook.llm.common import materialized, mix, sliding_min, small_batches, width

WINDOW = 32  # bytes of a feature
SHORT = 8  # the same in texts that have no whole window
GRADES = 1000  # steps of entropy
POPULAR = 8  # of WINDOW neighbourhoods that must prefer a feature
FILTER_BITS = 2048
HASHES = 5
FULL = 160  # features of a filter
_SCALE = 1 << 16
_TOP = 5 * WINDOW * _SCALE  # as many bits as WINDOW bytes that all differ have
_COST = np.round(np.arange(WINDOW + 2) * np.log2(np.maximum(np.arange(WINDOW + 2), 1)) * _SCALE).astype(np.int64)
_STEP = np.diff(_COST)  # what the c-th equal byte adds is _STEP[c - 1]
# Grades at or beyond these say little: long repeats, and noise. Fixed values.
_DULL, _NOISE = 100, 990


def grades(data: np.ndarray) -> np.ndarray:
    """Entropy of the bytes of every window, 0 to GRADES.

    From window to window one byte leaves and one enters; how often each occurs in the rest of the
    window is counted by comparing the data with itself shifted. All sums are of whole numbers.
    """
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.int64)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for shift in range(1, WINDOW):
        equal = (data[shift:] == data[:-shift]).view(np.uint8)
        before[shift:] += equal
        after[:-shift] += equal
    first = _COST[np.bincount(data[:WINDOW], minlength=256)].sum()
    change = _STEP[before[WINDOW:]] - _STEP[after[: n - 1]]
    return (_TOP - first - np.concatenate(([0], np.cumsum(change)))) * GRADES // _TOP


def _graded(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The grades of each text; texts are strung together, as each call costs the same however short they are."""
    group, size = [], 0
    for text in texts + [None]:
        if text is None or size > 1 << 18:
            data = np.frombuffer(b"".join(group), np.uint8)
            all_, at = grades(data), 0
            for each in group:
                yield all_[at : at + max(0, len(each) - WINDOW + 1)]
                at += len(each)
            group, size = [], 0
        if text is not None:
            group.append(text)
            size += len(text)


def _features(data: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Starts of the features: windows of the least rank in POPULAR or more of the neighbourhoods around them.

    Leftmost first among equals. A text without any has its one least window.
    """
    keys = (rank.astype(np.uint64) << np.uint64(40)) | np.arange(len(rank), dtype=np.uint64)
    if len(keys) >= WINDOW:
        best = (sliding_min(keys, WINDOW) & np.uint64((1 << 40) - 1)).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
        times = np.diff(np.append(start, len(best)))
        popular = best[start][times >= POPULAR]
        popular = popular[rank[popular] < GRADES + 1]
        if len(popular):
            return popular
    return np.array([int((keys.min()) & np.uint64((1 << 40) - 1))])


def _hashed(windows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(windows).view("<u8")
    value = np.zeros(len(words), np.uint64)
    for i in range(words.shape[1]):
        value = mix(value + mix(words[:, i]))
    return value


def digest(data: bytes, grade: np.ndarray, ranks: np.ndarray) -> list[np.ndarray]:
    """The filters of a text, FILTER_BITS bits each. Of texts shorter than a window all SHORT windows are features; empty ones have none."""
    if not data:
        return []
    if len(grade):
        values = np.frombuffer(data, np.uint8)
        at = _features(values, ranks[grade])
        hashes = _hashed(np.lib.stride_tricks.sliding_window_view(values, WINDOW)[at])
    else:
        hashes = _hashed(np.lib.stride_tricks.sliding_window_view(np.frombuffer(data.ljust(SHORT, b"\0"), np.uint8), SHORT))
    hashes = hashes[np.sort(np.unique(hashes, return_index=True)[1])]
    filters = []
    for start in range(0, len(hashes), FULL):
        bits = np.zeros(FILTER_BITS, bool)
        for turn in range(HASHES):
            bits[(hashes[start : start + FULL] >> np.uint64(11 * turn)) & np.uint64(FILTER_BITS - 1)] = True
        filters.append(bits)
    return filters


def as_bytes(filters: list[np.ndarray]) -> bytes:
    return b"".join(np.packbits(f).tobytes() for f in filters)


def likeness(one: list[np.ndarray], other: list[np.ndarray]) -> float:
    """0 to 1: the mean over the shorter chain of each filter's best overlap with the other chain.

    An overlap counts from what filters of that fill share by chance to all bits of the emptier one. Two empty chains are alike, one empty chain is like no other.
    """
    if not one or not other:
        return float(not one and not other)
    short, long = sorted((one, other), key=len)
    best = []
    right = np.stack(long).astype(np.float32)
    right_bits = right.sum(axis=1)
    for left in short:
        bits = float(left.sum())
        shared = right @ left.astype(np.float32)
        most = np.minimum(bits, right_bits)
        chance = bits * right_bits / FILTER_BITS
        best.append(float(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max()))
    return sum(best) / len(best)


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def rarity_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each entropy grade by how rare it is among all windows of all texts, rarest first.

    Grades that say little, long repeats and noise, rank last and are taken only for want of others.
    """

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(GRADES + 1, np.int64)
        for batch in batches:
            for grade in _graded([_bytes(t or "") for t in batch[text]]):
                total += np.bincount(grade, minlength=GRADES + 1)
        yield pd.DataFrame({"grade": np.arange(GRADES + 1), "n": total})

    counts = docs.select(text).mapInPandas(tally, "grade long, n long").groupBy("grade").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(GRADES + 1, np.int64)
    for row in counts:  # GRADES + 1 rows
        total[row["grade"]] = row["n"]
    ranks = np.empty(GRADES + 1, np.int64)
    ranks[np.lexsort((np.arange(GRADES + 1), total))] = np.arange(GRADES + 1)
    ranks[:_DULL] = GRADES + 1
    ranks[_NOISE + 1 :] = GRADES + 1
    return ranks


def fingerprint(text: str | Column, ranks: np.ndarray) -> Column:
    """The chained filters of each text in hexadecimal; null and empty texts give the empty string."""

    @pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        data = [_bytes(t or "") for t in texts]
        return pd.Series([as_bytes(digest(d, g, ranks)) for d, g in zip(data, _graded(data), strict=True)], dtype=object)

    return F.lower(F.hex(of(text)))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _pairs(rows: list[tuple[object, str, str]], ranks: np.ndarray) -> list[tuple]:
    """Results for (id, text, following text)."""
    texts = [_bytes(t) for _, t, _ in rows]
    edited = [_bytes(_edited(t, f)) for _, t, f in rows]
    nexts = [_bytes(f) for _, _, f in rows]
    held: dict[bytes, list[np.ndarray]] = {}
    plain = list(dict.fromkeys(texts + nexts))
    for data, grade in zip(plain, _graded(plain), strict=True):
        held[data] = digest(data, grade, ranks)
    out = []
    for (key, text, _), a, e, b, grade in zip(rows, texts, edited, nexts, _graded(edited), strict=True):
        changed = digest(e, grade, ranks)
        out.append((key, len(text), hashlib.sha256(e).hexdigest(), as_bytes(held[a]), as_bytes(changed), likeness(held[a], changed), likeness(held[a], held[b])))
    return out


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint of every row's text, of its edited text, and their likeness, and that to the next text.

    Rows stand by descending ``doc_id``, nulls last, ties by a hash of the text; the last is followed by
    the first, a single row by itself. In the edited text the last half of the code points, rounded
    down, gives way to as many of the next text's first, or all it has. Null texts are empty, with
    empty fingerprints. Very long texts get longer chains. Columns: ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``;
    others are ignored. An empty table gives an empty result.

    The texts are dealt out by range once; a row and its next lie in one task, but for the last row of
    each. These, and the first rows, at most two for each task, are paired afterwards.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranks = rarity_ranks(docs)
    kind = dict(docs.dtypes)["doc_id"]
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange(width(spark), *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    names = ["doc_id", *[c.split()[0] for c in _RESULT.split(", ")]]

    columns = [*names, "edge", "part", "text"]

    def edge(name: str, row: tuple, part: int) -> pd.DataFrame:
        return pd.DataFrame([(row[0], *[None] * (len(names) - 1), name, part, row[1])], columns=columns, dtype=object)

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = part = None
        for batch in batches:
            if not len(batch):
                continue
            each = list(zip(batch["doc_id"], batch["text"], strict=True))
            if last is None:
                part = int(batch["part"].iloc[0])
                yield edge("first", each[0], part)
            else:
                each.insert(0, last)
            last = each[-1]
            done = _pairs([(a, t, f) for (a, t), (_, f) in zip(each, each[1:], strict=False)], ranks)
            if done:
                yield pd.DataFrame([(*row, None, None, None) for row in done], columns=columns)
        if last is not None:
            yield edge("last", last, part)

    found = materialized(rows.mapInPandas(follow, f"doc_id {kind}, {_RESULT}, edge string, part int, text string"), "digests")
    shown = [F.lower(F.hex(c)).alias(c) if c.endswith("fingerprint") else F.col(c) for c in names]  # bits are stored, half as long
    done = found.where("edge is null").select(*shown)
    parts = sorted(r["part"] for r in found.where("edge = 'first'").select("part").collect())  # one for each task
    if not parts:
        return done
    nexts = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next int")
    ends = found.where("edge = 'last'").select("doc_id", "part", "text").join(F.broadcast(nexts), "part")
    heads = found.where("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(_pairs(list(zip(batch["doc_id"], batch["text"], batch["following"], strict=True)), ranks), columns=names)

    met = ends.join(heads, "next").select("doc_id", "text", "following").mapInPandas(pair, f"doc_id {kind}, {_RESULT}")
    return done.unionByName(met.select(*shown))
