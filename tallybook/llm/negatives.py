"""Hard negatives: rotated one-bit codes bound every inner product, what the bounds leave is scored exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import materialized

_NO_ID = np.iinfo(np.int64).max  # stands for a NULL id, which sorts last
_NO_SCORE = np.iinfo(np.int64).min
_PLANES = 6
_EXACT = 1 << 53
# --- fixed values: how vectors become integers, which labels move, how scores are compared ---
SCALE = 256
MOVED, LABELS = 7, 10
LOW, HIGH = 80, 100
# --- end of fixed values ---


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label``, ``x``: integer components of the rows that take part, each row once.

    Rows with a null label or vector, or a null or non-finite component, take no part. Where the id is
    divisible by MOVED the label becomes ``(label + 1) % LABELS``. Rows equal in id, label and
    components are one row.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col("label").cast("long")
    return (
        vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull())
        .where(finite)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(F.col("vec_id") % MOVED == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
            F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("x"),
        )
        .distinct()
    )


def rotate(rows: np.ndarray, seed: int, rounds: int = 3) -> np.ndarray:
    """A fixed random rotation: signs flipped by chance, then a Hadamard transform, a few times over.

    The number of columns must be a power of two. Lengths and inner products stay the same.
    """
    wide = rows.shape[1]
    draw = np.random.default_rng(seed)
    for _ in range(rounds):
        rows = rows * (draw.integers(0, 2, wide) * 2 - 1)
        half = 1
        while half < wide:
            pairs = rows.reshape(len(rows), -1, 2, half)
            rows = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(rows), wide)
            half *= 2
        rows = rows / np.sqrt(wide)
    return rows


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words; their number is a multiple of 64."""
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _ones(words: np.ndarray) -> np.ndarray:
    """Bits set in each row of words."""
    counts = np.bitwise_count(words)
    return counts[:, 0].astype(np.int32) if counts.shape[1] == 1 else counts.sum(axis=1, dtype=np.int32)


def _padded(rows: np.ndarray) -> np.ndarray:
    wide = 64
    while wide < rows.shape[1]:
        wide *= 2
    return np.pad(rows, ((0, 0), (0, wide - rows.shape[1])))


@dataclass(frozen=True)
class Codes:
    """One-bit codes of the rows of a block, of their residuals, and so on.

    ``rows = sum of align[level] * sign(level) / sqrt(wide) + residual``; ``align`` is the inner product
    of what was left with its code, ``left`` the length of what is left after each level, ``ones`` counts the code's bits.
    """

    bits: list[np.ndarray]
    align: list[np.ndarray]
    left: list[np.ndarray]
    ones: list[np.ndarray]

    @staticmethod
    def of(rows: np.ndarray, levels: int, seed: int) -> Codes:
        rest = rotate(_padded(rows.astype(np.float64)), seed)
        made = Codes([], [], [], [])
        unit = 1 / np.sqrt(rest.shape[1])
        for _ in range(levels):
            up = rest >= 0
            align = np.abs(rest).sum(axis=1) * unit
            rest = rest - np.where(up, unit, -unit) * align[:, None]
            made.bits.append(_words(up))
            made.align.append(align)
            made.left.append(np.sqrt((rest * rest).sum(axis=1)))
            made.ones.append(_ones(made.bits[-1]))
        return made


@dataclass(frozen=True)
class Query:
    """A rotated query in bit planes: inner products with codes are counts of common bits."""

    planes: np.ndarray
    low: float
    step: float
    total: float
    slip: float
    length: float
    wide: int

    @staticmethod
    def many(rows: np.ndarray, seed: int) -> list[Query]:
        made = []
        for turned in rotate(_padded(rows.astype(np.float64)), seed):
            low, high = float(turned.min()), float(turned.max())
            step = (high - low) / ((1 << _PLANES) - 1) or 1.0
            levels = np.rint((turned - low) / step).astype(np.int64)
            planes = _words(((levels >> np.arange(_PLANES)[:, None]) & 1).astype(bool))
            slip = float(np.linalg.norm(turned - (low + step * levels)))
            made.append(Query(planes, low, step, float(levels.sum()), slip, float(np.linalg.norm(turned)), len(turned)))
        return made

    def dots(self, bits: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Inner products of the rounded query with unit codes, by popcounts; off by at most ``slip``."""
        both = np.zeros(len(bits), np.int32)
        for p, plane in enumerate(self.planes):
            both += _ones(bits & plane) << p
        return (self.low * (2.0 * ones - self.wide) + self.step * (2.0 * both - self.total)) / np.sqrt(self.wide)

    def interval(self, codes: Codes, level: int, at: np.ndarray, estimate: np.ndarray, slips: np.ndarray) -> tuple[np.ndarray, ...]:
        """Estimates and slips with one more level of codes, and how far the inner products may lie.

        The residual is orthogonal to the last code, so by Cauchy and Schwarz its inner product is at
        most its length times the length of the query's part beside that code. What rounding of
        floating-point numbers may do is far below the margin added.
        """
        dot = self.dots(codes.bits[level][at], codes.ones[level][at])
        align = codes.align[level][at]
        estimate = estimate + align * dot
        slips = slips + align * self.slip
        beside = np.sqrt(np.maximum(self.length**2 - np.maximum(np.abs(dot) - self.slip, 0) ** 2, 0))
        margin = 1e-9 * (1 + self.length * (np.abs(estimate) + align + codes.left[level][at]))
        return estimate, slips, slips + beside * codes.left[level][at] + margin


def _dots(rows: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Integer inner products; Python numbers where 64-bit floats could round."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(row).max(initial=0)) * max(1, len(row))
    if most < _EXACT:
        return (rows @ row).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, row, strict=True)) for r in rows]
    if any(abs(s) > _NO_ID for s in exact):
        raise ValueError("a score does not fit into 64 bits")
    return np.array(exact, np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k``: higher scores, then smaller ids."""
    return np.lexsort((ids, -scores))[:k]


@dataclass(frozen=True)
class Block:
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    codes: Codes

    @staticmethod
    def read(line) -> Block:
        n, wide, words, levels = line.n, line.wide, line.words, line.levels
        halves = np.frombuffer(line.numbers, np.float64).reshape(2 * levels, n)
        bits = np.frombuffer(line.codes, np.uint64).reshape(levels, n, words)
        return Block(
            np.frombuffer(line.ids, np.int64),
            np.frombuffer(line.labels, np.int64),
            np.frombuffer(line.rows, np.float64).reshape(n, wide),
            Codes(list(bits), list(halves[:levels]), list(halves[levels:]), [_ones(b) for b in bits]),
        )


def longest(rows: DataFrame) -> int:
    return max(1, rows.agg(F.max(F.size("x")).alias("wide")).first()["wide"] or 1)


def code_blocks(rows: DataFrame, *, block_bytes: int = 8 << 20, levels: int = 3, seed: int = 11) -> DataFrame:
    """The rows of ``usable`` in blocks of about ``block_bytes``, with their codes and alignments stored beside them.

    Shorter vectors are filled up with zeros to the longest.
    """
    wide = longest(rows)
    block = max(1, block_bytes // (8 * wide))

    def packed(ids: np.ndarray, labels: np.ndarray, data: np.ndarray) -> pd.DataFrame:
        codes = Codes.of(data, levels, seed)
        return pd.DataFrame({
            "n": [len(ids)], "wide": [wide], "words": [codes.bits[0].shape[1]], "levels": [levels],
            "ids": [ids.tobytes()], "labels": [labels.tobytes()], "rows": [data.tobytes()],
            "codes": [b"".join(b.tobytes() for b in codes.bits)],
            "numbers": [b"".join(a.tobytes() for a in codes.align + codes.left)],
        })

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def one(part: list[tuple]) -> pd.DataFrame:
            data = np.zeros((len(part), wide))
            for i, (_, _, x) in enumerate(part):
                data[i, : len(x)] = x
            ids = np.array([i for i, _, _ in part], np.int64)
            return packed(ids, np.array([y for _, y, _ in part], np.int64), data)

        for batch in batches:
            held += zip(batch["vec_id"], batch["label"], batch["x"], strict=True)
            while len(held) >= block:
                yield one(held[:block])
                held = held[block:]
        if held:
            yield one(held)

    named = rows.select(F.coalesce("vec_id", F.lit(int(_NO_ID))).alias("vec_id"), "label", "x")
    kinds = "n int, wide int, words int, levels int, ids binary, labels binary, rows binary, codes binary, numbers binary"
    return materialized(named.mapInPandas(blocks, kinds), "codes")


def _anchors(rows: DataFrame, every: int, group_bytes: int) -> DataFrame:
    """Anchors in groups of about ``group_bytes``: ``part``, and ``anchors``, an array."""
    chosen = rows.where(F.col("vec_id") % every == 0)
    group = max(1, group_bytes // (8 * longest(rows)))
    parts = max(1, -(-chosen.count() // group))
    part = F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(parts)).alias("part")
    named = chosen.select(part, F.struct("vec_id", "label", "x").alias("anchor"))
    # Sorted, so an anchor has the same place in every pass.
    return materialized(named.groupBy("part").agg(F.sort_array(F.collect_list("anchor")).alias("anchors")), "anchors")


class _Best:
    """The first few (score, id) an anchor has met; its worst is what others must reach."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else int(_NO_SCORE)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        order = _first(scores, ids, self.k)
        self.scores, self.ids = scores[order], ids[order]


def _survivors(query: Query, block: Block, at: np.ndarray, low: float, high: float, k: int = 0) -> np.ndarray:
    """Of the rows ``at``, those whose score can lie from ``low`` to ``high`` and, given ``k``, be among the first ``k``.

    With ``k``, rows below the ``k``-th greatest lower end go too. Each level of codes looks at what the
    one before has left.
    """
    estimate, slips = np.zeros(len(at)), np.zeros(len(at))
    for level in range(len(block.codes.bits)):
        if not len(at):
            break
        estimate, slips, reach = query.interval(block.codes, level, at, estimate, slips)
        least, most = estimate - reach, estimate + reach
        floor = max(low, np.partition(least, -k)[-k]) if 0 < k < len(least) else low
        keep = (most >= floor) & (least <= high)
        at, estimate, slips = at[keep], estimate[keep], slips[keep]
    return at


def _wide_rows(anchors: list[dict], wide: int) -> np.ndarray:
    rows = np.zeros((len(anchors), wide))
    for row, anchor in zip(rows, anchors, strict=True):
        row[: len(anchor["x"])] = anchor["x"]
    return rows


def nearest_alike(blocks: DataFrame, anchors: DataFrame, k: int, seed: int) -> DataFrame:
    """For each anchor and task the first ``k`` rows of its label, itself left out: ``place, score, vec_id``."""

    def met(lines: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, _Best] = {}
        queries: list[tuple] = []
        for frame in lines:
            for line in frame.itertuples():
                block = Block.read(line)
                if not queries:
                    rows = _wide_rows(line.anchors, line.wide)
                    queries = list(zip(Query.many(rows, seed), rows, line.anchors, strict=True))
                for place, (query, row, anchor) in enumerate(queries):
                    at = np.flatnonzero((block.labels == anchor["label"]) & (block.ids != anchor["vec_id"]))
                    own = best.setdefault(place, _Best(k))
                    at = _survivors(query, block, at, own.floor(), np.inf, k)
                    if len(at):
                        own.take(_dots(block.rows[at], row), block.ids[at])
        for place, own in best.items():
            if len(own.ids):
                yield pd.DataFrame({"place": place, "score": own.scores, "vec_id": own.ids})

    return blocks.crossJoin(F.broadcast(anchors.select("anchors"))).mapInPandas(met, "place int, score long, vec_id long")


def nearest_within(blocks: DataFrame, anchors: DataFrame, k: int, seed: int) -> DataFrame:
    """For each anchor, limit and task the first ``k`` rows of other labels: ``place, limit, score, vec_id``.

    ``limits`` holds each anchor's positive scores; rows count if LOW to HIGH percent of one of them.
    """

    def met(lines: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[tuple[int, int], _Best] = {}
        queries: list[tuple] = []
        for frame in lines:
            for line in frame.itertuples():
                block = Block.read(line)
                if not queries:
                    held = {entry["place"]: [int(s) for s in entry["scores"]] for entry in line.limits}
                    rows = _wide_rows(line.anchors, line.wide)
                    for place, (query, row, anchor) in enumerate(zip(Query.many(rows, seed), rows, line.anchors, strict=True)):
                        # Below zero nothing lies within.
                        owns = [(limit, best.setdefault((place, limit), _Best(k))) for limit in held.get(place, []) if limit >= 0]
                        if owns:
                            queries.append((query, row, anchor["label"], owns))
                for query, row, label, owns in queries:
                    low = min(max(own.floor(), -(-LOW * limit // HIGH)) for limit, own in owns)
                    at = _survivors(query, block, np.flatnonzero(block.labels != label), low, max(limit for limit, _ in owns))
                    if not len(at):
                        continue
                    scores, ids = _dots(block.rows[at], row), block.ids[at]
                    for limit, own in owns:
                        fit = (HIGH * scores >= LOW * limit) & (scores <= limit) & (scores >= own.floor())
                        own.take(scores[fit], ids[fit])
        for (place, limit), own in best.items():
            if len(own.ids):
                yield pd.DataFrame({"place": place, "limit": limit, "score": own.scores, "vec_id": own.ids})

    sent = blocks.crossJoin(F.broadcast(anchors.select("anchors", "limits")))
    return sent.mapInPandas(met, "place int, limit long, score long, vec_id long")


def _ranked(rows: DataFrame, of: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group over all tasks; a group has at most ``k`` rows a task."""
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, *, every: int = 100, positives: int = 5, negatives: int = 5, group_bytes: int = 1 << 20, block_bytes: int = 8 << 20, levels: int = 3, seed: int = 11
) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    Anchors are the rows of ``usable`` whose id is divisible by ``every``. A score is the integer inner product with
    the anchor; higher ones come first, ties by smaller id. Positives are an anchor's first ``positives`` rows
    of the same label and another id; negatives the first of different labels that score LOW to HIGH percent of the positive.

    Every row is coded once: its rotated signs as bits, how well they are aligned with it, and the
    length of what they miss, at ``levels`` levels. An anchor's inner product with the codes is counted
    in common bits; with the lengths it bounds the true score from both sides. Only rows whose interval can
    matter are scored, in integers, so results are exact. Anchors pass over all blocks in groups of about ``group_bytes``,
    which bounds what is broadcast; each group's results are written before the next begins. Tasks keep the first few rows of each
    anchor, so neither a label nor an anchor is gathered anywhere.

    Rows equal in id, label and components are one row; other rows that share an id all take part, each as an anchor
    too, but none is a positive of an anchor with its id. NULL ids are no anchors and sort last. Vectors of different lengths are filled up with zeros; empty ones score 0. A score beyond 64 bits is an error.
    Other columns are ignored, and empty tables give no rows.
    """
    rows = materialized(usable(vectors), "vectors")
    anchors = _anchors(rows, every, group_bytes)
    blocks = code_blocks(rows, block_bytes=block_bytes, levels=levels, seed=seed)
    done: list[DataFrame] = []
    for part in sorted(r["part"] for r in anchors.select("part").collect()):
        asked = anchors.where(F.col("part") == part).select("anchors")
        alike = materialized(_ranked(nearest_alike(blocks, asked, positives, seed), ["place"], positives), "positives")
        limits = alike.groupBy("place").agg(F.sort_array(F.collect_set("score")).alias("scores"))
        limits = limits.agg(F.collect_list(F.struct("place", "scores")).alias("limits"))
        found = nearest_within(blocks, asked.crossJoin(F.broadcast(limits)), negatives, seed)
        hard = _ranked(found, ["place", "limit"], negatives)
        named = asked.select(F.posexplode("anchors").alias("place", "anchor")).select("place", "anchor.vec_id")
        pairs = alike.select("place", F.col("vec_id").alias("positive_id"), F.col("score").alias("limit"))
        done.append(
            materialized(
                hard.join(F.broadcast(pairs), ["place", "limit"])
                .join(F.broadcast(named.withColumnRenamed("vec_id", "anchor_id")), "place")
                .select(
                    "anchor_id",
                    _id("positive_id"),
                    F.col("rank").cast("int").alias("rank"),
                    _id("vec_id").alias("negative_id"),
                    F.col("limit").alias("positive_score"),
                    F.col("score").alias("negative_score"),
                ),
                "negatives",
            )
        )
    if not done:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _id(name: str):
    return F.nullif(F.col(name), F.lit(int(_NO_ID))).alias(name)
