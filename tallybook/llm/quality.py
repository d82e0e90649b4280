"""Quality scores of documents: kernel ridge on random Fourier features, calibrated by isotonic regression."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallybook.llm.common import materialized, small_batches

STATISTICS = (
    "log_chars", "log_words", "word_length", "letters", "upper", "digits", "marks", "spaces", "lines",
    "distinct_words", "top_word", "distinct_lines", "char_entropy", "same_neighbours", "marked_words",
    "letterless_words", "distinct_pairs", "longest_run",
)
# A fold is a remainder of the document's checksum; rows of HELD_OUT teach nothing.
FOLDS, HELD_OUT = 5, 0
_OTHER, _LOWER, _UPPER, _DIGIT, _MARK, _SPACE = range(6)
_PLANE = 1 << 16


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kind of each code point of the basic plane, by its general category."""
    by_category = {"Lu": _UPPER, "Lt": _UPPER, "Nd": _DIGIT, "Nl": _DIGIT, "No": _DIGIT, "Cc": _OTHER}
    by_group = {"L": _LOWER, "M": _LOWER, "P": _MARK, "S": _MARK, "Z": _SPACE}
    kinds = np.empty(_PLANE + 1, np.uint8)
    for point in range(_PLANE):
        category = unicodedata.category(chr(point))
        kinds[point] = by_category.get(category, by_group.get(category[0], _OTHER))
    kinds[9:14] = _SPACE
    kinds[_PLANE] = _LOWER  # what lies beyond
    return kinds


def statistics(text: str | None) -> np.ndarray:
    """STATISTICS of a whole text, all finite; zeros for null and empty texts."""
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[np.minimum(points, _PLANE)]
    n, (_, lower, upper, digits, marks, spaces) = len(points), np.bincount(kinds, minlength=6)
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    used = np.bincount(np.minimum(points, 4095))
    shares = used[used > 0] / n
    change = np.flatnonzero(points[1:] != points[:-1])
    runs = np.diff(np.concatenate(([-1], change, [n - 1])))
    out[:9] = (
        np.log1p(n), np.log1p(len(words)), np.log1p((n - spaces) / max(1, len(words))), (lower + upper) / n,
        upper / max(1, lower + upper), digits / n, marks / n, spaces / n, len(lines) / n,
    )
    if words:
        counted = Counter(words)
        pairs = list(zip(words, words[1:]))
        ends = "".join([w[-1] for w in words])
        kinds_at_end = _kinds()[np.minimum(np.frombuffer(ends.encode("utf-32-le", "surrogatepass"), np.uint32), _PLANE)]
        out[9:12] = len(counted) / len(words), max(counted.values()) / len(words), len(set(lines)) / max(1, len(lines))
        out[13:17] = (
            sum(a == b for a, b in pairs) / len(words), float((kinds_at_end == _MARK).mean()),
            sum(not any(map(str.isalpha, w)) for w in counted) / len(counted), len(set(pairs)) / max(1, len(pairs)),
        )
    out[12] = float(-(shares * np.log2(shares)).sum())
    out[17] = np.log1p(float(runs[points[np.concatenate((change, [n - 1]))] != 32].max(initial=0)))
    return out


def _stats_of(text: str) -> Column:
    @pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t).tobytes() for t in texts], dtype=object)

    return of(text)


def fold(doc_id: str | Column) -> Column:
    """Remainder of the checksum of an id; NULL ids are in fold 1, so not held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(1)).cast("int")


@dataclass(frozen=True)
class Features:
    """``cos(w x + b)`` of standardised statistics: inner products approximate a Gaussian kernel."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shifts: np.ndarray

    def __call__(self, stats: pd.Series) -> np.ndarray:
        """One row a text, with a column of ones at the end."""
        raw = np.frombuffer(b"".join(stats), np.float64).reshape(len(stats), -1)
        z = np.clip((raw - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.weights + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.hstack((waves, np.ones((len(stats), 1))))


@dataclass(frozen=True)
class Model:
    """Ridge weights of all training rows, and the isotonic curve from raw score to probability."""

    features: Features | None
    weights: np.ndarray
    at: np.ndarray
    rate: np.ndarray

    def score(self, stats: pd.Series) -> np.ndarray:
        if self.features is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.features(stats) @ self.weights, self.at, self.rate), 0, 1)


def isotonic(sizes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Non-decreasing means closest to ``sums / sizes`` by weighted squares; pools adjacent violators."""
    blocks: list[list[float]] = []
    for size, total in zip(sizes.tolist(), sums.tolist(), strict=True):
        blocks.append([size, total, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            size, total, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + size, blocks[-1][1] + total, blocks[-1][2] + n]
    return np.concatenate([np.full(int(n), total / size) for size, total, n in blocks]) if blocks else np.empty(0)


def normal_equations(rows: DataFrame, features: Features) -> dict[int, np.ndarray]:
    """For each fold the sums of ``x x'`` and ``x y``, as one matrix whose last column is ``x y``.

    ``rows`` have ``fold``, ``stats``, ``y``, ``n``. Each partition sums its own rows, so what is
    shuffled and collected depends on the number of partitions and features, not of documents.
    """
    wide = len(features.shifts) + 1

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        first = None
        for batch in batches:
            for k, part in batch.groupby("fold"):
                first = part["stats"].iloc[0] if first is None else first
                x = features(part["stats"])
                total = sums.setdefault(int(k), np.zeros((wide, wide + 1)))
                weighed = x * part["n"].to_numpy()[:, None]
                total[:, :-1] += weighed.T @ x
                total[:, -1] += weighed.T @ part["y"].to_numpy()
        for k, total in sums.items():
            yield pd.DataFrame({"fold": k, "line": np.arange(wide), "tag": [first] * wide, "sums": [t.tobytes() for t in total]})

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        # In a fixed order, so that reruns add up to the same.
        rows = [np.frombuffer(s, np.float64) for s in parts.sort_values(["tag", "sums"])["sums"]]
        return pd.DataFrame({"fold": parts["fold"].iloc[:1], "line": parts["line"].iloc[:1], "sums": [np.sum(rows, axis=0).tobytes()]})

    parts = rows.select("fold", "stats", "y", "n").mapInPandas(summed, "fold int, line int, tag binary, sums binary")
    held: dict[int, np.ndarray] = {}
    for line in parts.groupBy("fold", "line").applyInPandas(added, "fold int, line int, sums binary").collect():
        held.setdefault(line["fold"], np.zeros((wide, wide + 1)))[line["line"]] = np.frombuffer(line["sums"], np.float64)
    return held


def _solved(sums: np.ndarray, ridge: float) -> np.ndarray:
    penalty = np.full(len(sums), ridge)
    penalty[-1] = 1e-9  # the intercept is free
    return np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1])


def fit(rows: DataFrame, *, features: int = 128, bandwidth: float = 1.0, ridge: float = 0.1, bins: int = 4096, seed: int = 7) -> Model:
    """Learn from ``rows`` of ``fold``, ``stats``, ``y`` (mean label, 0 to 1) and ``n`` (labels of the row).

    Statistics are standardised by mean and deviation over all rows. Every fold's normal equations
    are summed apart: the model uses the sum of all, and each fold is scored by a model solved from
    the others. Those scores, counted in ``bins`` bins, give the isotonic curve, so it is not
    fitted to rows the ridge has seen. With a single fold it is. No rows give a model that scores 0.5.
    """
    wide = len(STATISTICS)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch["stats"]), np.float64).reshape(len(batch), -1)
            yield pd.DataFrame({"at": np.arange(wide), "n": float(len(raw)), "total": raw.sum(axis=0), "squares": (raw * raw).sum(axis=0)})

    found = rows.select("stats").mapInPandas(moments, "at int, n double, total double, squares double")
    # Rounded sums of decimals do not depend on the order of addition.
    exact = [F.sum(F.col(c).cast("decimal(30,6)")).cast("double").alias(c) for c in ("n", "total", "squares")]
    found = found.groupBy("at").agg(*exact).orderBy("at").toPandas()
    if not len(found):
        return Model(None, np.empty(0), np.empty(0), np.empty(0))
    mean = (found["total"] / found["n"]).to_numpy()
    spread = np.sqrt(np.maximum((found["squares"] / found["n"]).to_numpy() - mean * mean, 0))
    draw = np.random.default_rng(seed)
    made = Features(
        mean,
        np.where(spread > 1e-9, spread, 1.0),
        draw.normal(size=(wide, features)) / (bandwidth * np.sqrt(wide)),
        draw.uniform(0, 2 * np.pi, features),
    )
    sums = normal_equations(rows, made)
    total = np.sum([sums[k] for k in sorted(sums)], axis=0)
    others = {k: _solved(total - own if len(sums) > 1 else total, ridge) for k, own in sums.items()}

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = made(batch["stats"])
            raw = np.array([x[i] @ others[k] for i, k in enumerate(batch["fold"])])
            bin_ = np.clip(np.floor((raw + 1) / 3 * bins), 0, bins - 1).astype(np.int64)
            yield pd.DataFrame({"bin": bin_, "size": batch["n"], "total": np.rint(batch["n"] * batch["y"]).astype(np.int64)})

    curve = rows.select("stats", "fold", "n", "y").mapInPandas(binned, "bin long, size long, total long")
    curve = curve.groupBy("bin").agg(F.sum("size").alias("size"), F.sum("total").alias("total")).toPandas().sort_values("bin")
    at = (curve["bin"].to_numpy() + 0.5) / bins * 3 - 1
    return Model(made, _solved(total, ridge), at, isotonic(curve["size"].to_numpy(), curve["total"].to_numpy()))


def score_quality(docs: DataFrame, labels: DataFrame, *, keep: Sequence[str] = ("doc_id",), threshold: float = 0.3, **fitting) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` with ``held_out``, ``score`` and ``predicted``.

    Learns from ``labels`` (``doc_id``, ``quality`` 0 or 1) of documents that are not held out, that is
    whose checksum leaves a remainder other than HELD_OUT. Only STATISTICS of the whole text are
    looked at. ``predicted`` is 1 from a score of ``threshold`` on.

    Null and empty texts have statistics of zero and are scored like any other; so are very long ones,
    of which a batch holds whole texts. Labels that are null or whose document is missing teach nothing;
    a document labelled several times counts each label. Repeated rows are scored alike and each teaches.
    NULL ids are not held out and have no label. Columns ``held_out``, ``score``, ``predicted`` among ``keep`` are
    replaced, all other names may clash with anything. Without any label all scores are 0.5; empty tables give no rows.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in keep if c not in ("held_out", "score", "predicted")]
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c_{c}") for c in kept]).alias("kept"), F.col("doc_id").alias("id"), fold("doc_id").alias("fold"), _stats_of("text").alias("stats")
    )
    rows = materialized(rows, "statistics")
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.avg(F.col("quality").cast("double")).alias("y"), F.count("*").alias("n")
    )
    learnt = rows.where(F.col("fold") != HELD_OUT).join(marks, "id").select("fold", "stats", "y", "n")
    model = fit(materialized(learnt, "labelled"), **fitting)

    @pandas_udf("double")
    def scored(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(stats))

    found = rows.withColumn("score", scored("stats"))
    return found.select(
        *[F.col(f"kept.c_{c}").alias(c) for c in kept],
        (F.col("fold") == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
