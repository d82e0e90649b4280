"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallybook.llm.common import materialized, mix, small_batches

UNKNOWN = "und"
FEATURES = 1 << 13
LENGTHS = (1, 2, 3)
# Short texts lie farther from their centroid: floors are held for texts cut to so many letters.
CUTS = (4, 8, 16, 32, 64, 128, 256, 512, 1024)

_OTHER = re.compile(r"[\W\d_]+")


def _letters(text: str | None) -> str:
    """The letters in lower case, runs of anything else as one space; empty if there are none."""
    plain = _OTHER.sub(" ", (text or "").lower())
    return plain if any(c.isalpha() for c in plain) else ""


def _slots(plain: str) -> Iterator[np.ndarray]:
    """The slots of the hashed n-grams of characters, one array a length."""
    points = np.frombuffer(f" {plain.strip()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    gram = np.zeros(len(points), np.uint64)
    for length in range(1, max(LENGTHS) + 1):
        rest = len(points) - length + 1
        if rest < 1:
            break
        gram = gram[:rest] * np.uint64(0x110000) + points[length - 1 :]
        if length in LENGTHS:
            yield (mix(gram + np.uint64(length)) >> np.uint64(40)).astype(np.int64) % FEATURES


def counts(text: str | None) -> np.ndarray | None:
    """How often each hashed n-gram of characters occurs; None without a letter."""
    plain = _letters(text)
    return _counted(plain) if plain else None


def _counted(plain: str) -> np.ndarray:
    total = np.zeros(FEATURES, np.int64)
    for slots in _slots(plain):
        total += np.bincount(slots, minlength=FEATURES)
    return total


def _weighed(total: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.log1p(total).astype(np.float32) * idf
    return vector / max(float(np.linalg.norm(vector)), 1e-12)


@dataclass(frozen=True)
class Model:
    """At most labels * centroids rows of FEATURES numbers, and a floor for each of CUTS."""

    labels: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owners: np.ndarray
    floors: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        plain = _letters(text)
        if not plain or not len(self.owners):
            return UNKNOWN, 0.0, True
        near = self.centroids @ _weighed(_counted(plain), self.idf)
        best = int(near.argmax())
        score = min(1.0, max(0.0, float(near[best])))
        return self.labels[self.owners[best]], score, score < float(self.floors[best, _cut(len(plain.strip()))])


def _cut(length: int) -> int:
    """The place in CUTS of the greatest that is no longer than the text, or the first."""
    return max(0, bisect_right(CUTS, length) - 1)


def _clustered(vectors: np.ndarray, k: int, rounds: int = 12, least: float = 0.05) -> np.ndarray:
    """Unit centroids. Centroids of under ``least`` of the vectors are outliers and go."""
    draw = np.random.default_rng(len(vectors))
    chosen = [int((vectors @ vectors.mean(axis=0)).argmax())]
    while len(chosen) < min(k, len(vectors)):
        far = np.maximum(1 - (vectors @ vectors[chosen].T).max(axis=1), 0) ** 2
        chosen.append(int(draw.choice(len(vectors), p=far / far.sum()) if far.sum() > 0 else len(chosen)))
    centres = vectors[chosen]
    for turn in range(rounds):
        own = np.bincount((vectors @ centres.T).argmax(axis=1), minlength=len(centres))
        if turn == rounds - 1:
            centres = centres[own >= min(own.max(), least * len(vectors))]
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[own == i].sum(axis=0) if (own == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _floors(vectors: np.ndarray, centres: np.ndarray, starts: list[str], idf: np.ndarray, low: float, margin: float) -> np.ndarray:
    """For each centroid and each of CUTS, ``margin`` times the ``low`` quantile of the cosines of its members cut so short.

    A member is compared with the sum of the others, so that small groups do not look closer than
    they are; a centroid of a single text rejects nothing.
    """
    own = (vectors @ centres.T).argmax(axis=1)
    floors = np.zeros((len(centres), len(CUTS)))
    for i in range(len(centres)):
        members = np.flatnonzero(own == i)
        if not len(members):
            continue
        others = vectors[members].sum(axis=0) - vectors[members]
        others /= np.maximum(np.linalg.norm(others, axis=1, keepdims=True), 1e-12)
        for j, cut in enumerate(CUTS):
            whole = [k for k, m in enumerate(members) if len(starts[m]) >= cut]
            if whole:
                near = [float(others[k] @ _weighed(_counted(starts[members[k]][:cut]), idf)) for k in whole]
                floors[i, j] = margin * max(0.0, float(np.quantile(near, low)))
            elif j:
                floors[i, j] = floors[i, j - 1]
    return floors


def fit(labelled: DataFrame, *, sample: int = 600, centroids: int = 3, low: float = 0.05, margin: float = 0.4, most_labels: int = 500) -> Model:
    """Learn from ``text`` and ``lang`` of a sample of at most ``sample`` documents a language.

    The sample is of distinct texts with a letter, drawn by a hash of the text, so it is the same each time. Inverse
    document frequencies are counted over all documents; the centroids come from the sample: spherical k-means within each language, on
    TF-IDF vectors of hashed character n-grams. Texts whose cosine to the nearest centroid is below
    ``margin`` times the ``low`` quantile of what its own texts reach when cut to about the same length are rejected.
    Rows without a language or a letter teach nothing.
    More than ``most_labels`` languages are an error: the model is held in the driver.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.where("lang is not null and text is not null").select("text", "lang", F.xxhash64("text").alias("hash"))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    sizes = rows.select("lang", "hash").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    if sizes.count() > most_labels:
        raise ValueError(f"more than {most_labels} languages")
    parts = 1 << 20
    # Half as many again, so that chance leaves no language short of its places.
    drawn = F.pmod("hash", F.lit(parts)) < F.ceil(F.lit(1.5 * sample * parts) / F.col("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    chosen = rows.join(F.broadcast(sizes), "lang").where(drawn).groupBy("lang", "hash").agg(F.first("text").alias("text"))
    chosen = chosen.withColumn("place", place).where(F.col("place") <= sample)

    @pandas_udf("binary")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([None if (c := counts(t)) is None else np.minimum(c, 65535).astype(np.uint16).tobytes() for t in texts], dtype=object)

    @pandas_udf("string")
    def started(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _letters(t).strip()[: CUTS[-1]])

    drawn = chosen.select("lang", "hash", counted("text").alias("counts"), started("text").alias("start")).where("counts is not null")
    drawn = materialized(drawn, "sample")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for plain in filter(None, map(_letters, batch["text"])):
                present = np.zeros(FEATURES, bool)
                for slots in _slots(plain):
                    present[slots] = True
                held += present
                n += 1
        if n:
            yield pd.DataFrame({"slot": np.arange(FEATURES), "held": held, "n": n})

    held = rows.select("text").mapInPandas(frequencies, "slot long, held long, n long")
    held = held.groupBy("slot").agg(F.sum("held").alias("held"), F.sum("n").alias("n")).toPandas().sort_values("slot")
    if not len(held):
        return Model([], np.zeros(FEATURES, np.float32), np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64), np.zeros((0, len(CUTS))))
    idf = np.log((held["n"].to_numpy() + 1) / (held["held"].to_numpy() + 1)).astype(np.float32) + 0.1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("hash")
        vectors = np.stack([_weighed(np.frombuffer(c, np.uint16).astype(np.int64), idf) for c in group["counts"]])
        centres = _clustered(vectors, centroids)
        floors = _floors(vectors, centres, group["start"].tolist(), idf, low, margin)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "place": range(len(centres)), "floors": floors.tolist(), "centre": [c.astype(np.float32).tobytes() for c in centres]})

    learnt = drawn.groupBy("lang").applyInPandas(cluster, "lang string, place long, floors array<double>, centre binary")
    learnt = sorted(learnt.collect(), key=lambda r: (r["lang"], r["place"]))
    labels = sorted({r["lang"] for r in learnt})
    return Model(
        labels,
        idf,
        np.stack([np.frombuffer(r["centre"], np.float32) for r in learnt]),
        np.array([labels.index(r["lang"]) for r in learnt], np.int64),
        np.array([r["floors"] for r in learnt]),
    )


def predicted(text: str | Column, model: Model) -> Column:
    """Struct of ``lang_pred``, ``score``, ``rejected`` for whole texts.

    ``lang_pred`` is the language of the nearest centroid, ``score`` its cosine, cut to 0..1.
    Null and empty texts and texts without a letter are ``und``, with score 0, and rejected; so is everything if there
    was nothing to learn from. Other texts are rejected if they lie too far from the nearest centroid; they keep its language.
    Ties go to the language that sorts first.
    """

    @pandas_udf("lang_pred string, score double, rejected boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return of(text)


def held_out(doc_id: str | Column) -> Column:
    """Every third document by a checksum of its id is kept from training. NULL ids are not held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify_language(docs: DataFrame, **fitting) -> DataFrame:
    """All rows and columns of ``docs`` with the struct ``language`` of ``predicted``, learnt from ``docs`` itself.

    Learns from rows that are not held out and have a ``lang``; ``lang`` and other columns are not
    looked at in a prediction. Repeated rows are predicted alike. A former column ``language`` is replaced.
    """
    small_batches(docs.sparkSession)
    model = fit(docs.where(~held_out("doc_id")).select("text", "lang"), **fitting)
    return docs.withColumn("language", predicted("text", model))
