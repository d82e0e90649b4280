"""Quality scores: accuracy on held-out labels, sums against numpy, edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import quality as q
from tallybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op13_quality"](spark, SF_DIR).toPandas()


def test_every_document_once_with_the_contract_columns(spark, scored):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert list(scored.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert sorted(scored["doc_id"]) == sorted(r[0] for r in docs.select("doc_id").collect())
    assert scored["score"].between(0, 1).all()
    assert (scored["predicted"] == (scored["score"] >= 0.3)).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]).all()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    held = scored[scored["held_out"]].merge(labels, on="doc_id")
    good, bad = held[held["quality"] == 1]["score"].to_numpy(), held[held["quality"] == 0]["score"].to_numpy()
    above = (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2
    assert above > 0.97
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_labels_of_held_out_documents_are_not_looked_at(spark, scored):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(q.fold("doc_id") == q.HELD_OUT, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = q.score_quality(docs.withColumn("lang", F.lit("x")), flipped).toPandas().set_index("doc_id")["score"]
    assert np.allclose(again.loc[scored["doc_id"]], scored["score"])


def test_normal_equations_equal_numpy(spark):
    draw = np.random.default_rng(1)
    stats = draw.normal(size=(200, len(q.STATISTICS)))
    y, fold = draw.integers(0, 2, 200), draw.integers(1, 5, 200)
    made = q.Features(np.zeros(stats.shape[1]), np.ones(stats.shape[1]), draw.normal(size=(stats.shape[1], 6)), draw.uniform(0, 6, 6))
    rows = spark.createDataFrame([(int(f), s.tobytes(), float(t), 2) for f, s, t in zip(fold, stats, y)], "fold int, stats binary, y double, n long")
    sums = q.normal_equations(rows.repartition(4), made)
    for k in range(1, 5):
        import pandas as pd

        x = made(pd.Series([s.tobytes() for s in stats[fold == k]]))
        assert np.allclose(sums[k][:, :-1], 2 * x.T @ x)
        assert np.allclose(sums[k][:, -1], 2 * x.T @ y[fold == k])


def test_features_approximate_a_gaussian_kernel():
    import pandas as pd

    draw = np.random.default_rng(2)
    wide, many = len(q.STATISTICS), 20_000
    made = q.Features(np.zeros(wide), np.ones(wide), draw.normal(size=(wide, many)) / np.sqrt(wide), draw.uniform(0, 2 * np.pi, many))
    points = draw.normal(size=(5, wide))
    x = made(pd.Series([p.tobytes() for p in points]))[:, :-1]
    far = ((points[:, None] - points) ** 2).sum(axis=2) / wide
    assert np.allclose(x @ x.T, np.exp(-far / 2), atol=0.05)


def test_isotonic_is_the_closest_rising_curve():
    draw = np.random.default_rng(3)
    for _ in range(50):
        sizes = draw.integers(1, 5, 12)
        means = draw.uniform(0, 1, 12)
        fit = q.isotonic(sizes, sizes * means)
        # Greatest of the least averages: the closed form of isotonic regression.
        want = [
            max(min(np.average(means[i : j + 1], weights=sizes[i : j + 1]) for j in range(k, 12)) for i in range(k + 1))
            for k in range(12)
        ]
        assert np.allclose(fit, want)


def test_statistics_are_finite_for_any_text():
    for text in [None, "", " ", "\n\n", "a", "!!!", "😀" * 9, "\ud800", "word " * 200_000, "x" * 10**6, "1\x002"]:
        found = q.statistics(text)
        assert len(found) == len(q.STATISTICS) and np.isfinite(found).all()
    assert (q.statistics(None) == 0).all()


def test_edge_cases(spark):
    schema = "doc_id long, text string, score string, stats string, fold string, id string"
    rows = [(i, "plain words here." if i % 2 else "## !! ##", "s", "t", "f", "i") for i in range(60)]
    rows += [(None, "plain words here.", None, None, None, None), (70, None, "", "", "", ""), (71, "", "", "", "", ""), (1, "plain words here.", "s", "t", "f", "i")]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(60)] + [(None, 1), (2, None), (999, 1), (3, 1), (3, 1)], "doc_id long, quality int"
    )
    found = q.score_quality(docs, labels, keep=docs.columns).toPandas()
    assert list(found.columns) == ["doc_id", "text", "stats", "fold", "id", "held_out", "score", "predicted"]
    assert len(found) == len(rows)
    of = found.groupby("text")["score"].first()
    assert of["plain words here."] > 0.9 and of["## !! ##"] < 0.1
    assert not found[found["doc_id"].isna()]["held_out"].any()


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in q.score_quality(docs, none).collect()} == {0.5}
    assert q.score_quality(docs.where("false"), none).collect() == []
