"""Kernel ridge scores: sums, calibration, held-out accuracy, odd inputs."""

import random

import numpy as np
from llm.helpers import no_documents, odd_documents, with_clashes
from pyspark.sql import functions as F

from quayside.llm import quality, queries
from quayside.llm.words import labelled


def test_fourier_features_approach_the_kernel():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(200, 5))
    features = quality.Fourier(rows, features=6000)
    z = features(rows)[:, :-1]
    scaled = features.scaled(rows)
    width = 1 / features.weights.std()
    kernel = np.exp(-((scaled[:, None] - scaled[None]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(z @ z.T - kernel).max() < 0.08


def test_ridge_sums_over_partitions(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, quality.WIDTH)).astype(np.float32)
    y = (x[:, 0] > 0).astype(int)
    fourier = quality.Fourier(x.astype(np.float64), features=30)
    rows = [(row.tolist(), int(v)) for row, v in zip(x, y)]
    examples = spark.createDataFrame(rows, "x array<float>, y int").repartition(7)
    z, w = fourier(x.astype(np.float64)), np.where(y > 0, 2.0, 1.0)
    square = (z * w[:, None]).T @ z
    direct = np.linalg.solve(square + quality.RIDGE * np.trace(square) / 31 * np.eye(31), z.T @ (w * y))
    assert np.allclose(quality.ridge(examples, fourier, (1.0, 2.0)), direct)


def test_isotonic_is_the_best_rising_fit():
    rng = random.Random(3)
    for _ in range(50):
        n = rng.randint(1, 12)
        x, y = np.arange(n, dtype=float), np.array([rng.randint(0, 1) for _ in range(n)], float)
        centres, means = quality.isotonic(x, y)
        assert (np.diff(means) > 0).all() and (np.diff(centres) > 0).all()
        # Max-min formula of the isotonic fit.
        fit = [max(min(y[a : b + 1].mean() for b in range(k, n)) for a in range(k + 1)) for k in range(n)]
        assert sorted(set(np.round(fit, 9))) == sorted(set(np.round(means, 9)))


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    scored = queries.queries()["op4_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 100 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    bad, good = ([r.score for r in rows if r.quality == q] for q in (0, 1))
    assert np.mean([b < g for b in bad for g in good]) > 0.97


def test_held_out_labels_are_not_used(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = queries.remainder("doc_id", 3) == 1
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y")})
    one = {(r.doc_id, r.score) for r in quality.score(docs, labels, held).collect()}
    assert one == {(r.doc_id, r.score) for r in quality.score(moved, flipped, held).collect()}


def test_odd_inputs(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = with_clashes(odd_documents(spark), "quality", "score", "y")
    held = queries.remainder("doc_id", 3) == 1
    labels = labels.unionByName(labels.selectExpr("cast(null as bigint) as doc_id", "quality", "cast(null as int) as toxic").limit(2))
    rows = quality.score(docs, labels, held).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert {r.score for r in quality.score(docs, labels.limit(0), held).collect()} == {0.5}
    assert quality.score(no_documents(spark), labels, held).count() == 0


def test_a_repeated_key_trains_once(spark, sf_dir):
    """However often a key is labelled or its document repeated, it is one example, with the label of most of its rows."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = queries.remainder("doc_id", 3) == 1
    first = labels.where(~held).orderBy("doc_id").limit(1)
    again = first.crossJoin(spark.range(100_000)).drop("id")
    other = first.withColumn("quality", 1 - F.col("quality"))
    known = labelled(labels.union(again).union(other), "doc_id", "quality", held)
    assert {tuple(r) for r in known.collect()} == {tuple(r) for r in labelled(labels, "doc_id", "quality", held).collect()}
    tie = labelled(first.union(other), "doc_id", "quality", held).collect()
    assert [r.y for r in tie] == [1]
    copies = docs.union(docs.join(first.select("doc_id"), "doc_id", "left_semi").crossJoin(spark.range(50)).drop("id"))
    one, two = ({(r.doc_id, round(r.score, 9)) for r in quality.score(d, x, held).collect()} for d, x in ((docs, labels), (copies, labels.union(again))))
    assert one == two
