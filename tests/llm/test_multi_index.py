"""Recall of the multi-index against brute force, exact scores, ties, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import multi_index

SCHEMA = "vec_id bigint, embedding array<float>"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(None if i is None else int(i), None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors)], SCHEMA)


def results(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return found


def nearest(vectors, q, top):
    scores = vectors.astype(np.float32).astype(np.float64) @ vectors[q].astype(np.float32).astype(np.float64)
    order = np.lexsort((np.arange(len(vectors)), -np.round(scores, 12)))
    return [int(k) for k in order if k != q][:top], scores


@pytest.mark.parametrize("kind", ["spread", "clustered", "lengths"])
def test_recall(spark, kind):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 16))
    if kind == "clustered":
        vectors = rng.normal(size=(20, 16))[rng.integers(0, 20, 3000)] + 0.2 * vectors
    if kind != "lengths":
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    found = results(multi_index.search(frame(spark, vectors), F.col("vec_id") % 20 == 0, top=20))
    assert set(found) == set(range(0, 3000, 20))
    hits = 0
    for q, got in found.items():
        best, scores = nearest(vectors, q, 20)
        assert len(got) == 20 and q not in dict(got)
        assert all(score == pytest.approx(scores[v], abs=1e-12) for v, score in got)
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        hits += len(set(best) & set(dict(got)))
    assert hits / (20 * len(found)) >= 0.9


def test_equal_vectors_go_by_id(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1500, 8))
    vectors[::2] = vectors[0]
    found = results(multi_index.search(frame(spark, vectors), F.col("vec_id") % 100 == 0, top=10))
    for q, got in found.items():
        best, scores = nearest(vectors, q, 10)
        if scores[best[0]] == pytest.approx(scores[0] if q else scores[2]):
            assert [v for v, _ in got] == best


def test_repeated_rows_and_ids(spark):
    """Rows repeated, ids with several vectors, queries among both; every neighbour is found once."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(800, 8)).astype(np.float32)
    ids = list(range(800))
    rows, own = list(vectors), list(ids)
    for k in (0, 20, 21, 40, 41, 42):
        rows += [vectors[k]] * 5
        own += [k] * 5
    others = {60: rng.normal(size=8), 61: rng.normal(size=8), 100: rng.normal(size=8)}
    for k, other in others.items():
        rows += [other.astype(np.float32)] * 3
        own += [k] * 3
    rows += [vectors[7]] * 300
    own += [7] * 300
    found = results(multi_index.search(frame(spark, rows, own), F.col("vec_id") % 20 == 0, top=20))
    for k, other in others.items():
        vectors[k] = min(tuple(vectors[k]), tuple(other.astype(np.float32)))
    assert set(found) == set(range(0, 800, 20))
    hits = 0
    for q, got in found.items():
        best, scores = nearest(vectors, q, 20)
        assert len({v for v, _ in got}) == len(got) == 20 and q not in dict(got)
        assert all(score == pytest.approx(scores[v], abs=1e-9) for v, score in got)
        hits += len(set(best) & set(dict(got)))
    assert hits / (20 * len(found)) >= 0.9


def test_few_entries_give_all(spark):
    vectors = np.eye(4)[:, :4] + 0.5
    found = results(multi_index.search(frame(spark, vectors), F.col("vec_id") == 1, top=20))
    assert sorted(v for v, _ in found[1]) == [0, 2, 3]


def test_cells_are_walked_from_the_best(spark):
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(400, 6))
    book = multi_index.Codebook(np.arange(400), sample, 7)
    counts = np.zeros((7, 7), np.int64)
    np.add.at(counts, (book.a, book.b), 1)
    query = rng.normal(size=6)
    sums = (book.first @ query[:3])[:, None] + (book.second @ query[3:])[None]
    depth = book.walk(query, counts, np.inf, 30)
    order = book.order(query[None])[0]
    seen = {(i, int(j)) for i, n in depth.items() for j in order[:n]}
    unseen = {(i, j) for i in range(7) for j in range(7)} - seen
    assert sum(counts[c] for c in seen) > 30 and min(sums[c] for c in seen) >= max(sums[c] for c in unseen)


def test_odd_inputs(spark):
    rng = np.random.default_rng(4)
    vectors = [list(v) for v in rng.normal(size=(60, 4))]
    bad = [None, [], [0.0] * 4, [1.0, None, 0.0, 1.0], [float("nan")] * 4, [float("inf"), 0, 0, 0]]
    ids = [*range(60), 100, 120, 140, 160, 180, 200, None, 5]
    df = frame(spark, [*vectors, *bad, vectors[0], vectors[0]], ids)
    df = df.selectExpr("*", "'a' as id", "'b' as vector", "1 as page", "2 as asks", "3 as floor")
    found = results(multi_index.search(df, F.col("vec_id") % 20 == 0, top=70))
    assert set(found) == {0, 20, 40}
    assert all(len({v for v, _ in got}) == len(got) == 59 and q not in dict(got) for q, got in found.items())  # id 5 once
    nothing = multi_index.search(df.where("vec_id > 90"), F.col("vec_id") % 20 == 0)
    assert nothing.count() == 0 and nothing.columns == ["query_id", "rank", "vec_id", "score"]
    assert multi_index.search(frame(spark, vectors), F.lit(False)).count() == 0
    with pytest.raises(ValueError, match="lengths"):
        multi_index.search(frame(spark, [[1.0], [1.0, 2.0]]), F.lit(True))
