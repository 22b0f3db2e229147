"""Distributed order statistics against brute force."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from quayside.functions import ordering


@pytest.fixture(params=[(3, 16, 256), (256, 1, 7), (256, 16, 256)])
def slices(request, monkeypatch):
    for name, value in zip(("SLICES", "DRAWS", "WIDE"), request.param):
        monkeypatch.setattr(ordering, name, value)


def test_slices_follow_the_number_of_keys(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SLICES", 2)
    monkeypatch.setattr(ordering, "PER_SLICE", 50)
    for n in (0, 1, 90, 20_000):
        keyed = ordering.sliced(spark.range(n).selectExpr("id * 7 % 20011 as v").union(spark.sql("select null")), "v")
        found = keyed.groupBy("_slice").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        rows = found.orderBy("_slice").collect()
        assert sum(r.n for r in rows) == n + 1 and max(r.n for r in rows) <= max(150, 50 * (n < 100))
        assert len(rows) >= n / 150 and all(a.high < b.low for a, b in zip(rows, rows[1:]))


def test_running_total(spark, slices):
    rng = random.Random(1)
    rows = [(k, f"v{v:05d}", rng.randint(1, 9)) for k in "ab" for v in rng.sample(range(10**5), 700)]
    df = spark.createDataFrame([*rows, ("a", None, 4)], "kind string, v string, w bigint")
    got = ordering.running_total(df, "v", F.col("w"), "total", within=["kind"]).collect()
    expected, upto = {}, {"a": 4, "b": 0}
    for kind, value, weight in sorted(rows):
        upto[kind] += weight
        expected[kind, value] = upto[kind]
    expected["a", None] = 4
    assert {(r["kind"], r["v"]): r["total"] for r in got} == expected


def test_running_total_has_no_unpartitioned_window(spark):
    df = spark.createDataFrame([(1.0, 1)], "v double, w bigint")
    total = ordering.running_total(df, "v", F.col("w"), "total")
    plan = total._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Over the slices and inside each slice.
    assert len(windows) == 2 and any("[_slice" in w for w in windows)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999, 1000])
def test_weighted_median(spark, n):
    rng = random.Random(n)
    rows = [(round(rng.gauss(30, 20), 1), rng.randint(1, 5)) for _ in range(n)]
    df = spark.createDataFrame([*rows, (None, 50)], "v double, w bigint")
    every = [v for v, w in rows for _ in range(w)]
    assert ordering.weighted_median(df, "v", "w").first()["median"] == pytest.approx(statistics.median(every), abs=1e-12)


def test_weighted_median_with_one_value_on_most_rows(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 10**12), (1e300, 1)], "v double, w bigint")
    assert ordering.weighted_median(df, "v", "w").first()["median"] == 2.0


def test_weighted_median_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "v double, w bigint")
    assert ordering.weighted_median(df, "v", "w").first()["median"] is None


@pytest.mark.parametrize("fraction", [1.0, 0.8, 0.5, 0.0])
def test_label_cuts_take_exact_shares(spark, fraction):
    rows = [(f"S{i}", i % 3 == 0) for i in range(5001)] + [("only", None)]
    df = spark.createDataFrame(rows, "id string, label boolean").withColumn("h", ordering.hash_order("id", 42))
    cuts = {r["label"]: r["cut"] for r in ordering.label_cuts(df.where("label is not null"), "label", "h", fraction).collect()}
    for label in (True, False):
        hashes = [hashlib.md5(f"{i}-42".encode()).hexdigest() for i, l in rows if l is label]
        assert sum(h <= cuts[label] for h in hashes) == int(fraction * len(hashes))
