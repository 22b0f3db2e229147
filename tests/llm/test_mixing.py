"""Targets, flow and selection of a mix."""

import random
from fractions import Fraction
from itertools import product

import pytest
from compare import differences
from llm.helpers import DOCUMENT, no_documents, odd_documents, prose, with_clashes
from pyspark.sql import functions as F

from quayside.llm import mixing, queries, sql


def test_targets_share_by_weight_and_stop_at_twice_the_size():
    sizes = {"a": 10, "b": 1000, "c": 500, None: 40}
    found = mixing.targets(sizes, sum(sizes.values()))
    assert found["a"] == 20 and found[None] == 80 and sum(found.values()) == Fraction(3, 2) * 1550
    assert found["c"] == 1000 and found["b"] == Fraction(3, 2) * 1550 - 1100
    assert mixing.targets({}, 0) == {} and mixing.targets({"a": 0}, 0) == {"a": 0}
    even = mixing.targets({"c": 100, "a": 100, "b": 100}, 300)
    assert even["a"] == 200 and even["b"] + even["c"] == 250 and even["c"] == 2 * even["b"]


def plain_route(members, total, quota, most):
    """All ways to take whole words, for tiny instances: the largest total, then the least repetition."""
    best = None
    edges = [(p, s) for p, own in members.items() for s in own]
    for amounts in product(*[range(min(most * total[p], quota[s]) + 1) for p, s in edges]):
        by_pattern = {p: sum(a for a, (q, _) in zip(amounts, edges) if q == p) for p in members}
        by_source = {s: sum(a for a, (_, r) in zip(amounts, edges) if r == s) for s in quota}
        if any(by_pattern[p] > most * total[p] for p in members) or any(by_source[s] > quota[s] for s in quota):
            continue
        cost = sum(max(0, n - total[p] * k) * 1 for p, n in by_pattern.items() for k in range(1, most))
        best = max(best or (-1, 0), (sum(amounts), -cost))
    return best


@pytest.mark.parametrize("seed", range(8))
def test_flow_is_largest_and_repeats_least(seed):
    rng = random.Random(seed)
    members = {"x": ("a",), "y": ("a", "b"), "z": ("b",)}
    total = {p: rng.randint(0, 3) for p in members}
    quota = {"a": rng.randint(0, 6), "b": rng.randint(0, 6)}
    given = mixing.route(members, total, quota, 2)
    cost = sum(max(0, n - total[p]) for p, n in given.items())
    assert (sum(given.values()), -cost) == plain_route(members, total, quota, 2)


def corpus(spark, n=600):
    rng = random.Random(2)
    rows = [(k, prose(rng, rng.randint(1, 60)), "en", rng.choice(["a", "a", "a", "b", "c", "Z", None]), 1) for k in range(n)]
    return spark.createDataFrame(rows, DOCUMENT)


def test_sources_come_near_their_targets(spark):
    docs = corpus(spark)
    mixed = mixing.mix(docs, F.array("source"))
    rows = mixed.join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(rows) == docs.count() and all(r.taken in (0, r.size, 2 * r.size) for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert {r.source_size for r in own} == {sum(r.size for r in own)}
        assert abs(sum(r.taken for r in own) - own[0].target) <= 30
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    again = mixing.mix(docs.repartition(3), F.array("source"))
    assert mixed.exceptAll(again).isEmpty()
    other = mixing.mix(docs, F.array("source"), seed=1)
    assert not mixed.exceptAll(other).isEmpty()


def test_selection_equals_a_plain_walk_through_the_order(spark):
    """Rests of every size, by sorting all documents of a pattern."""
    rng = random.Random(3)
    rows = [(f"p{k % 3}", rng.randint(0, 9), f"{rng.getrandbits(128):032x}") for k in range(900)]
    sized = spark.createDataFrame(rows, "pattern string, size bigint, place string")
    rests = {"p0": 1, "p1": 700, "p2": sum(s for p, s, _ in rows if p == "p2") - 1}
    wanted = spark.createDataFrame(list(rests.items()), "pattern string, rest bigint")
    last = {r.pattern: r["last"] for r in mixing.edge_places(sized, wanted).collect()}
    for pattern, rest in rests.items():
        taken, before = [], 0
        for _, size, place in sorted((r for r in rows if r[0] == pattern and r[1]), key=lambda r: r[2]):
            if before + size <= rest or before < rest and before + size - rest < rest - before:
                taken.append(place)
            before += size
        got = sorted(r[2] for r in rows if r[0] == pattern and r[1] and last[pattern] and r[2] <= last[pattern])
        assert got == taken


def test_overlapping_sources(spark):
    rng = random.Random(4)
    sets = [["a"], ["b"], ["a", "b"], ["b", "a", "a"], [None, "a"]]
    rows = [(k, prose(rng, 20), sets[k % 5]) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, sources array<string>")
    mixed = mixing.mix(docs, F.col("sources"))
    assert mixed.count() == 200 and mixed.where("taken > 2 * size").isEmpty()
    assert mixed.agg(F.sum("taken")).first()[0] == pytest.approx(1.5 * 4000, abs=100)


@pytest.mark.parametrize("share", [Fraction(3, 2), Fraction(2)])
def test_plan_of_many_patterns_equals_the_drivers(spark, monkeypatch, share):
    rng = random.Random(6)
    sets = [[f"s{k}"] for k in range(40)] + [[None], ["Z"], ["s1", "s2"], ["s2", "s3", "s3"], [None, "s4"], []]
    rows = [(k, prose(rng, rng.randint(0, 30) * (k % 7 > 0)), sets[rng.randrange(len(sets)) if k % 3 else 0]) for k in range(500)]
    rows += [(500 + k, "", [s]) for k, s in enumerate(["empty", "s3"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, sources array<string>")
    expected = mixing.mix(docs, F.col("sources"), share=share).collect()
    monkeypatch.setattr(mixing, "MOST_PATTERNS", 10)
    got = mixing.mix(docs, F.col("sources"), share=share).collect()
    assert {r.doc_id: r for r in got} == {r.doc_id: r for r in expected}
    monkeypatch.setattr(mixing, "MOST_PATTERNS", 5)
    with pytest.raises(ValueError):
        mixing.mix(docs, F.col("sources")).collect()


def test_more_sources_than_the_driver_takes(spark):
    docs = spark.range(200_000).selectExpr("id as doc_id", "repeat('w ', int(id % 5 + 1)) as text", "'s' || id as source")
    mixed = mixing.mix(docs, F.array("source"))
    off = F.abs(F.col("taken") - F.col("target")) - F.col("size") / 2
    n, target, size, most_off = mixed.agg(F.count("*"), F.sum("target"), F.sum("size"), F.max(off)).first()
    assert n == 200_000 and target == pytest.approx(1.5 * size) and most_off <= 0.5  # a quota is a whole number


def test_sample_stands_as_often_as_it_is_taken(spark):
    docs = corpus(spark, 200)
    times = {r.doc_id: r.taken // r.size for r in mixing.mix(docs, F.array("source")).collect() if r.size}
    got = mixing.sample(docs, F.array("source"))
    counts = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert got.columns == docs.columns and counts == {k: n for k, n in times.items() if n}


def test_odd_inputs(spark):
    docs = with_clashes(odd_documents(spark), "sources", "pattern", "place", "passes", "target", "taken")
    rows = mixing.mix(docs, F.array("source")).collect()
    assert len(rows) == docs.count() and all(r.taken == 0 for r in rows if r.size == 0)
    assert len({r.taken for r in rows if r.doc_id == 4}) == 1
    got = mixing.sample(docs, F.array("source"))
    assert got.columns == docs.columns and got.where("text is null").isEmpty()
    assert mixing.mix(no_documents(spark), F.array("source")).count() == 0
    assert mixing.sample(no_documents(spark), F.array("source")).count() == 0


def test_equals_sql(spark, sf_dir):
    assert differences(queries.queries()["op7_mixing"](spark, sf_dir), sql.MIXING, sf_dir) == []
