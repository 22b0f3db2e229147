"""Fingerprints, links and groups against brute force."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm.helpers import DOCUMENT, no_documents, odd_documents, prose, with_clashes
from pyspark.sql import functions as F

from quayside.llm import queries, simhash


def plain_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=4):
    """The smallest index that chains of links reach, by comparing all pairs."""
    group = list(range(len(prints)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = sorted((root(a), root(b)))
            group[y] = x
    return [root(k) for k in range(len(prints))]


def near(rng, fp, most):
    for bit in rng.sample(range(64), rng.randint(0, most)):
        fp ^= 1 << bit
    return fp


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "a b c d", "A b c D e f\tg", "é É ß\u2003x y z " * 9, "a " * 500])
def test_fingerprint(text):
    assert simhash.simhash(text.encode(), 4) % (1 << 64) == plain_fingerprint(text)


def test_long_fingerprint():
    text = prose(random.Random(1), 70_000 // 100)
    assert simhash.simhash(text.encode(), 4) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("n", [10, 10**6, 10**8])
def test_every_link_shares_a_shard(n):
    rng, masks = random.Random(4), simhash.block_masks(n, 4)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = near(rng, a, 4)
        assert any(a & m == b & m for m in masks)


def test_tree_search_finds_all_within_the_radius():
    rng = random.Random(6)
    units = [np.unique(np.array([near(rng, c, 7) for c in [rng.getrandbits(64)] for _ in range(60)], np.uint64)) for _ in range(5)]
    unit = np.repeat(np.arange(5), [len(u) for u in units])
    fp = np.concatenate(units)
    tree = simhash.grow_trees(unit, fp)
    found = {(int(a), int(b)) for q, t in simhash.search_trees(tree, fp, fp, unit, 4) for a, b in zip(q, t)}
    close = {
        (a, b) for a in range(len(fp)) for b in range(len(fp))
        if unit[a] == unit[b] and (int(fp[a]) ^ int(fp[b])).bit_count() <= 4
    }
    assert found == close


@pytest.mark.parametrize("shard_rows", [5, 1024])
def test_links_connect_what_brute_force_connects(spark, shard_rows):
    """Chains and dense groups, whole shards and shards cut into pieces."""
    rng = random.Random(8)
    prints = [near(rng, c, 5) for c in [rng.getrandbits(64) for _ in range(40)] for _ in range(12)]
    for _ in range(100):
        prints.append(near(rng, prints[-1], 4))
    prints = sorted(set(prints), key=lambda p: p - (1 << 64) if p >> 63 else p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    grouped = simhash.components(simhash.links(distinct, 4, shard_rows))
    roots = {r.fp: r.root for r in grouped.collect()}
    assert [roots.get(p, p) for p in signed] == [signed[k] for k in plain_groups(prints)]


def test_units_are_worked_through_across_batches():
    rng = random.Random(9)
    rows = [(0, k, 0, 0, near(rng, k << 40, 3) - (1 << 63), True, True) for k in range(30) for _ in range(7)]
    names = ["mask", "bits", "i", "j", "fp", "in_tree", "asks"]
    table = pa.table([pa.array(c) for c in zip(*dict.fromkeys(rows))], names=names)

    def edges(size):
        batches = table.to_batches(max_chunksize=size)
        return {tuple(x.values()) for b in simhash._whole_units(iter(batches), 4) for x in b.to_pylist()}

    assert edges(5) == edges(10_000) != set()


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 60)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    edges = spark.createDataFrame([*chain, *star, (5, 5)], "a bigint, b bigint")
    roots = {r.fp: r.root for r in simhash.components(edges).collect()}
    assert roots == {**{k: 0 for k in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 300)}}
    assert simhash.components(edges.where("a < 0")).count() == 0


def test_busy_centre_is_spread(spark):
    """A star above the bound gives the same groups, and its rows are not shuffled by the centre."""
    n = 15_000
    star = spark.range(n).selectExpr("7 as a", "id + 100 as b")
    few = spark.createDataFrame([(7, 1, n), (8, 2, 3)], "a bigint, m bigint, held bigint")
    joined = simhash.met(star.union(spark.createDataFrame([(8, k) for k in (1, 2, 3)], "a bigint, b bigint")), few, "a")
    assert {tuple(r) for r in joined.groupBy("a", "m").count().collect()} == {(7, 1, n), (8, 2, 3)}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
    roots = simhash.components(star).collect()
    assert len(roots) == n and {r.root for r in roots} == {7}


def corpus(spark):
    rng = random.Random(10)
    rows = []
    for k in range(40):
        words = prose(rng, 150).split()
        for copy in range(rng.choice([1, 1, 2, 5])):
            changed = list(words)
            if copy:
                changed[rng.randrange(len(words))] = "other"
            rows.append((len(rows) * 7 % 911, " ".join(changed), "en", "s", 1))
    return spark.createDataFrame(rows, DOCUMENT)


def test_query_equals_brute_force(spark):
    docs = corpus(spark)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = plain_groups(prints)
    expected = {(rows[k][0], f"{prints[k]:016x}", rows[groups[k]][0]) for k in range(len(rows))}
    assert {tuple(r) for r in simhash.near_duplicates(docs).collect()} == expected


def test_hot_keys_change_nothing(spark, monkeypatch):
    docs = corpus(spark).union(corpus(spark).where("doc_id < 90"))
    expected = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    monkeypatch.setattr(simhash, "LEAST_HOT", 1)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == expected


def test_one_document_of_each_group_stays(spark):
    docs = corpus(spark)
    named = simhash.near_duplicates(docs)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in named.collect()}
    assert kept.count() == named.select("component_id").distinct().count()


def test_odd_inputs(spark):
    docs = with_clashes(odd_documents(spark), "fp", "whole", "fingerprint", "component_id", "rank", "copies")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    empty = [r for r in rows if r.fingerprint == "0" * 16]
    assert len(empty) == 4 and {r.component_id for r in empty} == {1}
    assert [r.component_id for r in rows if r.doc_id in (4, 5)] == [4, 4, 4]
    assert {r.component_id for r in rows if r.doc_id is None} == {None, 1}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4]
    assert simhash.near_duplicates(no_documents(spark)).count() == 0 == simhash.keep_one(no_documents(spark)).count()


def test_registered(spark, sf_dir):
    found = queries.queries()["op2_simhash"](spark, sf_dir)
    assert found.columns == ["doc_id", "fingerprint", "component_id"] and found.where(F.col("component_id") > F.col("doc_id")).isEmpty()
