"""Near-duplicates by SimHash: fingerprints, BK-trees over shards of them, and the groups that links form.

A fingerprint bit is 1 if it is set in over half the hashes of a text's shingles. Two fingerprints link if at most
``radius`` bits differ. The 64 bits are cut into blocks; fingerprints within the radius agree on all but ``radius``
of them, so for every choice of the agreeing blocks those that share their bits form a shard, and no link is
missed. Each shard has a BK-tree (children keyed by their distance to the parent) that is searched with the
shard's own fingerprints, following only edges within the radius of the distance just met.

Scale. Equal fingerprints are merged before sharding, so exact copies cost one row. The number of blocks follows the
number of fingerprints, so that shards stay small. A shard above ``shard_rows`` is cut into pieces, and every pair of
pieces becomes a unit of its own. A unit returns a spanning forest of its links, never its pairs. Links of all units
are merged by star contraction, each round written to the shared folder. Keys with over a ``SHARES``-th of the rows,
such as the centre of a large group or a text with very many copies, are joined as a broadcast of less than ``SHARES``
rows, so no task receives all rows of one.

Results for odd input: a null or empty text, or one of blanks, has fingerprint 0 and links like any other. Rows are
never merged in the result: repeated rows appear as often as they come. A null key counts for nothing in the
smallest key of its group; a group with null keys alone has a null one. An empty table gives an empty one. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.words import row_hash, whole
from quayside.session import stage

SEED = 42
PAIRS_AT_ONCE = 1 << 22
SHARES, LEAST_HOT = 1_000, 1_000


def simhash(data: bytes, width: int) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit number."""
    tokens = data.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    n = len(tokens)
    if n == 0:
        return 0
    joined = b" ".join(tokens)
    if n <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, tokens), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        cuts = map(slice, (ends - lengths)[: n - width + 1].tolist(), ends[width - 1 :].tolist())
        shingles = map(joined.__getitem__, cuts)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n - width + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        octets = hashes[start : start + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 4, **keys) -> DataFrame:
    """One row per document: the columns ``keys`` (by name) and ``fp``."""
    names = list(keys)
    chosen = docs.select(*[c.alias(name) for name, c in keys.items()], whole(text).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(x.as_buffer().to_pybytes(), width) for x in batch.column("_text")]
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.int64())], names=[*names, "fp"])

    kept = ", ".join(f"{name} {kind}" for name, kind in chosen.dtypes[:-1])
    return chosen.mapInArrow(run, f"{kept}, fp bigint")


# Links ----------------------------------------------------------------------------------------------------


def block_masks(n_fingerprints: int, radius: int, per_shard: int = 256) -> list[int]:
    """Masks of the bits on which linked fingerprints may agree; every linked pair agrees under at least one.

    More blocks give more masks of more bits each. The fewest blocks are taken that make an average shard of
    spread-out fingerprints no larger than ``per_shard``.
    """
    for blocks in range(radius + 1, radius + 6):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
        masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
        if n_fingerprints <= per_shard << min(m.bit_count() for m in masks):
            break
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def units(distinct: DataFrame, masks: list[int], shard_rows: int) -> DataFrame:
    """``fp`` once for each unit it belongs to: columns ``mask, bits, i, j, fp, in_tree, asks``."""
    shards = [F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for k, m in enumerate(masks)]
    keyed = distinct.select("fp", F.inline(F.array(*shards)))
    large = keyed.groupBy("mask", "bits").agg(F.count("*").alias("_n")).where(F.col("_n") > shard_rows)
    pieces = F.coalesce(F.ceil(F.col("_n") / shard_rows), F.lit(1)).cast("int")
    piece = F.pmod(F.xxhash64("fp", F.lit(7)), pieces).cast("int")
    # Piece p meets each other piece once: in unit (p, j) for j >= p its tree is searched, in (i, p) it asks.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_pieces") - 1),
        lambda other: F.struct(
            F.least(other, F.col("_piece")).alias("i"),
            F.greatest(other, F.col("_piece")).alias("j"),
            (F.col("_piece") <= other).alias("in_tree"),
            (F.col("_piece") >= other).alias("asks"),
        ),
    )
    return (
        keyed.join(large, ["mask", "bits"], "left")
        .withColumn("_pieces", pieces)
        .withColumn("_piece", piece)
        .select("mask", "bits", "fp", F.inline(pairs))
    )


def grow_trees(unit: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of all units at once: the root row per unit, and edges ``row * 65 + distance`` with their child.

    ``unit`` counts up from 0 without gaps and is sorted; fingerprints of a unit differ.
    """
    root = np.searchsorted(unit, np.arange(unit[-1] + 1)) if len(unit) else np.zeros(0, np.int64)
    rows = np.setdiff1d(np.arange(len(unit)), root, assume_unique=True)
    at, edges, children = root[unit[rows]], [], []
    while len(rows):
        edge = at * 65 + np.bitwise_count(fp[rows] ^ fp[at])
        new, first, group = np.unique(edge, return_index=True, return_inverse=True)
        edges.append(new)
        children.append(rows[first])
        down = np.ones(len(rows), bool)
        down[first] = False
        at, rows = rows[first][group][down], rows[down]
    if not edges:
        return root, np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge, child = np.concatenate(edges), np.concatenate(children)
    order = np.argsort(edge)
    return root, edge[order], child[order]


def search_trees(
    tree: tuple[np.ndarray, np.ndarray, np.ndarray], fp: np.ndarray, asks: np.ndarray, unit: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (asking row, tree row) within the radius, itself included, in parts."""
    root, edge, child = tree
    query, node = np.arange(len(asks)), root[unit]
    while len(query):
        distance = np.bitwise_count(asks[query] ^ fp[node]).astype(np.int64)
        near = distance <= radius
        yield query[near], node[near]
        low = np.searchsorted(edge, node * 65 + np.maximum(distance - radius, 0))
        n = np.searchsorted(edge, node * 65 + np.minimum(distance + radius, 64), "right") - low
        query, within = np.repeat(query, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        node = child[np.repeat(low, n) + within]


def spanning_stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows reaches over the links ``a - b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _unit_links(rows: pa.Table, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (fingerprint, smaller row's fingerprint) of some whole units, sorted by unit."""
    key = [rows.column(c).to_numpy() for c in ("mask", "bits", "i", "j")]
    fp = rows.column("fp").to_numpy().astype(np.int64).view(np.uint64)
    starts = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)])
    unit = np.cumsum(starts) - 1
    in_tree, asks = (np.flatnonzero(rows.column(c).to_numpy(zero_copy_only=False)) for c in ("in_tree", "asks"))
    # Units in which nothing can meet need no tree.
    both = (np.bincount(unit[in_tree], minlength=unit[-1] + 1) > 0) & (np.bincount(unit, minlength=unit[-1] + 1) > 1)
    in_tree, asks = in_tree[both[unit[in_tree]]], asks[both[unit[asks]]]
    if not len(in_tree):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    dense = np.cumsum(both) - 1
    tree = grow_trees(dense[unit[in_tree]], fp[in_tree])
    found = list(search_trees(tree, fp[in_tree], fp[asks], dense[unit[asks]], radius))
    a = asks[np.concatenate([q for q, _ in found])]
    b = in_tree[np.concatenate([t for _, t in found])]
    label = spanning_stars(len(fp), a, b)
    other = np.flatnonzero(label != np.arange(len(fp)))
    return fp[other].view(np.int64), fp[label[other]].view(np.int64)


def _whole_units(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Works through a partition sorted by unit, so many whole units at a time as give a bounded number of pairs."""
    rest: pa.Table | None = None

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key = [rows.column(c).to_numpy() for c in ("mask", "bits", "i", "j")]
        starts = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)]))
        sizes = np.diff(np.append(starts, rows.num_rows))
        part = np.cumsum(sizes.astype(np.int64) ** 2) // PAIRS_AT_ONCE
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            a, b = _unit_links(rows.slice(starts[own[0]], int(sizes[own].sum())), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        key = [rows.column(c).to_numpy() for c in ("mask", "bits", "i", "j")]
        last = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0))
        done = int(last[-1]) + 1 if len(last) else 0
        if done:
            yield from work(rows.slice(0, done))
        rest = rows.slice(done)
    if rest is not None and rest.num_rows:
        yield from work(rest)


def links(distinct: DataFrame, radius: int = 4, shard_rows: int = 1024) -> DataFrame:
    """Edges ``a, b`` between fingerprints that connect exactly those that chains of links connect.

    ``distinct`` has each fingerprint once, in column ``fp``; it is read several times.
    """
    masks = block_masks(distinct.count(), radius)
    key = ["mask", "bits", "i", "j"]
    dealt = units(distinct, masks, shard_rows).repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(lambda batches: _whole_units(batches, radius), "a bigint, b bigint").distinct()


# Groups ---------------------------------------------------------------------------------------------------


def met(many: DataFrame, few: DataFrame, on: str) -> DataFrame:
    """``many`` with the row of ``few`` under the same ``on``, for keys that both have.

    ``few`` has every key once, with the number of its rows in ``many`` as ``held``. Less than ``SHARES`` keys can have over
    a ``SHARES``-th of all rows, however many there are; these are broadcast, and only the others are shuffled.
    """
    total, most = few.agg(F.coalesce(F.sum("held"), F.lit(0)), F.coalesce(F.max("held"), F.lit(0))).first()
    bound = max(total // SHARES, LEAST_HOT)
    if most <= bound:
        return many.join(few, on)
    hot = F.broadcast(few.where(F.col("held") > bound))
    others = many.join(hot.select(on), on, "left_anti")
    return many.join(hot, on).unionByName(others.join(few.where(F.col("held") <= bound), on))


def components(edges: DataFrame) -> DataFrame:
    """Per node of the undirected ``edges`` (a, b): the smallest node it is connected with, as ``fp, root``.

    Star contraction: every node hands its larger neighbours, then its smaller ones, to the smallest neighbour,
    until each component is one star. A node's minimum is aggregated in the tasks first and joined back, by ``met`` where
    a node has very many neighbours, so it is no group in one task.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    star = stage(edges.where("a <> b").select(larger, smaller).distinct(), "links")
    lowest = F.min("v").alias("m"), F.count("*").alias("held")
    seen = None
    while True:
        state = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return star.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        seen = state
        both = star.union(star.select("v", "u"))
        least = both.groupBy("u").agg(*lowest).withColumn("m", F.least("m", "u"))
        large = met(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(*lowest)
        small = met(large, least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = stage(small.union(least.select("u", "m")).distinct(), "small-star")


def group_of_fingerprint(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Per distinct ``fp`` its group, named by the smallest fingerprint in it: ``fp, root``."""
    distinct = stage(prints.select("fp").distinct(), "fingerprints")
    grouped = components(links(distinct, radius))
    return distinct.join(grouped, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """Per row of ``docs``: key, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key of its group."""
    prints = stage(fingerprints(docs, text, width, key=F.col(key)), "simhash")
    groups = group_of_fingerprint(prints, radius)
    own = prints.groupBy("fp").agg(F.min("key").alias("low"), F.count("*").alias("copies"))
    own = stage(own.join(groups, "fp"), "simhash-groups")
    smallest = own.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("held"))
    named = met(own, smallest, "root").select("fp", "component_id", F.col("copies").alias("held"))
    return met(prints, stage(named, "simhash-names"), "fp").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each group: the one of the smallest key, a null key last; of equal rows one."""
    prints = stage(fingerprints(docs, text, width, key=F.col(key), whole=row_hash(docs)), "simhash")
    groups = stage(group_of_fingerprint(prints, radius), "simhash-groups")
    rank = F.struct(F.col("key").isNull().alias("no_key"), "key", "whole").alias("rank")
    per_print = prints.groupBy("fp").agg(F.min(rank).alias("rank")).join(groups, "fp")
    first = per_print.groupBy("root").agg(F.min("rank").alias("rank")).select("rank.key", "rank.whole")
    # Rows equal in every column cannot be told apart: count them, and thin out only those.
    counted = prints.groupBy("key", "whole").agg(F.count("*").alias("copies"))
    same = F.col("c.key").eqNullSafe(F.col("f.key")) & (F.col("c.whole") == F.col("f.whole"))
    first = stage(first.alias("f").join(counted.alias("c"), same).select("f.key", "f.whole", "copies"), "simhash-kept")

    columns = [F.col(f"`{c}`") for c in docs.columns]
    held = docs.select(F.struct(*columns).alias("_row"), F.col(key).alias("_key"), row_hash(docs).alias("_whole"))
    here = F.col("_key").eqNullSafe(F.col("key")) & (F.col("_whole") == F.col("whole"))
    single = held.join(first.where("copies = 1"), here, "left_semi")
    if first.where("copies > 1").isEmpty():
        return single.select("_row.*")
    several = held.join(first.where("copies > 1"), here, "left_semi").dropDuplicates(["_key", "_whole"])
    return single.unionByName(several).select("_row.*")
