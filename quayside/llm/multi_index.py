"""Approximate nearest neighbours by an inverted multi-index.

A vector's two halves are quantised separately, each with its own centroids; the pair of centroids is its cell. A query
sorts the centroids of either half by inner product and walks the pairs from the largest sum downwards with a heap.
It stops when the cells it has met are expected to hold ``EXPECTED`` of its neighbours: an entry's score is its cell's
sum plus a residue whose spread the sample shows, so every cell's share of entries above the score that the last
neighbour should have is known. Entries of these cells are ranked by the exact inner product.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors); every vector is indexed. Centroids per half follow the
number of vectors. The sample's vectors are entries themselves, so the best scores of those that a query visits are a
floor under what it finds, and a unit need not report entries below it.

Scale. Cells of one first centroid form pages of about ``UNIT`` entries. Pages meet their queries in units: a page that
a few vectors overfill is cut into chunks, one that many queries ask for into blocks of queries, and each chunk meets
each block once. So a vector that fills a third of the table, or a page that every query visits, is many small units.
Counts per cell go to the tasks; there are at most ``MOST_CENTROIDS`` squared.

Results for odd input: vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do
rows without an id. Rows of one id are one entry and one query, with the smallest of their vectors, so that no id is found
twice; it asks if any of them does. Equal vectors tie and go by id. With fewer entries
than asked for all are returned; an empty table gives an empty result. Vectors of different lengths are refused with
an error. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import erfc
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.joins import broadcast_if_small
from quayside.session import stage

SAMPLE = 16_384
MOST_CENTROIDS = 1024
CELL_ENTRIES = 5  # mean entries of a cell
EXPECTED = 0.97  # of the neighbours, to be in the cells that a query visits
UNIT = 512  # entries, and queries, of a unit
TAIL = np.array([0.5 * erfc(x / 2**0.5) for x in np.linspace(-8, 8, 1601)])  # of a normal distribution


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.coalesce(F.isnan(x), F.lit(True)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, size)


def fit_centroids(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm; a centroid that loses all its points moves to the point farthest from its own."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        distance = (centres**2).sum(1) - 2 * points @ centres.T
        nearest = distance.argmin(1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        far = np.argsort(-(distance[np.arange(len(points)), nearest] + (points**2).sum(1)))
        empty = np.flatnonzero(counts == 0)
        centres[empty] = points[far[: len(empty)]]
    return centres


def tail(x: np.ndarray) -> np.ndarray:
    """The share of a normal distribution above ``x``."""
    return np.interp(x, np.linspace(-8, 8, len(TAIL)), TAIL)


class Codebook:
    """The centroids of both halves, and the sample they come from."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, k: int):
        self.ids, self.sample, self.half = ids, sample, sample.shape[1] // 2
        self.first, self.second = fit_centroids(sample[:, : self.half], k), fit_centroids(sample[:, self.half :], k)
        self.a, self.b = self.cells(sample)
        residue = sample - np.hstack([self.first[self.a], self.second[self.b]])
        self.spread = residue.T @ residue / len(sample)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def nearest(part: np.ndarray, centres: np.ndarray) -> np.ndarray:
            return ((centres**2).sum(1) - 2 * part @ centres.T).argmin(1)

        return nearest(vectors[:, : self.half], self.first), nearest(vectors[:, self.half :], self.second)

    def goal(self, scores: np.ndarray, n: int, top: int) -> float:
        """The score that the ``top``-th of ``n`` entries should have, given the sample's."""
        if not len(scores):
            return -np.inf
        scores = np.sort(scores)[::-1]
        rank = top * len(scores) / n
        if rank >= 3 or len(scores) >= n - 1:
            return scores[min(int(rank), len(scores) - 1)]
        far = NormalDist().inv_cdf(max(1 - top / n, 0.5))
        return max(scores[min(2, len(scores) - 1)], scores.mean() + far * scores.std())

    def visit(self, key: int, query: np.ndarray, entries: np.ndarray, top: int) -> tuple[dict[int, int], np.ndarray, float]:
        """What ``walk`` gives, the second centroids in the query's order, and the floor under what the query finds."""
        scores = np.einsum("nd,d->n", self.sample, query, optimize=False)
        other = self.ids != key
        depth = self.walk(query, entries, self.goal(scores[other], int(entries.sum()), top), top)
        order = self.order(query[None])[0]
        seen = np.zeros(len(self.first), np.int64)
        seen[list(depth)] = list(depth.values())
        met = np.sort(scores[other & (np.argsort(order)[self.b] < seen[self.a])])
        return depth, order, met[-top] if len(met) >= top else -np.inf

    def walk(self, query: np.ndarray, entries: np.ndarray, goal: float, top: int) -> dict[int, int]:
        """Per first centroid how many second ones the query visits, best first.

        ``entries`` is the number of entries by first and second centroid.
        """
        left, right = self.first @ query[: self.half], self.second @ query[self.half :]
        by_left, by_right = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
        left, right = left[by_left], right[by_right]
        noise = max(float(query @ self.spread @ query), 1e-300) ** 0.5
        held = entries[np.ix_(by_left, by_right)]
        hits = held * tail((goal - left[:, None] - right[None, :]) / noise)
        enough = EXPECTED * hits.sum()
        left, right, hits, held, n = left.tolist(), right.tolist(), hits.tolist(), held.tolist(), len(right)
        queue, expected, met, depth = [(-left[0] - right[0], 0, 0)], 0.0, 0, [0] * len(left)
        while queue and (expected < enough or met <= top):
            _, i, j = queue[0]
            depth[i] = j + 1
            expected += hits[i][j]
            met += held[i][j]
            if j + 1 < n:
                heapq.heapreplace(queue, (-left[i] - right[j + 1], i, j + 1))
            else:
                heapq.heappop(queue)
            if j == 0 and i + 1 < len(left):  # each pair is reached from one other only
                heapq.heappush(queue, (-left[i + 1] - right[0], i + 1, 0))
        return {int(by_left[i]): j for i, j in enumerate(depth) if j}

    def order(self, queries: np.ndarray) -> np.ndarray:
        """Per query the second centroids, best first."""
        return np.stack([np.argsort(-(self.second @ q[self.half :]), kind="stable") for q in queries])


def fit(vectors: DataFrame, n: int) -> Codebook:
    """Centroids from a sample drawn by the hash of the id."""
    draw = F.xxhash64("id", F.lit(11))
    share = int(min(1.0, 1.2 * SAMPLE / n) * (1 << 30))  # a little more than needed, then the first of those
    rows = vectors.where(F.pmod(draw, F.lit(1 << 30)) < share).orderBy(draw, "id").limit(SAMPLE).collect()
    rows = rows or vectors.limit(SAMPLE).collect()
    k = int(np.clip(round((n / CELL_ENTRIES) ** 0.5), 1, MOST_CENTROIDS))
    return Codebook(np.array([r.id for r in rows]), np.array([r.vector for r in rows], np.float64), k)


class Unit:
    """Entries of a page and the queries that visit it."""

    COLUMNS = ("id", "vector", "second", "depth", "floor")

    def __init__(self) -> None:
        self.entries: list[dict[str, np.ndarray]] = []
        self.queries: list[dict[str, np.ndarray]] = []

    def best(self, book: Codebook, top: int) -> Iterator[pa.RecordBatch]:
        """The ``top`` visited entries per query that reach its floor, ties to the smaller id."""
        if not self.entries or not self.queries:
            return
        entry, query = ({c: np.concatenate([x[c] for x in kept]) for c in self.COLUMNS} for kept in (self.entries, self.queries))
        for start in range(0, len(query["id"]), 64):
            some = {c: x[start : start + 64] for c, x in query.items()}
            place = np.argsort(book.order(some["vector"]), axis=1)  # of every second centroid in the query's order
            seen = (place[:, entry["second"]] < some["depth"][:, None]) & (entry["id"][None, :] != some["id"][:, None])
            q, e = np.nonzero(seen)
            # Every product is added in the same order, so equal vectors get equal scores wherever they stand.
            scores = np.einsum("pd,pd->p", some["vector"][q], entry["vector"][e], optimize=False)
            reach = scores >= some["floor"][q]
            q, e, scores = q[reach], e[reach], scores[reach]
            order = np.lexsort((entry["id"][e], -scores, q))
            q, e, scores = q[order], e[order], scores[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            q, e, scores = q[rank < top], e[rank < top], scores[rank < top]
            columns = [some["id"][q], entry["id"][e], scores]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


def _rank_units(batches: Iterator[pa.RecordBatch], book: Codebook, top: int) -> Iterator[pa.RecordBatch]:
    """Works through a partition sorted by unit; holds one unit at a time."""
    at, unit = None, Unit()
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in ("page", "chunk", "block")])
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        rows = {c: batch.column(c).to_numpy() for c in Unit.COLUMNS if c != "vector"}
        rows["vector"] = matrix(batch.column("vector"), book.sample.shape[1])
        cuts = np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            if at != (now := tuple(key[:, low])):
                yield from unit.best(book, top)
                at, unit = now, Unit()
            here = asks[low:high]
            for kept, own in ((unit.entries, ~here), (unit.queries, here)):
                if own.any():
                    kept.append({c: x[low:high][own] for c, x in rows.items()})
    yield from unit.best(book, top)


def one_per_id(rows: DataFrame) -> DataFrame:
    """``id, vector, asks`` with one row per id. Only vectors whose id is repeated are shuffled."""
    counts = rows.groupBy("id").agg(F.count("*").alias("n"))
    repeated = stage(counts.where("n > 1").select("id"), "repeated-ids")
    if repeated.isEmpty():
        return rows
    repeated = broadcast_if_small(repeated)
    merged = rows.join(repeated, "id", "left_semi").groupBy("id")
    merged = merged.agg(F.min("vector").alias("vector"), F.bool_or("asks").alias("asks"))
    return rows.join(repeated, "id", "left_anti").unionByName(merged)


def search(
    embeddings: DataFrame, is_query: Column, top: int = 20, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``top`` entries of largest inner product per query: ``query_id, rank, vec_id, score``."""
    spark = embeddings.sparkSession
    chosen = embeddings.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    chosen = chosen.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("asks", F.coalesce("asks", F.lit(False)))
    lengths = chosen.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).limit(10).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(row['size'] for row in lengths)}")
    size, n = lengths[0]
    chosen = one_per_id(chosen)
    shared = spark.sparkContext.broadcast(fit(chosen, n))
    book = shared.value
    firsts, seconds = len(book.first), len(book.second)
    pages = max(1, -(-n // (firsts * UNIT)))  # per first centroid
    width = -(-seconds // pages)  # second centroids of a page

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = shared.value.cells(matrix(batch.column("vector"), size))
            yield batch.append_column("page", pa.array((a * pages + b // width).astype(np.int32))).append_column(
                "second", pa.array(b.astype(np.int32))
            )

    kind = dict(chosen.dtypes)["vector"]
    entries = stage(chosen.mapInArrow(index, f"id bigint, vector {kind}, asks boolean, page int, second int"), "index")
    counts = np.zeros((firsts, seconds), np.int64)
    for row in entries.groupBy("page", "second").agg(F.count("*").alias("n")).collect():  # a row per cell
        counts[row.page // pages, row.second] = row.n
    shared_counts = spark.sparkContext.broadcast(counts)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, counts = shared.value, shared_counts.value
        for batch in batches:
            of, page, depth, floor = [], [], [], []
            ids, rows = batch.column("id").to_pylist(), matrix(batch.column("vector"), size)
            for k, (number, query) in enumerate(zip(ids, rows)):
                visited, order, low = book.visit(number, query, counts, top)
                for first, seen in visited.items():
                    own = np.unique(order[:seen][counts[first, order[:seen]] > 0] // width)
                    of += [k] * len(own)
                    page += (first * pages + own).tolist()
                    depth += [seen] * len(own)
                    floor += [low] * len(own)
            take = pa.array(of, pa.int64())
            columns = [batch.column("id").take(take), batch.column("vector").take(take)]
            columns += [pa.array(page, pa.int32()), pa.array(depth, pa.int32()), pa.array(floor, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "vector", "page", "depth", "floor"])

    asking = entries.where("asks").select("id", "vector")
    probes = stage(asking.mapInArrow(probe, f"id bigint, vector {kind}, page int, depth int, floor double"), "probes")
    per_page = entries.groupBy("page").agg(F.count("*").alias("n_entries"))
    asked = probes.groupBy("page").agg(F.count("*").alias("n_probes")).join(per_page, "page")
    chunks, blocks = (F.ceil(F.col(c) / UNIT).cast("int") for c in ("n_entries", "n_probes"))
    cut = F.broadcast(stage(asked.select("page", chunks.alias("chunks"), blocks.alias("blocks")), "pages"))  # a row per page

    def dealt(rows: DataFrame, own: str, others: str, asks: bool) -> DataFrame:
        """A row's own piece, once for every piece of the other kind."""
        every = F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(others.removesuffix("s"))
        mine = F.pmod(F.xxhash64("id", F.lit(3)), F.col(own)).cast("int").alias(own.removesuffix("s"))
        return rows.join(cut, "page").select("page", mine, every, F.lit(asks).alias("asks"), *Unit.COLUMNS)

    both = dealt(entries.withColumns({"depth": F.lit(0), "floor": F.lit(0.0)}), "chunks", "blocks", False).unionByName(
        dealt(probes.withColumn("second", F.lit(0)), "blocks", "chunks", True)
    )
    unit = ["page", "chunk", "block"]
    ranked = both.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(
        lambda batches: _rank_units(batches, shared.value, top), "query_id bigint, vec_id bigint, score double"
    )
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        ranked.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
