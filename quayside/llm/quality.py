"""Quality scores: kernel ridge regression on document statistics by random Fourier features, then calibrated.

A text is described by statistics of its bytes, words and lines. Random Fourier features turn the Gaussian kernel over
them into a plain dot product, so ridge regression needs only the sums Z'Z and Z'y, which every task adds up for its
own rows. Isotonic regression on rows that the ridge has not seen turns its output into the chance of label 1.

Scale. Texts are read once, for their statistics; training and scoring read those. Labelled keys for training are
bounded (``MOST_LABELLED``, drawn by the hash of the key) and broadcast, so the statistics of all documents are not
shuffled to meet them. Sums have a fixed size, and ``TASKS`` of them reach the driver. A text has as many statistics
however long it is; a very long one is held whole by its task.

Results for odd input: a null or empty text has statistics of zeros and a score like any other. Rows with a null key
are scored and held out as their (empty) text key says, and never train. A key trains once: repeated among the labels
with the label that most of its rows give (1 on a tie), repeated among the documents with its smallest statistics. Without any usable label every score is 0.5. An empty table gives an empty one. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.joins import broadcast_if_small
from quayside.llm.words import labelled, whole
from quayside.session import stage

MOST_LABELLED = 100_000
TASKS = 16
FEATURES = 384
RIDGE = 1e-2
SEED = 17

UPPER, LOWER, DIGIT = (np.array(list(x), np.intp) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"))
MARKS, SYMBOLS = np.array(list(b".,;:!?"), np.intp), np.array(list(b"#*$%&|<>=+~^@_{}[]\\"), np.intp)
SINGLE = np.array(list(b".,!?|#*$%&\n\"'()-/"), np.intp)


def statistics(data: bytes) -> list[float]:
    """Shares and logarithms, none of them depending on the unit of length."""
    octets = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, np.int64)
    size, words, lines = max(len(data), 1), data.split(), data.split(b"\n")
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    different, full = set(words), [x for x in lines if x]
    last = np.bincount(np.frombuffer(bytes([w[-1] for w in words]), np.uint8), minlength=256)
    per_line = np.fromiter(map(len, full), np.float64, len(full)) if full else np.zeros(1)
    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        len(different) / n,
        len(set(full)) / max(len(full), 1),
        np.log1p(per_line.mean()),
        np.log1p(per_line.std()),
        octets[UPPER].sum() / max(octets[UPPER].sum() + octets[LOWER].sum(), 1),
        octets[LOWER].sum() / size,
        octets[DIGIT].sum() / size,
        octets[MARKS].sum() / n,
        octets[SYMBOLS].sum() / n,
        octets[128:].sum() / size,
        last[MARKS].sum() / n,
        last[SYMBOLS].sum() / n,
        (last[UPPER].sum() + last[LOWER].sum()) / n,
        *(octets[SINGLE] / n),
    ]


WIDTH = len(statistics(b""))


def described(docs: DataFrame, key: str, text: str) -> DataFrame:
    chosen = docs.select(F.col(f"`{key}`").alias("key"), whole(text).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(x.as_buffer().to_pybytes()) for x in batch.column("_text")], np.float32).reshape(-1, WIDTH)
            values = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), WIDTH).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), values], names=["key", "x"])

    return chosen.mapInArrow(run, f"key {chosen.dtypes[0][1]}, x array<float>")


def rows_of(column: pa.Array, width: int = WIDTH) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, width)


class Fourier:
    """Random features whose dot products approach a Gaussian kernel over scaled statistics."""

    def __init__(self, sample: np.ndarray, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.middle, self.scale = sample.mean(0), sample.std(0) + 1e-6
        scaled = self.scaled(sample)
        pairs = scaled[rng.permutation(len(scaled))] - scaled
        width = np.sqrt(np.median((pairs**2).sum(1))) or 1.0  # as wide as rows are usually apart
        self.weights = rng.normal(size=(sample.shape[1], features)) / width
        self.shift = rng.uniform(0, 2 * np.pi, features)

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.middle) / self.scale, -8, 8)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        waves = np.cos(self.scaled(rows) @ self.weights + self.shift) * np.sqrt(2 / len(self.shift))
        return np.hstack([waves, np.ones((len(rows), 1))])


def ridge(examples: DataFrame, fourier: Fourier, weights: tuple[float, float]) -> np.ndarray:
    """Coefficients from sums that the tasks make; ``weights`` are those of labels 0 and 1."""
    size = len(fourier.shift) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, product = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z, y = fourier(rows_of(batch.column("x"))), batch.column("y").to_numpy().astype(np.float64)
            w = np.where(y > 0, weights[1], weights[0])
            square += (z * w[:, None]).T @ z
            product += z.T @ (w * y)
        body = [square.tobytes()], [product.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.binary()) for b in body], names=["square", "product"])

    parts = examples.select("x", "y").coalesce(TASKS).mapInArrow(sums, "square binary, product binary").collect()
    square = sum(np.frombuffer(p.square).reshape(size, size) for p in parts)
    product = sum(np.frombuffer(p.product) for p in parts)
    return np.linalg.solve(square + RIDGE * np.trace(square) / size * np.eye(size), product)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the centres of the pools and their means, both rising."""
    pools: list[list[float]] = []  # sum of x, sum of y, count
    order = np.argsort(x, kind="stable")
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        pools.append([a, b, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


class Scorer:
    def __init__(self, fourier: Fourier, beta: np.ndarray):
        self.fourier, self.beta = fourier, beta
        self.x, self.y = np.zeros(1), np.zeros(1)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.fourier(rows) @ self.beta

    def calibrate(self, rows: np.ndarray, y: np.ndarray) -> None:
        """Isotonic pools, with a small slope beyond and between them so that better raw scores stay better."""
        raw = self.raw(rows)
        self.x, self.y = isotonic(raw, y)
        self.low, self.high = float(raw.min()), float(raw.max())

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        raw = self.raw(rows)
        level = np.interp(raw, self.x, self.y)
        place = 1 / (1 + np.exp(-4 * (2 * raw - self.low - self.high) / max(self.high - self.low, 1e-9)))
        return np.clip(0.998 * level + 0.002 * place, 0, 1)


def train(examples: DataFrame) -> Scorer | None:
    """``examples`` has ``key``, ``x``, ``y`` (0 or 1) and ``calibrates``."""
    counts = {r.y: r.n for r in examples.where("not calibrates").groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    sample = examples.where("not calibrates").orderBy(F.xxhash64("key"), "key").limit(5000).collect()  # for scale and width
    fourier = Fourier(np.array([r.x for r in sample]))
    total = sum(counts.values())
    weights = tuple(total / (2 * max(counts.get(y, 0), 1)) for y in (0, 1))
    scorer = Scorer(fourier, ridge(examples.where("not calibrates"), fourier, weights))
    held = examples.where("calibrates").select("x", "y").collect()  # a fifth of the bounded sample
    held = held or examples.select("x", "y").collect()
    scorer.calibrate(np.array([r.x for r in held], np.float64), np.array([r.y for r in held], np.float64))
    return scorer


def bounded(labels: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` of the labelled keys, drawn by their hash."""
    share = min(1.0, most / max(labels.count(), 1))
    return labels.where(F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30)))


def score(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: key, ``held_out``, ``score`` and ``predicted``.

    ``held_out`` is a condition on the key column; labels of those rows are not used at all.
    """
    stats = stage(described(docs, key, text), "statistics")
    drawn = stage(bounded(stage(labelled(labels, key, label, held_out), "labels"), MOST_LABELLED), "drawn-labels")
    met = stats.join(broadcast_if_small(drawn), "key").groupBy("key").agg(F.min(F.struct("x", "y")).alias("least"))
    calibrates = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(5)) == 0
    examples = met.select("key", "least.x", "least.y", calibrates.alias("calibrates"))
    scorer = train(stage(examples, "examples"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = rows_of(batch.column("x"))
            found = np.full(len(rows), 0.5) if scorer is None else scorer(rows)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found)], names=["key", "score"])

    scored = stats.mapInArrow(run, f"key {stats.dtypes[0][1]}, score double").withColumnRenamed("key", key)
    return scored.select(
        key, F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
