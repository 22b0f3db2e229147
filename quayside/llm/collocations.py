"""Phrase collocations: phrases whose words stand together far more often than the words of their parts would.

Texts have A-Z lower-cased, are split into pieces at ``. , ; : ! ?`` and line breaks, and pieces into words at blanks
and tabs. Per language, ``n`` counts all words and ``f`` every occurrence of a phrase within pieces. A phrase of 2 to
``longest`` words is a candidate from ``least`` occurrences on. Cut after its first words it scores
``1000 * f * n // (f(first part) * f(rest))``; its worst cut counts.

The method is external stream estimation. Counts of all lengths lie in one table, which is kept as two streams: in prefix
order (a phrase next to its extensions to the right) and in suffix order (next to those to the left). The counts of left
parts, right parts and extensions are met by sort-merge joins, in which Spark advances two sorted streams in lockstep; no
hash table of counts is built.

Counting reads the texts four times: for words, pairs, triples, and runs of four words up. A phrase is never more frequent
than any part of it, so a pass only emits what the one before leaves possible: pairs of frequent words, triples of frequent
pairs, runs of frequent triples.
Tasks know these from a table of bits of fixed size (16 MB) in which each frequent phrase sets two. A phrase that meets
set bits by chance is counted and then dropped by its true count, so results are exact at any size; a corpus that fills
the table only loses the saving. A run is counted once at its full length, and shorter ones are the sums over the runs
that they begin, which are neighbours in prefix order: one pass over the sorted stream gives the counts of all lengths.

Scale. Tasks merge equal phrases of about 16 MB of text before they emit, and Spark merges again before it shuffles, so a
language, word or passage with a third of all rows is split over all tasks; keys are phrases, not languages. The first
``top`` per language are taken from parts of each language first, so that the last ranking of a language has at most 64
times ``top`` rows. Only the table of bits reaches the driver.

Results for odd input: a null text is an empty one, a null language is ``und``, and repeated rows count as often as they
come. Texts without words add nothing. An empty table, or one without frequent phrases, gives no rows. Ties in score and
count go by the bytes of the phrase. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.words import whole
from quayside.session import stage

TEXT_AT_ONCE = 16 << 20
BITS = 27
PARTS = 64
INSIDE, BLANK, CUT = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = CUT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += ord("a") - ord("A")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _bytes(value: bytes) -> pa.Scalar:
    return pa.scalar(value, pa.large_binary())


class Words:
    """The words of some texts: the distinct ones, per place its word's number, and whether the next is in the same piece."""

    def __init__(self, texts: pa.Array):
        ended = pc.binary_join_element_wise(texts.cast(pa.large_binary()), _bytes(b""), _bytes(b"\n"))
        data = _LOWER[np.frombuffer(ended.buffers()[2] or b"", np.uint8)]
        kind = _KIND[data]
        inside = kind == INSIDE
        edges = np.flatnonzero(np.diff(inside, prepend=False))  # texts end with a line break, so edges come in pairs
        starts, ends = edges[::2], edges[1::2]
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        stored = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), stored).dictionary_encode()
        self.distinct = coded.dictionary
        self.places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.cumsum(kind == CUT, dtype=np.int32)
        self.joined = np.append(cuts[starts[1:]] == cuts[ends[:-1] - 1], False)[: len(starts)]

    def phrases(self, *columns: np.ndarray) -> pa.Array:
        return pc.binary_join_element_wise(*[self.distinct.take(pa.array(c)) for c in columns], _bytes(b" "))

    def hashes(self, lang: str) -> np.ndarray:
        seed = xxhash.xxh64_intdigest(lang.encode())
        return np.fromiter((xxhash.xxh64_intdigest(w.as_buffer(), seed) for w in self.distinct), np.uint64, len(self.distinct))


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs from the hashes of their words."""
    x = (left ^ (left >> np.uint64(29))) * _ODD[0] + right
    x = (x ^ (x >> np.uint64(32))) * _ODD[1]
    return x ^ (x >> np.uint64(29))


def bit_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes >> np.uint64(64 - BITS), (hashes * _ODD[2]) >> np.uint64(64 - BITS)


class Bits:
    """What may be frequent: no frequent phrase is missed, others are let through by chance."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in bit_places(hashes):
            found &= (self.blocks[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def frequent_bits(frequent: DataFrame) -> np.ndarray:
    """The bits of words, pairs or triples (``lang``, ``phrase``); what comes to the driver has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = xxhash.xxh64_intdigest(lang.encode())
                hashes.append([xxhash.xxh64_intdigest(w, seed) for w in bytes(phrase).split(b" ")])
            if not hashes:
                continue
            hashed, *more = np.array(hashes, np.uint64).T
            for other in more:
                hashed = mixed(hashed, other)
            at = np.concatenate(bit_places(hashed))
            bits = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bits)], ["block", "bits"])

    coded = frequent.select("lang", F.col("phrase").cast("binary").alias("phrase"))
    found = coded.mapInArrow(run, "block bigint, bits bigint").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    blocks = np.zeros(1 << (BITS - 6), np.uint64)
    blocks[found["block"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return blocks


def some_texts(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """The texts of a batch by language, about ``TEXT_AT_ONCE`` bytes at a time; a longer text comes alone."""
    langs = batch.column(0).dictionary_encode()
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        texts = batch.column(1).filter(pc.equal(langs.indices, k))
        upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(texts):
            before = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, before + TEXT_AT_ONCE, "right")))
            yield lang, texts.slice(first, last - first)
            first = last


def word_counts(words: Words, lang: str) -> tuple[list[pa.Array], np.ndarray]:
    return [words.distinct.cast(pa.binary())], np.bincount(words.places, minlength=len(words.distinct))


def pair_counts(words: Words, lang: str, bits: Bits) -> tuple[list[pa.Array], np.ndarray]:
    """Pairs of words that both may be frequent."""
    hot = bits.has(words.hashes(lang))[words.places]
    at = np.flatnonzero(words.joined[:-1] & hot[:-1] & hot[1:])
    size = len(words.distinct)
    pairs, counts = np.unique(words.places[at] * size + words.places[at + 1], return_counts=True)
    return [words.phrases(pairs // size, pairs % size).cast(pa.binary())], counts


def triple_counts(words: Words, lang: str, bits: Bits) -> tuple[list[pa.Array], np.ndarray]:
    """Triples of words whose pairs both may be frequent."""
    hashes = words.hashes(lang)[words.places]
    ok = words.joined[:-1] & bits.has(mixed(hashes[:-1], hashes[1:]))
    at = np.flatnonzero(ok[:-1] & ok[1:])
    size = len(words.distinct)
    pairs, pair = np.unique(words.places[at] * size + words.places[at + 1], return_inverse=True)
    triples, counts = np.unique(pair * size + words.places[at + 2], return_counts=True)
    pairs = pairs[triples // size]
    return [words.phrases(pairs // size, pairs % size, triples % size).cast(pa.binary())], counts


def run_counts(words: Words, lang: str, bits: Bits, longest: int) -> tuple[list[pa.Array], np.ndarray]:
    """From every place the longest run of four words up, of triples that all may be frequent; one column per word."""
    hashes = words.hashes(lang)[words.places]
    ok = words.joined[:-2] & words.joined[1:-1] & bits.has(mixed(mixed(hashes[:-2], hashes[1:-1]), hashes[2:]))
    n = len(words.places)
    ok = np.append(ok, np.zeros(n - len(ok) + longest, bool))
    reach, length = ok[:n].copy(), np.full(n, 2)
    for k in range(1, longest - 1):
        length += reach
        reach &= ok[k : k + n]
    columns, counts = [[] for _ in range(longest)], []
    for size in range(4, longest + 1):
        at = np.flatnonzero(length == size)
        # Numbers of runs of one word, then two, ... stay below the square of the distinct words.
        number = words.places[at]
        for k in range(1, size):
            _, number = np.unique(number * len(words.distinct) + words.places[at + k], return_inverse=True)
        _, first, count = np.unique(number, return_index=True, return_counts=True)
        for k, column in enumerate(columns):
            found = words.distinct.take(pa.array(words.places[at[first] + k])) if k < size else pa.nulls(len(first), pa.large_binary())
            column.append(found.cast(pa.binary()))
        counts.append(count)
    return [pa.concat_arrays(c) for c in columns], np.concatenate(counts)


def prefix_counts(runs: DataFrame, least: int, longest: int) -> DataFrame:
    """Counts of the phrases of four words up that begin runs, from the stream of runs in prefix order.

    There a phrase is a stretch of neighbours, so sums over stretches are all that it takes. What a batch cuts off goes on
    as a part; stretches inside it are whole, and those below ``least`` end there.
    """
    names = [f"w{k}" for k in range(1, longest + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            f = batch.column(longest + 1).to_numpy()
            starts_here = np.zeros(batch.num_rows, bool)
            starts_here[0] = True
            for k, column in enumerate(batch.columns[: longest + 1]):
                known = column.fill_null("" if k == 0 else b"")
                starts_here[1:] |= pc.not_equal(known[1:], known[:-1]).to_numpy(zero_copy_only=False)
                if k < 4:
                    continue
                starts = np.flatnonzero(starts_here)
                sums = np.add.reduceat(f, starts)
                kept = sums >= least
                kept[[0, -1]] = True
                kept &= column.is_valid().to_numpy(zero_copy_only=False)[starts]
                at = pa.array(starts[kept])
                words = [c.take(at) for c in batch.columns[1 : k + 1]]
                phrases = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), phrases, pa.array(sums[kept])], ["lang", "phrase", "f"])

    # Only where a run goes is hashed: phrases of one beginning lie in one task, in order.
    streams = runs.select("lang", *names, "f").repartition("lang", *names[:3]).sortWithinPartitions("lang", *names)
    return summed(streams.mapInArrow(run, "lang string, phrase binary, f bigint"))


def summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).withColumn("phrase", F.col("phrase").cast("string"))


def counted(docs: DataFrame, count, names: list[str], **given) -> DataFrame:
    """What ``count`` finds in portions of the texts: ``lang``, its words or phrases under ``names``, and ``f``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: Bits(v.value) if k == "bits" else v for k, v in given.items()}
        for batch in batches:
            for lang, texts in some_texts(batch):
                words = Words(texts)
                if not len(words.places):
                    continue
                columns, counts = count(words, lang, **known)
                whole_columns = [pa.repeat(lang, len(counts)), *columns, pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(whole_columns, ["lang", *names, "f"])

    return docs.mapInArrow(run, f"lang string, {', '.join(f'{c} binary' for c in names)}, f bigint")


def phrase_counts(docs: DataFrame, least: int, longest: int, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases with ``least`` occurrences, and per language the number of words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), whole(text).alias("text"))
    enough = F.col("f") >= least
    # One row per language, with no phrase, carries the number of words.
    every = summed(counted(texts, word_counts, ["phrase"]))
    sums = F.struct("lang", F.when(enough, F.col("phrase")).alias("phrase"))
    kept = every.groupBy(sums.alias("key")).agg(F.sum("f").alias("f")).select("key.lang", "key.phrase", "f")
    words = stage(kept, "collocation-words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where("phrase is not null")
    lists = [frequent]
    if longest >= 2:
        bits = spark.sparkContext.broadcast(frequent_bits(frequent))
        lists.append(stage(summed(counted(texts, pair_counts, ["phrase"], bits=bits)).where(enough), "collocation-pairs"))
    if longest >= 3:
        bits = spark.sparkContext.broadcast(frequent_bits(lists[1]))
        lists.append(stage(summed(counted(texts, triple_counts, ["phrase"], bits=bits)).where(enough), "collocation-triples"))
    if longest >= 4:
        bits = spark.sparkContext.broadcast(frequent_bits(lists[2]))
        runs = counted(texts, run_counts, [f"w{k}" for k in range(1, longest + 1)], bits=bits, longest=longest)
        lists.append(stage(prefix_counts(runs, least, longest).where(enough), "collocation-runs"))
    found = lists[0]
    for more in lists[1:]:
        found = found.unionByName(more)
    return found, sizes


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def _merged(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join of two sorted streams."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def collocations(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    share: int = 100,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """The first ``top`` phrases per language: ``lang``, ``rank``, ``phrase``, its count ``a``, the counts ``l`` and ``r``
    of the parts of its worst cut, ``n`` and ``score``.

    A candidate goes if a longer one that holds its words has at least ``share`` percent of its count. The most frequent
    longer one always is longer by one word, so its extensions decide.
    """
    counts, sizes = phrase_counts(docs, least, longest, lang, text)
    parts = counts.select("lang", "phrase", "f", F.split("phrase", " ").alias("words"))
    size = F.size("words")
    several = parts.where(size >= 2)
    # In prefix order a phrase stands before its extensions to the right, in suffix order before those to the left.
    streams = {"right": F.slice("words", 1, size - 1), "left": F.slice("words", 2, size - 1)}
    candidates = several
    for side, shorter in streams.items():
        widest = several.where(size >= 3).groupBy("lang", _joined(shorter).alias("phrase")).agg(F.max("f").alias(side))
        candidates = _merged(candidates, widest, ["lang", "phrase"], "left")
    widest = F.greatest(*[F.coalesce(F.col(side), F.lit(0)) for side in streams])
    held = (widest > 0) & (_exact(widest) * 100 >= _exact(F.col("f")) * share)
    candidates = candidates.where(~held).select("lang", "phrase", F.col("f").alias("a"), "words")

    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        _joined(F.slice("words", F.lit(1), F.col("cut"))).alias("first"),
        _joined(F.slice("words", F.col("cut") + 1, size - F.col("cut"))).alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = _merged(cuts, counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    cuts = cuts.join(sizes, "lang")
    cuts = cuts.withColumns({"over": _exact(F.col("a")) * 1000 * _exact(F.col("n")), "under": _exact(F.col("l")) * _exact(F.col("r"))})
    worst = cuts.withColumn("score", F.expr("over div under"))
    worst = worst.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    worst = worst.select("lang", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = (F.xxhash64("phrase") % PARTS).alias("part")
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    worst = worst.select("*", part).withColumn("rank", first).where(F.col("rank") <= top)
    worst = worst.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return worst.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _exact(number: Column) -> Column:
    return number.cast("decimal(19,0)")
