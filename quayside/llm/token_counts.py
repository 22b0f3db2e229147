"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A piece begins as one symbol per byte, linked in a row. The adjacent pair of the lowest rank is popped from the heap
and merged, its neighbours form new pairs, and so on until no pair can merge. The count is the symbols less the
merges. Every task reads the vocabulary from its path and works row by row; nothing is shuffled.

Results for odd input: a null or empty text has 0 bytes and 0 tokens. Repeated rows and null keys stay as they are.
A long text is worked through piece by piece; a piece of n bytes takes n log n. An empty table gives an empty one.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import byte_pairs as B
from quayside.llm.words import whole


class Merges:
    """The rank of every pair of symbol numbers that merges, and by rank the number of the new symbol."""

    def __init__(self, path: str):
        model = B.vocabulary(path)["model"]
        self.number = {symbol: k for k, symbol in enumerate(model["vocab"])}
        self.size = len(self.number)
        self.rank, self.made = {}, []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.number[left] * self.size + self.number[right]] = rank
            self.made.append(self.number[left + right])

    def count(self, piece: str) -> int:
        """Symbols left of a piece in the vocabulary's alphabet."""
        n, size, pair, made = len(piece), self.size, self.rank.get, self.made
        symbol = [self.number[c] for c in piece]
        merge = [pair(a * size + b) for a, b in zip(symbol, symbol[1:])]  # of the symbol at i with the one after it
        heap = [m * n + i for i, m in enumerate(merge) if m is not None]  # by rank, then from the left
        heapify(heap)
        merge.append(None)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            top = heappop(heap)
            m = top // n
            i = top - m * n
            if merge[i] != m:
                continue  # one of the two has merged meanwhile
            j = after[i]
            k = after[i] = after[j]
            new = symbol[i] = made[m]
            merge[j] = None
            left -= 1
            if k < n:
                before[k] = i
                m = merge[i] = pair(new * size + symbol[k])
                if m is not None:
                    heappush(heap, m * n + i)
            else:
                merge[i] = None
            h = before[i]
            if h >= 0:
                m = merge[h] = pair(symbol[h] * size + new)
                if m is not None:
                    heappush(heap, m * n + h)
        return left


class Counter:
    """Counts texts, remembering pieces and chunks met before."""

    def __init__(self, path: str):
        self.path, merges = path, Merges(path)

        class Pieces(dict):
            def __missing__(self, piece: str) -> int:
                n = merges.count(piece)
                if len(piece) <= B.LONGEST_REMEMBERED:
                    self[piece] = n
                return n

        class Chunks(dict):
            def __missing__(self, chunk: str) -> int:
                n = sum(map(by_piece.__getitem__, B.chunk_pieces(chunk, path)))
                if len(chunk) <= B.LONGEST_REMEMBERED:
                    self[chunk] = n
                return n

        by_piece = Pieces()
        self.by_piece, self.by_chunk = by_piece, Chunks()

    def plain(self, text: str) -> int:
        split = B.chunks(text)
        if split is None:
            return sum(map(self.by_piece.__getitem__, B.pieces(text, self.path)))
        first, rest = split
        return sum(map(self.by_piece.__getitem__, B.pieces(first, self.path))) + sum(map(self.by_chunk.__getitem__, rest))

    def count(self, text: str) -> int:
        n = sum(1 if isinstance(s, int) else self.plain(s) for s in B.segments(text, self.path))
        for memory in (self.by_piece, self.by_chunk):
            if len(memory) > B.REMEMBERED:
                memory.clear()
        return n


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per worker process, for all its tasks."""
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = counter(vocabulary)
        for batch in batches:
            texts = batch.column("_text")
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            n_tokens = pa.array([tally.count(x.as_py()) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), n_bytes, n_tokens], names=["key", "n_bytes", "n_tokens"])

    chosen = docs.select(F.col(key).alias("key"), whole(text).alias("_text"))
    counted = chosen.mapInArrow(run, f"key {chosen.dtypes[0][1]}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
