"""Best-fit packing of token sequences after a reduction by dominance.

Documents become lists of token ids, longer ones are cut, and every piece has a length from 1 to the capacity. Only
the number of pieces of each length decides how they pack, so the plan is made from that histogram, whose size does
not depend on the number of documents. Martello and Toth's reduction goes over the lengths from the longest: where a
set of at most three pieces provably dominates whatever else could share a sequence with this length, it is fixed and
its pieces leave the instance. What remains is placed best-fit, longest first; sequences with the same content are
kept as one class with a count, so a step places many pieces at once.

Scale. Texts are read once. A task numbers its pieces within their length as it writes them, so the number of a piece
among all of its length follows from the counts of the tasks before: no length is sorted in one task, however many
pieces have it. The plan is a list of slots per length, sent to the tasks; it has as many rows as there are classes.

Results for odd input: a null or empty text is the end token alone. Repeated rows and null keys are packed each for
itself. A very long text is cut and never drops a token. An empty table gives an empty one. Other columns are
ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import byte_pairs as B
from quayside.llm.words import whole
from quayside.session import stage

CAPACITY = 2048
END = 0
AT_ONCE = 500  # new chunks given to the library
ENDS = ".,;:!?"  # marks after a word, each a piece of its own
PORTION = 8_000_000  # bytes of texts worked on together; a longer text comes alone


# Token ids ------------------------------------------------------------------------------------------------


class Encoder:
    """Ids of texts as little-endian 32-bit numbers by the tokenizers library, remembering chunks met before."""

    def __init__(self, path: str):
        # Tasks already share the cores; threads of the library's own would each keep memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path, self.known, self.library = path, {}, B.library(path)
        words = self.library.get_vocab()
        self.opens = {mark: np.zeros(max(words.values()) + 1, bool) for mark in "ĠĊ"}  # tokens that begin with a blank
        for word, number in words.items():
            if word[0] in self.opens:
                self.opens[word[0]][number] = True
        word, *ended = self.ids([" a", *[f" a{mark}" for mark in ENDS]])
        self.ends = {mark: ids[len(word) :].tobytes() for mark, ids in zip(ENDS, ended)}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, "<u4") for c in coded]

    def learn(self, chunks: list[str], glue: str, mark: str) -> Iterator[tuple[str, bytes]]:
        """Chunks that each begin with a blank, joined to one text: their ids begin at the ids that do."""
        ids = self.ids([glue + glue.join(chunks)])[0]
        starts = np.flatnonzero(self.opens[mark][ids]) * 4
        coded = ids.tobytes()
        ends = [*starts[1:].tolist(), len(coded)]
        return zip(chunks, [coded[a:b] for a, b in zip(starts.tolist(), ends)], strict=True)

    def learnt(self, new: list[str]) -> dict[str, bytes]:
        """Ids of chunks that are not known: of a word and the mark after it, or by the library."""
        found: dict[str, bytes] = {}
        ended = [c for c in new if c[-1] in self.ends and c.isascii() and c[:-1].isalpha()]
        rest = set(new).difference(ended).union([c[:-1] for c in ended if c[:-1] not in self.known])
        # Shortest first, so that no more than two line breaks meet.
        lines = sorted((c for c in rest if c[0] == "\n"), key=len)
        words = list(rest.difference(lines))
        for own, glue, mark in ((words, " ", "Ġ"), (lines, "", "Ċ")):
            for start in range(0, len(own), AT_ONCE):
                found.update(self.learn(own[start : start + AT_ONCE], glue, mark))
        for c in ended:
            word = c[:-1]
            found[c] = (found.get(word) or self.known[word]) + self.ends[c[-1]]
        return found

    def look_up(self, chunks: list[str], times: np.ndarray) -> list[bytes]:
        """Ids of different chunks, met so many times. Few that were met once are remembered: most of them never return."""
        if len(self.known) > B.REMEMBERED:
            self.known.clear()
        coded = list(map(self.known.get, chunks))
        found = self.learnt([c for c, ids in zip(chunks, coded) if ids is None])
        for k, (chunk, ids) in enumerate(zip(chunks, coded)):
            if ids is None:
                coded[k] = found[chunk]
        often, once = np.flatnonzero(times > 1), np.flatnonzero(times == 1)
        room = max(B.REMEMBERED // 10 - len(self.known) - len(often), 0)
        kept = [*often.tolist(), *once[:room].tolist()]
        self.known.update((chunks[k], coded[k]) for k in kept if len(chunks[k]) <= B.LONGEST_REMEMBERED)
        return coded

    def encode(self, texts: list[str]) -> list[bytes]:
        """Several texts at a time: a chunk is looked up once for all of them, and new ones go to the library together."""
        even = [not B.has_special(text, self.path) and B.even(text) for text in texts]
        spaced = pc.replace_substring(pa.array([t for t, e in zip(texts, even) if e], pa.string()), "\n", " \n")
        parts = pc.split_pattern(spaced, " ")
        begin, values = parts.offsets.to_numpy(), parts.values
        later = np.ones(len(values), bool)
        later[begin[:-1]] = False
        first = iter(values.take(pa.array(begin[:-1])).to_pylist())
        heads = self.ids([next(first) if e else text for text, e in zip(texts, even)])

        rest = values.filter(pa.array(later)).dictionary_encode()
        chunks = rest.dictionary.to_numpy(zero_copy_only=False).tolist()
        times = np.bincount(rest.indices.to_numpy(), minlength=len(chunks))
        ids = pa.array(self.look_up(chunks, times), pa.large_binary()).take(rest.indices)
        data = memoryview(ids.buffers()[2] or b"")
        ends = np.concatenate([[0], pc.binary_length(ids).to_numpy().cumsum()])[begin - np.arange(len(begin))].tolist()
        bodies = (data[a:b] for a, b in zip(ends, ends[1:]))
        return [b"".join([head.tobytes(), next(bodies) if e else b""]) for head, e in zip(heads, even)]


def portions(lengths: Iterable[int], size: int = PORTION) -> Iterator[tuple[int, int]]:
    """Runs of texts of these lengths, of about so much together."""
    start = total = end = 0
    for end, length in enumerate(lengths, 1):
        total += length
        if total >= size:
            yield start, end
            start, total = end, 0
    if end > start:
        yield start, end


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, for all its tasks."""
    return Encoder(path)


PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens; only the first may be short."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def pieces(docs: DataFrame, vocabulary: str, capacity: int, key: str, text: str) -> DataFrame:
    """One row per piece, with the task that made it and its place among that task's pieces of the same length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, task = encoder(vocabulary), TaskContext.get().partitionId()
        end = np.array([END], "<u4").tobytes()
        made = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = batch.column("_text")
            for low, high in portions(pc.binary_length(texts).to_pylist()):
                rows, of = [], []
                for k, ids in enumerate(code.encode(texts.slice(low, high - low).to_pylist()), low):
                    ids += end
                    for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((number, start, length, crc, task, made[length]))
                        of.append(k)
                        made[length] += 1
                names = ["piece", "start", "length", "ids_crc32", "task", "place"]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(of)), *columns], names=["key", *names])

    chosen = docs.select(F.col(key).alias("key"), whole(text).alias("_text"))
    return chosen.mapInArrow(run, f"key {chosen.dtypes[0][1]}, {PIECES}")


# The plan -------------------------------------------------------------------------------------------------


class Slots:
    """Where the pieces of each length go, in the order of their numbers.

    A row stands for ``n`` pieces of one length: the first ``each`` of them go to sequence ``base``, the next to
    ``base + 1`` and so on, side by side from ``offset``.
    """

    def __init__(self) -> None:
        self.length, self.n, self.base, self.each, self.offset = [], [], [], [], []

    def add(self, length: int, n: int, base: int, each: int, offset: int) -> None:
        for column, value in zip((self.length, self.n, self.base, self.each, self.offset), (length, n, base, each, offset)):
            column.append(value)


def largest_fitting(counts: np.ndarray, room: int) -> int:
    """The largest length at hand up to ``room``, or 0."""
    present = np.flatnonzero(counts[: room + 1])
    return int(present[-1]) if len(present) and room > 0 else 0


def dominating_set(counts: np.ndarray, length: int) -> list[int] | None:
    """What shares a sequence with a piece of ``length`` without loss, or None if that can't be proven.

    ``counts`` are the pieces at hand beside this one. A set dominates if every set that could take its place
    splits into parts that each fit under one of its pieces.
    """
    room = len(counts) - 1 - length
    best = largest_fitting(counts, room)
    if best == 0:
        return []
    if best == room:
        return [best]
    smallest = [int(x) for x in np.flatnonzero(counts)[:3] for _ in range(min(3, int(counts[x])))][:3]
    if len(smallest) < 2 or sum(smallest[:2]) > room:
        return [best]  # one more piece at most
    if len(smallest) == 3 and sum(smallest) <= room:
        return None  # three more may fit
    # Two more at most: pairs c >= d with c + d <= room.
    present = np.flatnonzero(counts[: room + 1])
    sums = []
    for d in present[2 * present <= room]:
        rest = counts.copy()
        rest[d] -= 1
        if c := largest_fitting(rest, room - int(d)):
            sums.append((c + int(d), int(d)))
    if best >= max(s for s, _ in sums):
        return [best]
    rest = counts.copy()
    rest[best] -= 1
    second = largest_fitting(rest, room - best)
    return [best, second] if second and second >= max(d for _, d in sums) else None


def reduce_instance(counts: np.ndarray, slots: Slots, sequence: int) -> int:
    """Fixes dominating sets, longest pieces first, and takes their pieces out of ``counts``."""
    for length in np.flatnonzero(counts)[::-1].tolist():
        while counts[length]:
            rest = counts.copy()
            rest[length] -= 1
            found = dominating_set(rest, length)
            if found is None:
                break
            members = [length, *found]
            needed = np.bincount(members, minlength=len(counts))
            # The same set dominates as long as its pieces are there: taking other pieces away adds no rivals.
            times = int((counts // np.maximum(needed, 1))[needed > 0].min())
            offset = 0
            for member in members:
                slots.add(member, times, sequence, 1, offset)
                offset += member
            counts -= needed * times
            sequence += times
    return sequence


def best_fit(counts: np.ndarray, slots: Slots, sequence: int) -> int:
    """Places the rest, longest first, each piece where the least room is left that still holds it."""
    capacity = len(counts) - 1
    open_classes: dict[int, list[tuple[int, int]]] = {}  # room left: first sequence and how many follow each other
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        rooms = iter(sorted(r for r in open_classes if r >= length))
        while left:
            room = next(rooms, None)
            if room is None:
                each = capacity // length
                room, fresh = capacity, -(-left // each)
                classes = [(sequence, fresh)]
                sequence += fresh
            else:
                classes = open_classes.pop(room)
                each = room // length
            unused = []
            for base, n in classes:
                full = min(n, left // each)
                if full:
                    slots.add(length, full * each, base, each, capacity - room)
                    open_classes.setdefault(room - each * length, []).append((base, full))
                    left -= full * each
                base, n = base + full, n - full
                if n and left:  # fewer than a sequence would take
                    slots.add(length, left, base, each, capacity - room)
                    open_classes.setdefault(room - left * length, []).append((base, 1))
                    left, base, n = 0, base + 1, n - 1
                if n:
                    unused.append((base, n))
            if unused:
                open_classes.setdefault(room, []).extend(unused)
        counts[length] = 0
    return sequence


def plan(histogram: np.ndarray) -> Slots:
    """Slots for every piece; ``histogram[n]`` is the number of pieces of length n, its last index the capacity."""
    counts, slots = histogram.copy(), Slots()
    best_fit(counts, slots, reduce_instance(counts, slots, 0))
    return slots


class Placer:
    """Looks pieces up in a plan."""

    def __init__(self, slots: Slots, capacity: int):
        order = np.argsort(np.array(slots.length, np.int64), kind="stable")
        self.length, self.n, self.base, self.each, self.offset = (
            np.array(c, np.int64)[order] for c in (slots.length, slots.n, slots.base, slots.each, slots.offset)
        )
        ends = np.cumsum(self.n)
        first = np.searchsorted(self.length, np.arange(capacity + 2))
        # Numbers of pieces run on over the lengths: those of a length begin where all shorter ones end.
        self.begin = np.concatenate([[0], ends])[first]
        self.start = ends - self.n

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.begin[length] + number
        row = np.searchsorted(self.start, at, "right") - 1
        within = at - self.start[row]
        each = self.each[row]
        return self.base[row] + within // each, self.offset[row] + within % each * length


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``."""
    cut_up = stage(pieces(docs, vocabulary, capacity, key, text), "pieces")
    counts = stage(cut_up.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))

    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        histogram[row.length] = row.n
    slots = plan(histogram)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placer = Placer(slots, capacity)
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = placer(length, number)
            columns = [batch.column(c) for c in ("key", "piece", "start", "length", "ids_crc32")]
            names = ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=names)

    numbered = cut_up.join(begins, ["length", "task"]).select(
        "key", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("begin")).alias("number")
    )
    kind = numbered.dtypes[0][1]
    placed = numbered.mapInArrow(
        place,
        f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
    return placed.withColumnRenamed("key", key)
