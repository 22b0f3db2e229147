"""Toxicity scores by a small convolutional network over hashed word embeddings, trained in numpy.

A word, lower-cased and without marks around it, is the sum of rows of one embedding table, picked by the hashes of the
word and of its beginnings, so that words of one family share what is learnt of them, and two words are mixed up only
if all their hashes collide. Rows that fewer than ``LEAST_TEXTS`` training texts touch stay zero, so words that training
hardly met are silent. Filters of several widths run over the words. Their largest outputs are taken per segment
of a text; the text is the largest and the mean of its segments, which tells a word that fell by chance from a tone.
Weights of these are never negative: a text is toxic for what it holds, and clean words around it don't excuse it. Texts
that training has not seen give each language its own threshold, which becomes the score 0.5; the language is told by
the function words of the whole text, never by a column.

Scale. Every labelled text trains, whole and where it lies. About ``MOST_LABELLED`` of them (long ones by seeded runs of
words) give the network its start. Then come ``ROUNDS`` rounds, which share out all texts: in a round each task goes on
from the same network with its own texts, and the networks are averaged, every row of the table by the texts that touch
it. Averages are of whole numbers, so their order doesn't matter. Thresholds come from all texts that did not train, by
counts of their outputs in steps of 1 / ``FINE``. What reaches the driver has a fixed size, as the network has. Training
and scoring take whole texts in runs of words of which only maxima and sums are kept, so a very long text needs no more
memory than a run beside its own words.

Results for odd input: a null or empty text has the score of a text without any word. Rows with a null key are scored,
and held out as the condition says, and never train. A key trains once: repeated among the labels with the label that
most of its rows give (1 on a tie), repeated among the documents with its smallest text. Without labels of both kinds every score is 0. An empty table gives an empty one.
Other columns are never read.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.joins import broadcast_if_small
from quayside.llm.words import BLANKS, labelled, whole
from quayside.session import stage

MOST_LABELLED = 6_000  # texts of the start, half of them toxic, as far as there are any
MOST_EACH, MOST_WORDS = 5_000, 4_000_000  # words of the start, of a text and of all
ROUNDS = 2
FINE, FURTHEST = 1024, 60  # steps in which outputs are counted for thresholds, up to there
ROWS, DIM, WIDTHS, FILTERS = 1 << 17, 10, (1, 2, 3), 8
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
SEGMENT = 50  # words
WHOLE = 1 << 30  # by which averaged parameters become whole numbers
GAP = max(WIDTHS) - 1
LEAST_TEXTS = 3
STEPS, BATCH, RATE, DECAY, SEED = 500, 32, 0.01, 1e-3, 23
LATER_RATE = 0.001  # in rounds over all texts
CLEAN_WEIGHT = 5  # a clean text above the threshold weighs as much as so many toxic ones below it
RUN = 20_000  # words worked through at a time, a whole number of segments
MOST_KEPT = 3  # runs of a batch whose outputs are kept for the gradients, and not computed again
MARKS = b".,;:!?|#$%&*\"'()[]{}<>-_/\\=+~^@"
REMEMBERED = 400_000
PORTION = 4_000_000  # bytes of texts read together
TOGETHER = 64  # texts scored together

# Frequent function words by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on are by be this an at from or",
    "fr": "le la les de des du et en un une est que qui dans pour sur au par ne pas il elle",
    "de": "der die das und ist in den von zu mit sich auf für nicht ein eine dem des im auch es",
    "es": "el la los las de del y en que un una es por con para se no su al lo como",
}
LANGUAGES = ("other", *FUNCTION_WORDS)
LANGUAGE_OF = {w.encode(): tuple(k for k, x in enumerate(LANGUAGES) if x != "other" and w in FUNCTION_WORDS[x].split()) for x in FUNCTION_WORDS for w in FUNCTION_WORDS[x].split()}
SPOKEN = [(), *sorted(set(LANGUAGE_OF.values()))]  # sets of languages that have a function word in common
SPOKEN_BY = {word: SPOKEN.index(x) for word, x in LANGUAGE_OF.items()}


class Words:
    """Numbers of words and, for every number, the table rows and the languages of the word; words met before are remembered."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.n = 0
        self.rows = np.zeros((1 << 10, 1 + len(BEGINNINGS)), np.int32)
        self.spoken = np.zeros(1 << 10, np.int64)  # which of ``SPOKEN``

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        """Of different tokens; -1 for those that are nothing but marks."""
        if len(self.number) > REMEMBERED:
            self.clear()
        hashes: list[int] = []
        spoken = []
        for token in tokens:
            if token in self.number:
                continue
            bare = token.strip(MARKS)
            self.number[token] = self.n + len(spoken) if bare else -1
            if bare:
                hashes += [zlib.crc32(bare), *[zlib.crc32(bare[:n], n) if len(bare) > n else 0 for n in BEGINNINGS]]
                spoken.append(SPOKEN_BY.get(bare, 0))
        end = self.n + len(spoken)
        if end > len(self.rows):
            more = max(end, 2 * len(self.rows)) - len(self.rows)
            self.rows, self.spoken = np.pad(self.rows, ((0, more), (0, 0))), np.pad(self.spoken, (0, more))
        new = np.array(hashes, np.int64).reshape(-1, 1 + len(BEGINNINGS))
        self.rows[self.n : end] = np.where(new, 1 + new % (ROWS - 1), 0)
        self.spoken[self.n : end] = spoken
        self.n = end
        return np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))


WORDS = Words()


def read(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Per binary text the table rows of its words, those without anything but marks left out, and its language.

    Row 0 stands for none. The language goes by the function words of the whole text, 0 if none wins clearly. A word is
    looked up once for all the texts.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    words = parts.values.dictionary_encode()
    own = WORDS.numbers(words.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist())
    numbers = own[words.indices.to_numpy()]
    there = numbers >= 0
    text = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))[there]
    numbers = numbers[there]
    said = np.bincount(text * len(SPOKEN) + WORDS.spoken[numbers], minlength=len(texts) * len(SPOKEN))
    votes = said.reshape(-1, len(SPOKEN)) @ np.array([[k in x for k in range(len(LANGUAGES))] for x in SPOKEN], np.int64)
    most, second = np.sort(votes, axis=1)[:, :-3:-1].T
    languages = np.where((most >= 3) & (most > 1.2 * second), votes.argmax(axis=1), 0)
    return np.split(WORDS.rows[numbers], np.searchsorted(text, np.arange(1, len(texts)))) if len(texts) else [], languages


def table_rows(data: bytes) -> np.ndarray:
    """Per word of a text its rows of the embedding table."""
    return read(pa.array([data], pa.binary()))[0][0]


def language(data: bytes) -> int:
    return int(read(pa.array([data], pa.binary()))[1][0])


def portions(texts: pa.Array, together: int = 1) -> Iterator[pa.Array]:
    """The texts in order, about ``PORTION`` bytes at a time, by whole groups of so many; a longer text comes alone."""
    upto = np.append(0, pc.binary_length(texts).to_numpy().cumsum(dtype=np.int64))
    start = 0
    for end in [*range(together, len(texts), together), len(texts)]:
        following = min(end + together, len(texts))
        if end == len(texts) or upto[following] - upto[start] > PORTION:
            yield texts.slice(start, end - start)
            start = end


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.01, (ROWS, DIM)).astype(np.float32)
        self.table[0] = 0
        self.filters = [rng.normal(0, (2 / (w * DIM)) ** 0.5, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.offsets = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = np.abs(rng.normal(0, 0.3, 2 * len(WIDTHS) * FILTERS)).astype(np.float32)
        self.bias = np.full(1, -2, np.float32)

    def dense(self) -> list[np.ndarray]:
        return [*self.filters, *self.offsets, self.out, self.bias]

    def segments(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segments of texts with the words that follow, so that no window is lost between them.

        Per segment the places of its words among all words of the texts, -1 past the end of a text; whether a window
        begins there; and the text.
        """
        lengths = np.array([len(x) for x in texts])
        n = np.maximum(-(-lengths // SEGMENT), 1)
        text = np.repeat(np.arange(len(texts)), n)
        first = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * SEGMENT
        within = first[:, None] + np.arange(SEGMENT + GAP)
        there = within < lengths[text][:, None]
        begin = np.cumsum(lengths) - lengths
        return np.where(there, begin[text][:, None] + within, -1), there[:, :SEGMENT], text

    def outputs(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per segment and filter the largest output, at least 0, and where it is; with words, places and texts."""
        rows = np.concatenate(texts) if texts else np.zeros((0, 1 + len(BEGINNINGS)), np.int32)
        words = np.zeros((len(rows) + 1, DIM), np.float32)  # the last one is for places past the end
        for part in rows.T:
            words[:-1] += self.table[part]
        place, there, text = self.segments(texts)
        grid = words[place]
        best, at = [], []
        for k, width in enumerate(WIDTHS):
            windows = np.concatenate([grid[:, j : j + SEGMENT] for j in range(width)], axis=2)
            found = windows @ self.filters[k] + self.offsets[k]
            found[~there] = 0
            where = found.argmax(axis=1)
            best.append(np.take_along_axis(found, where[:, None], axis=1)[:, 0])
            at.append(where)
        return np.maximum(np.concatenate(best, axis=1), 0), np.concatenate(at, axis=1), grid, place, text

    def margins(self, texts: list[np.ndarray]) -> np.ndarray:
        """The network's output per text. Runs of words are worked through one after the other."""
        return self.pooled(len(texts), map(self.own_outputs, parts_of(texts)))[0] @ self.out + self.bias[0]

    def own_outputs(self, part: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, ...]:
        """``outputs`` of a part, its segments' texts numbered as in all, without the words that the next part begins with."""
        best, at, grid, place, text = self.outputs([x for _, x in part])
        own = np.concatenate([np.arange(max(-(-len(x) // SEGMENT), 1)) * SEGMENT < RUN for _, x in part])
        return best[own], at[own], grid[own], place[own], np.array([k for k, _ in part])[text[own]]

    def pooled(self, n_texts: int, found: Iterable[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the largest and the mean outputs of its segments, and the number of segments."""
        n = len(WIDTHS) * FILTERS
        most, total, count = (np.zeros((n_texts, m), np.float32) for m in (n, n, 1))
        for best, _, _, _, text in found:
            starts = first_of(text)
            own = text[starts]
            most[own] = np.maximum(most[own], np.maximum.reduceat(best, starts))
            total[own] += np.add.reduceat(best, starts)
            count[own, 0] += np.diff(np.append(starts, len(text)))
        return np.hstack([most, total / np.maximum(count, 1)]), count

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> None:
        """Adam on the logistic loss of balanced batches."""
        rng = np.random.default_rng(seed)
        rare = np.bincount(np.concatenate([np.unique(x) for x in texts]), minlength=ROWS) < LEAST_TEXTS
        self.table[rare] = 0
        texts = [np.where(rare[x], 0, x) for x in texts]
        kinds = [np.flatnonzero(labels == y) for y in (0, 1)]
        adam = Adam(self)
        for _ in range(steps):
            chosen = np.concatenate([rng.choice(k, BATCH // 2) for k in kinds])
            adam.step([texts[c] for c in chosen], labels[chosen])

    def gradients(
        self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray | None = None
    ) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Of the mean loss: for the dense parameters, and for the table rows that the texts touch."""
        parts = list(parts_of(texts))
        kept = [self.own_outputs(x) for x in parts] if len(parts) <= MOST_KEPT else None
        pooled, count = self.pooled(len(texts), kept or map(self.own_outputs, parts))
        chance = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.bias[0], -30, 30)))
        wrong = ((chance - labels) / len(texts)).astype(np.float32)
        if weights is not None:
            wrong *= weights.astype(np.float32)
        back = wrong[:, None] * self.out
        n = len(WIDTHS) * FILTERS
        found = np.zeros((len(texts), n), bool)  # whether a largest output was met in a part before
        grads_f, grads_o = [np.zeros_like(f) for f in self.filters], [np.zeros_like(o) for o in self.offsets]
        row, row_grad = [], []
        for part, (best, at, grid, place, text) in zip(parts, kept or map(self.own_outputs, parts)):
            # The largest output of a text is its first segment's that has it; all segments share in the mean.
            is_most = best == pooled[text, :n]
            starts = first_of(text)
            within = np.repeat(starts, np.diff(np.append(starts, len(text))))
            ranks = np.cumsum(is_most, axis=0)
            is_first = is_most & (ranks - (ranks[within] - is_most[within]) == 1) & ~found[text]
            found[text[starts]] |= np.logical_or.reduceat(is_most, starts)
            flow = np.where(is_first, back[text, :n], 0) + back[text, n:] / count[text]
            flow = (flow * (best > 0)).astype(np.float32)
            touched, changes = [], []
            for k, width in enumerate(WIDTHS):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                segment, which = np.nonzero(flow[:, own])
                amount = flow[:, own][segment, which]
                spans = at[:, own][segment, which][:, None] + np.arange(width)
                seen = grid[segment[:, None], spans].reshape(len(segment), width * DIM)
                for f in range(FILTERS):
                    grads_f[k][:, f] += amount[which == f] @ seen[which == f]
                grads_o[k] += np.bincount(which, amount, FILTERS).astype(np.float32)
                per_word = (amount[:, None] * self.filters[k].T[which]).reshape(len(segment), width, DIM)
                words = place[segment[:, None], spans]
                touched.append(words[words >= 0])
                changes.append(per_word[words >= 0])
            word, grad = summed(np.concatenate(touched), np.concatenate(changes))
            tokens = np.concatenate([x for _, x in part])[word]
            there = tokens > 0
            one, one_grad = summed(tokens[there], np.repeat(grad, there.sum(axis=1), axis=0))
            row.append(one)
            row_grad.append(one_grad)
        grads = [*grads_f, *grads_o, pooled.T @ wrong + 1e-4 * self.out, np.array([wrong.sum()], np.float32)]
        return grads, *(summed(np.concatenate(row), np.concatenate(row_grad)) if len(row) > 1 else (row[0], row_grad[0]))


def first_of(numbers: np.ndarray) -> np.ndarray:
    """Where a stretch of equal numbers begins."""
    return np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)])


def parts_of(texts: list[np.ndarray]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Runs of words of texts, as pairs of a text's number and its words, about ``RUN`` words at a time.

    A part of a long text ends with the words after it, whose own windows belong to the next part.
    """
    some: list[tuple[int, np.ndarray]] = []
    size = 0
    for k, rows in enumerate(texts):
        for start in range(0, max(len(rows), 1), RUN):
            some.append((k, rows[start : start + RUN + GAP]))
            size += len(some[-1][1]) + SEGMENT
            if size >= RUN:
                yield some
                some, size = [], 0
    if some:
        yield some


class Adam:
    """Steps of a network, each down the gradients of one batch."""

    def __init__(self, network: Network, rate: float = RATE):
        self.network, self.rate, self.taken = network, rate, 0
        self.memory = [(np.zeros_like(p), np.zeros_like(p)) for p in [*network.dense(), network.table]]

    def step(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray | None = None) -> None:
        network = self.network
        self.taken += 1
        grads, rows, row_grads = network.gradients(texts, labels, weights)
        fade = (1 - 0.999**self.taken) ** 0.5 / (1 - 0.9**self.taken)
        for p, g, (m, v) in zip(network.dense(), grads, self.memory):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * fade * m / (np.sqrt(v) + 1e-7)
        m, v = self.memory[-1]
        row_grads = row_grads + DECAY * network.table[rows]
        m[rows] += 0.1 * (row_grads - m[rows])
        v[rows] += 0.001 * (row_grads**2 - v[rows])
        network.table[rows] -= self.rate * fade * m[rows] / (np.sqrt(v[rows]) + 1e-7)
        np.maximum(network.out, 0, out=network.out)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the rows of ``values`` per key."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = first_of(keys)
    return keys[starts], np.add.reduceat(values[order], starts, axis=0)


def threshold(margins: np.ndarray, labels: np.ndarray, n: np.ndarray | int = 1) -> float:
    """Where most labels are right, each kind counting as a whole by its weight; in the middle of the best gap.

    ``n`` says how many texts have each margin and label.
    """
    order = np.lexsort((labels, margins))
    margins = margins[order]
    toxic, clean = ((np.broadcast_to(n, labels.shape) * (labels == y))[order] for y in (1, 0))
    caught = toxic[::-1].cumsum()[::-1] / max(toxic.sum(), 1)  # at or above each margin
    passed = np.concatenate([[0], clean.cumsum()[:-1]]) / max(clean.sum(), 1)  # below it
    k = int((caught + CLEAN_WEIGHT * passed).argmax())
    return float(margins[k] if k == 0 else (margins[k - 1] + margins[k]) / 2)


class Classifier:
    """The trained network with a threshold per language."""

    LEAST = 15  # toxic rows by which a language gets a threshold of its own

    def __init__(self, network: Network, margins: np.ndarray, languages: np.ndarray, labels: np.ndarray, n: np.ndarray):
        self.network = network
        self.thresholds = np.full(len(LANGUAGES), threshold(margins, labels, n))
        for k in range(len(LANGUAGES)):
            own = languages == k
            if min(n[own & (labels == y)].sum() for y in (0, 1)) >= self.LEAST:
                self.thresholds[k] = threshold(margins[own], labels[own], n[own])

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = []
        for some in portions(texts, TOGETHER):
            rows, languages = read(some)
            margins = [self.network.margins(rows[k : k + TOGETHER]) for k in range(0, len(rows), TOGETHER)]
            limits = self.thresholds[languages]
            found.append(1 / (1 + np.exp(-np.clip(np.concatenate([*margins, []]) - limits, -30, 30).astype(np.float64))))
        return np.concatenate(found)


def drawn(known: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` of the rows with ``key`` and ``y``, as many toxic ones as others if there are."""
    n = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = [min(1.0, most / 2 / max(n.get(k, 0), 1)) for k in (0, 1)]
    draw = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) / (1 << 30)
    return known.where(draw < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))


def sampled(
    docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, held_out: Column, most: int | None = None
) -> DataFrame:
    """Labelled texts ``key, y, data, n`` with ``n`` words: all of them, or at most about ``most``."""
    known = stage(labelled(labels, key, label, held_out), "labels")
    chosen = known if most is None else drawn(known, most)
    texts = docs.select(F.col(f"`{key}`").alias("key"), whole(text).alias("body")).join(broadcast_if_small(chosen), "key")
    texts = texts.groupBy("key").agg(F.min(F.struct("y", "body")).alias("least")).select("key", "least.*")
    n = F.size(F.split("body", BLANKS))
    return texts.select("key", "y", F.col("body").cast("binary").alias("data"), n.alias("n"))


def words_each(lengths: list[int], each: int = MOST_EACH, most: int = MOST_WORDS) -> int:
    """How many words a text may train with, so that texts of these lengths have at most ``most`` together."""
    left = most
    for k, n in enumerate(sorted(min(n, each) for n in lengths)):
        if n * (len(lengths) - k) > left:
            return left // (len(lengths) - k)
        left -= n
    return each


def excerpt(data: bytes, most: int) -> bytes:
    """A text's words; of more than ``most`` words seeded runs, each on a line of its own and in order."""
    tokens = data.split()
    if len(tokens) <= most:
        return b" ".join(tokens)
    size = SEGMENT - GAP
    starts = np.arange(0, len(tokens), size)
    rng = np.random.default_rng([SEED, zlib.crc32(data)])
    chosen = np.sort(rng.choice(starts, max(most // SEGMENT, 1), replace=False))
    return b"\n".join(b" ".join(tokens[k : k + size]) for k in chosen.tolist())


def excerpt_rows(data: bytes) -> np.ndarray:
    """The table rows of an excerpt, each run a segment of its own, so that no window spans two runs."""
    runs = [table_rows(x) for x in data.split(b"\n")]
    if len(runs) == 1:
        return runs[0]
    return np.concatenate([np.pad(x, ((0, SEGMENT - len(x)), (0, 0))) for x in runs])


def started(learns: DataFrame) -> Network:
    """A network trained on a bounded number of the texts."""
    some = stage(drawn(learns, MOST_LABELLED), "toxic-start")
    each = words_each([r.n for r in some.select("n").collect()])

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [excerpt(x.as_buffer().to_pybytes(), each) for x in batch.column("data")]
            yield batch.set_column(batch.num_columns - 1, "data", pa.array(texts, pa.binary()))

    chosen = some.select("key", "y", "data")
    rows = chosen.mapInArrow(shorten, chosen.schema).orderBy(F.xxhash64("key"), "key", F.md5("data")).collect()
    network = Network()
    network.fit([excerpt_rows(bytes(r.data)) for r in rows], np.array([r.y for r in rows]))
    return network


def batches_of(data: pa.Array, y: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Words and labels of ``BATCH`` texts, or of fewer if these are long."""
    some, labels, size = [], [], 0
    for rows, label in zip((rows for part in portions(data) for rows in read(part)[0]), y.tolist()):
        some.append(rows)
        labels.append(label)
        size += len(some[-1])
        if len(some) == BATCH or size >= MOST_KEPT * RUN:
            yield some, np.array(labels)
            some, labels, size = [], [], 0
    if some:
        yield some, np.array(labels)


# Averages of parameters, which are dealt like rows of the table, DIM of them each; those after the table are the dense ones.
AVERAGE = [f"p{k}" for k in range(DIM)]


def trained_round(network: Network, texts: DataFrame, weights: tuple[float, float]) -> tuple[Network, np.ndarray]:
    """The network after one pass over ``y, data``, and per row of the table the number of texts that touch it."""
    shared = texts.sparkSession.sparkContext.broadcast(network)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.deepcopy(shared.value)
        adam = Adam(own, LATER_RATE)
        n, touched = 0, np.zeros(ROWS, np.int64)
        for batch in batches:
            rng = np.random.default_rng([SEED, n])
            mixed = batch.take(pa.array(rng.permutation(batch.num_rows)))
            for words, y in batches_of(mixed.column("data"), mixed.column("y").to_numpy()):
                for rows in words:
                    touched[np.unique(rows)] += 1
                adam.step(words, y, np.take(weights, y))
                n += len(y)
        if not n:
            return
        touched[0] = 0
        dense = np.concatenate([p.ravel() for p in own.dense()])
        dense = np.pad(dense, (0, -len(dense) % DIM)).reshape(-1, DIM)
        rows = np.flatnonzero(touched)
        number = np.concatenate([rows, ROWS + np.arange(len(dense))])
        times = np.concatenate([touched[rows], np.full(len(dense), n)])
        value = np.rint(np.concatenate([own.table[rows], dense]).astype(np.float64) * WHOLE).astype(np.int64) * times[:, None]
        columns = [pa.array(number), pa.array(times), *map(pa.array, value.T.copy())]
        yield pa.RecordBatch.from_arrays(columns, names=["number", "n", *AVERAGE])

    kind = ", ".join(f"{c} bigint" for c in ("number", "n", *AVERAGE))
    parts = texts.select("y", "data").mapInArrow(run, kind)
    summed_up = parts.groupBy("number").agg(*[F.sum(c).alias(c) for c in ("n", *AVERAGE)])
    found = summed_up.toArrow()  # a row per row of the network
    number, times = found["number"].to_numpy(), found["n"].to_numpy()
    value = np.stack([found[c].to_numpy() for c in AVERAGE], axis=1) / times[:, None] / WHOLE
    after, touched, own = copy.deepcopy(network), np.zeros(ROWS, np.int64), number < ROWS
    touched[number[own]] = times[own]
    after.table[number[own]] = value[own]
    dense, low = value[~own][np.argsort(number[~own])].ravel(), 0
    for p in after.dense():
        p[...] = dense[low : low + p.size].reshape(p.shape) if len(dense) else p
        low += p.size
    return after, touched


def judged_counts(network: Network, texts: DataFrame) -> pa.Table:
    """Of ``y, data``: how many have each ``y``, ``language`` and ``margin``, which is counted in steps."""
    shared = texts.sparkSession.sparkContext.broadcast(network)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins, languages = [], []
            for part in portions(batch.column("data")):
                texts, spoken = read(part)
                margins += [float(shared.value.margins([rows])[0]) for rows in texts]
                languages += spoken.tolist()
            steps = np.rint(np.clip(margins, -FURTHEST, FURTHEST) * FINE).astype(np.int64)
            columns = [batch.column("y"), pa.array(steps), pa.array(languages, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["y", "margin", "language"])

    told = texts.select("y", "data").mapInArrow(judge, "y int, margin bigint, language int")
    return told.groupBy("y", "margin", "language").agg(F.count("*").alias("n")).toArrow()


def train(examples: DataFrame) -> Classifier | None:
    """``examples`` has ``key, y, data, n`` and is a written table; a fifth by the hash of the key calibrates."""
    calibrates = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(5)) == 0
    marked = examples.withColumn("calibrates", calibrates)
    numbers = {(r.calibrates, r.y): r.n for r in marked.groupBy("calibrates", "y").agg(F.count("*").alias("n")).collect()}
    kinds = {c: [y for y in (0, 1) if (c, y) in numbers] for c in (False, True)}
    if len(kinds[False]) < 2:
        return None
    apart = len(kinds[True]) == 2
    learns, judged = (marked.where(~F.col("calibrates")), marked.where("calibrates")) if apart else (marked, marked)
    n = [sum(numbers.get((c, y), 0) for c in ((False,) if apart else (False, True))) for y in (0, 1)]
    weights = sum(n) / 2 / n[0], sum(n) / 2 / n[1]

    network, touched = started(learns), np.zeros(ROWS, np.int64)
    turn = F.pmod(F.xxhash64("key", F.lit(7)), F.lit(ROUNDS))
    for k in range(ROUNDS):
        network, more = trained_round(network, learns.where(turn == k), weights)
        touched += more
    network.table[touched < LEAST_TEXTS] = 0

    found = judged_counts(network, judged)
    margins, labels, languages, count = (found[c].to_numpy() for c in ("margin", "y", "language", "n"))
    return Classifier(network, margins / FINE, languages, labels, count)


def score(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: key, ``held_out``, ``score`` and ``predicted``.

    ``held_out`` is a condition on the key column; labels of those rows are not used at all.
    """
    examples = stage(sampled(docs, labels, label, key, text, held_out), "toxic-examples")
    shared = docs.sparkSession.sparkContext.broadcast(train(examples))  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = shared.value
        for batch in batches:
            texts = batch.column("_text")
            found = np.zeros(len(texts)) if classifier is None else classifier.scores(texts)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.float64())], names=["key", "score"])

    chosen = docs.select(F.col(f"`{key}`").alias("key"), whole(text).cast("binary").alias("_text"))
    scored = chosen.mapInArrow(run, f"key {chosen.dtypes[0][1]}, score double").withColumnRenamed("key", key)
    return scored.select(
        key, F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
