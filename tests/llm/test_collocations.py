"""Collocations against counting in plain Python, and odd input."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import DOCUMENT, no_documents, odd_documents, with_clashes

from quayside.llm import collocations as C


def plain(rows, least, longest, top, share):
    counts, sizes = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        held = set()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= share * f[p[i:j]]:
                        held.add(p[i:j])
        ranked = []
        for p, a in candidates.items():
            if p not in held:
                cuts = [(1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(found)


def corpus(rng, n=400):
    vocabulary = [*"abcdefgh", "É", "über", "ＡＢ", "x" * 40, "İ", "\x1f", "\xa0"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "!", "\n", "\r\n", "\x0b", " ; "]
    rows = []
    for k in range(n):
        words = [rng.choice(vocabulary[: rng.randint(2, len(vocabulary))]) for _ in range(rng.randint(0, 60))]
        text = "".join(w.upper() + rng.choice(marks) if rng.random() < 0.2 else w + rng.choice(marks) for w in words)
        rows.append((k, text, rng.choice(["en", "en", "de", None]), "s", len(text)))
    return rows + [rows[0]] * 30


@pytest.mark.parametrize("least, longest, top, share", [(20, 5, 2000, 100), (5, 5, 50, 80), (3, 3, 10, 100), (2, 2, 1000, 50)])
def test_equals_plain_counting(spark, least, longest, top, share):
    rows = corpus(random.Random(least))
    found = C.collocations(spark.createDataFrame(rows, DOCUMENT), least, longest, top, share)
    assert sorted(map(tuple, found.collect())) == plain(rows, least, longest, top, share)


def test_batches_may_cut_stretches(spark):
    rows = corpus(random.Random(11), 200)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = C.collocations(spark.createDataFrame(rows, DOCUMENT), 8, 5, 2000, 100)
        assert sorted(map(tuple, found.collect())) == plain(rows, 8, 5, 2000, 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_full_table_of_bits_changes_nothing(spark, monkeypatch):
    """What passes by chance goes by its true count."""
    rows = corpus(random.Random(9), 150)
    monkeypatch.setattr(C, "frequent_bits", lambda frequent: np.full(1 << (C.BITS - 6), (1 << 64) - 1, np.uint64))
    found = C.collocations(spark.createDataFrame(rows, DOCUMENT), 10, 5, 2000, 100)
    assert sorted(map(tuple, found.collect())) == plain(rows, 10, 5, 2000, 100)


def test_small_portions_change_nothing(monkeypatch):
    rows = corpus(random.Random(4), 100)
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] for r in rows])], ["lang", "text"])

    def counts():
        total = Counter()
        for lang, texts in C.some_texts(batch):
            (phrases,), counts = C.word_counts(C.Words(texts), lang)
            for phrase, n in zip(phrases, counts):
                total[lang, phrase.as_py()] += int(n)
        return total

    whole = counts()
    monkeypatch.setattr(C, "TEXT_AT_ONCE", 50)
    assert counts() == whole and sum(whole.values()) > 1000


def test_products_beyond_64_bits(spark, monkeypatch):
    """a * n of 4e9 words is beyond a long."""
    f = 4_000_000_007
    counts = spark.createDataFrame([("en", "a", f), ("en", "b", f), ("en", "a b", f - 1)], "lang string, phrase string, f bigint")
    sizes = spark.createDataFrame([("en", 3 * f)], "lang string, n bigint")
    monkeypatch.setattr(C, "phrase_counts", lambda *_: (counts, sizes))
    (row,) = C.collocations(no_documents(spark)).collect()
    assert row.score == 1000 * (f - 1) * 3 * f // (f * f) and (row.a, row.l, row.r) == (f - 1, f, f)


def test_odd_input(spark):
    docs = with_clashes(odd_documents(spark), "phrase", "f", "n", "rank", "words")
    rows = [tuple(r)[:5] for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = C.collocations(docs, 3, 5, 100, 100)
    assert sorted(map(tuple, found.collect())) == plain(rows, 3, 5, 100, 100)
    empty = C.collocations(no_documents(spark))
    assert empty.collect() == [] and empty.columns == found.columns


def test_a_run_needs_frequent_triples(spark):
    """Frequent pairs alone make no runs: what is emitted for them would outgrow the texts."""
    words = C.Words(pa.array(["a b c d e", "a b c", "b c d", "x a b c d"]))
    hashes = dict(zip(words.distinct.to_pylist(), words.hashes("en")))
    blocks = np.zeros(1 << (C.BITS - 6), np.uint64)
    for a, b, c in (b"abc", b"bcd"):
        of = [np.array([hashes[bytes([w])]], np.uint64) for w in (a, b, c)]
        for at in C.bit_places(C.mixed(C.mixed(of[0], of[1]), of[2])):
            blocks[at >> np.uint64(6)] |= np.uint64(1) << (at & np.uint64(63))
    columns, counts = C.run_counts(words, "en", C.Bits(blocks), 5)
    found = [tuple(w.as_py() for w in row) for row in zip(*columns)]
    assert dict(zip(found, counts.tolist())) == {(b"a", b"b", b"c", b"d", None): 2}
    everything = C.Bits(np.full(1 << (C.BITS - 6), (1 << 64) - 1, np.uint64))
    (phrases,), counts = C.triple_counts(words, "en", everything)
    expected = {b"a b c": 3, b"b c d": 3, b"c d e": 1, b"x a b": 1}
    assert dict(zip(phrases.to_pylist(), counts.tolist())) == expected
    short = C.Words(pa.array(["a", "b c"]))
    assert C.triple_counts(short, "en", everything)[1].sum() == C.run_counts(short, "en", everything, 5)[1].sum() == 0


@pytest.mark.parametrize("longest", [4, 6])
def test_other_lengths_equal_plain_counting(spark, longest):
    rows = corpus(random.Random(longest), 150)
    found = C.collocations(spark.createDataFrame(rows, DOCUMENT), 6, longest, 500, 100)
    assert sorted(map(tuple, found.collect())) == plain(rows, 6, longest, 500, 100)
