"""Packing: ids, cuts, dominance, and how few sequences."""

import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from llm.helpers import no_documents, odd_documents, with_clashes
from tokenizers import Tokenizer

from quayside.llm import byte_pairs, packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = [*"ab  \n\n\t\x1c\x85\xa0é中1²'s't ,.|​😀", "<|endoftext|>", " word", "\nWord", "don't"]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_equal_the_library(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    code = packing.Encoder(PATH)
    assert [np.frombuffer(x, "<u4").tolist() + [0] for x in code.encode(texts)] == [ids(t) for t in texts]
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 5)
    for k in range(0, 300, 10):
        assert [np.frombuffer(x, "<u4").tolist() + [0] for x in code.encode(texts[k : k + 10])] == [ids(t) for t in texts[k : k + 10]]


@pytest.mark.parametrize(
    ("n", "cuts"), [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]), (19, [(0, 3), (3, 8), (11, 8)])]
)
def test_cut(n, cuts):
    assert packing.cut(n, 8) == cuts


def sequences(histogram):
    """Checks that a plan is sound and counts its sequences."""
    capacity = len(histogram) - 1
    placer = packing.Placer(packing.plan(histogram), capacity)
    length = np.repeat(np.arange(capacity + 1), histogram)
    number = np.concatenate([np.arange(n) for n in histogram]) if histogram.sum() else np.zeros(0, int)
    sequence, offset = placer(length, number) if len(length) else (length, number)
    order = np.lexsort((offset, sequence))
    sequence, offset, length = sequence[order], offset[order], length[order]
    first = np.r_[True, sequence[1:] != sequence[:-1]][: len(sequence)]
    assert (offset == np.where(first, 0, np.r_[0, (offset + length)[:-1]][: len(offset)])).all()
    assert (offset + length <= capacity).all()
    return int(first.sum())


def fewest(lengths, capacity):
    """The least number of sequences, by trying every set that can share one."""

    @lru_cache(None)
    def least(left):
        if not left:
            return 0
        head, rest = left[0], left[1:]
        best = len(left)
        for mask in range(1 << len(rest)):
            own = [rest[k] for k in range(len(rest)) if mask >> k & 1]
            if head + sum(own) <= capacity:
                best = min(best, 1 + least(tuple(rest[k] for k in range(len(rest)) if not mask >> k & 1)))
        return best

    return least(tuple(sorted(lengths, reverse=True)))


def test_few_pieces_pack_best():
    rng = random.Random(2)
    worse = 0
    for _ in range(120):
        capacity = rng.choice([10, 17])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        got = sequences(np.bincount(lengths, minlength=capacity + 1))
        best = fewest(lengths, capacity)
        assert got <= best + 1
        worse += got > best
    assert worse <= 4


def test_dominating_sets_lose_nothing():
    """A fixed set and the best packing of the rest need as few sequences as the best packing of all."""
    rng = random.Random(3)
    proven = 0
    for _ in range(250):
        capacity = rng.choice([10, 13])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)
        rest = np.bincount(lengths[1:], minlength=capacity + 1)
        found = packing.dominating_set(rest, lengths[0])
        if found is None:
            continue
        proven += 1
        left = list(lengths[1:])
        for x in found:
            left.remove(x)
        assert 1 + fewest(left, capacity) == fewest(lengths, capacity)
    assert proven > 100


def test_many_pieces_pack_tightly():
    rng = np.random.default_rng(4)
    lengths = np.clip(rng.lognormal(6, 1, 100_000).astype(int) + 1, 1, 2048)
    got = sequences(np.bincount(lengths, minlength=2049))
    assert got <= 1.002 * lengths.sum() / 2048 + 1
    assert sequences(np.zeros(2049, int)) == 0


def check(docs, packed, capacity):
    """Every document's tokens are there once, in order, and sequences have no gaps."""
    rows = packed.collect()
    texts = sorted((str(r.doc_id), ids(r.text)) for r in docs.collect())
    got = {}
    for r in rows:
        got.setdefault(str(r.doc_id), []).append(r)
    for name in {t[0] for t in texts}:
        own = [t[1] for t in texts if t[0] == name]
        expected = sorted(
            (k, start, n, zlib.crc32(np.array(x[start : start + n], "<u4").tobytes()))
            for x in own for k, (start, n) in enumerate(packing.cut(len(x), capacity))
        )
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got[name]) == expected
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in ends.values())
    return len(ends), sum(r.length for r in rows)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n, tokens = check(docs, queries.queries()["op9_packing"](spark, sf_dir), 2048)
    assert n <= 1.02 * tokens / 2048 + 1


def test_odd_inputs(spark):
    docs = with_clashes(odd_documents(spark), "piece", "length", "number", "task", "offset", "n", "begin")
    check(docs, packing.pack(docs, PATH, 64), 64)
    assert packing.pack(no_documents(spark), PATH).count() == 0


def test_long_chunks_are_not_remembered(monkeypatch):
    """What a worker keeps is bounded in bytes too."""
    code = packing.Encoder(PATH)
    texts = ["a " + "longword" * 5000 + " b", "c " + "longword" * 5000, "d\n" + "x1" * 100]
    assert [np.frombuffer(x, "<u4").tolist() + [0] for x in code.encode(texts)] == [ids(t) for t in texts]
    assert code.known and max(map(len, code.known)) <= byte_pairs.LONGEST_REMEMBERED
    given, ids_of = [], code.ids
    monkeypatch.setattr(code, "ids", lambda some: given.append(some) or ids_of(some))
    many = " ".join(f"n{k}" for k in range(30_000))
    assert np.frombuffer(code.encode([many])[0], "<u4").tolist() + [0] == ids(many)
    assert max(len(x[0]) for x in given) < len(many) / 4  # new words go to the library a few thousand at a time


def test_new_words_go_to_the_library_once(monkeypatch):
    """A word met again costs no work of the library, nor does a mark after it; words met once don't crowd others out."""
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 200)
    code = packing.Encoder(PATH)
    given, ids_of = [], code.ids
    monkeypatch.setattr(code, "ids", lambda some: given.extend(some) or ids_of(some))
    often = "o " + " ".join(f"often{a}" for a in "abcdefghij" * 3)
    for k in range(20):
        text = f"{often} {' '.join(f'once{k}x{n}' for n in range(50))} oftena. oftenb, oftenc"
        assert np.frombuffer(code.encode([text])[0], "<u4").tolist() + [0] == ids(text)
    assert sum("oftena" in t for t in given) == 1 and not any("oftena." in t or "oftenb," in t for t in given)
    assert len(code.known) <= 200


def test_even_texts():
    for text in ("", "a", "a b\nc\n\nd", "é ü"):
        assert byte_pairs.even(text)
    for text in (" a", "a ", "a  b", "a \nb", "a\n b", "a\n\n\nb", "a\tb", "a\x1fb", "a\u00a0b", "a\u2003b", "\n", "a\n"):
        assert not byte_pairs.even(text) and byte_pairs.chunks(text) is None


def test_portions():
    assert list(packing.portions([5, 5, 1, 20, 3], 10)) == [(0, 2), (2, 4), (4, 5)]
    assert list(packing.portions([], 10)) == [] and list(packing.portions([0, 0], 10)) == [(0, 2)]
