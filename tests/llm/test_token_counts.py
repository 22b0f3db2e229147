"""Token counts against the library that the vocabulary belongs to."""

import random

import public_tokenizers
import pytest
from llm.helpers import DOCUMENT, no_documents, odd_documents, with_clashes
from tokenizers import Tokenizer

from quayside.llm import byte_pairs, queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = [*"ab  \n\n\t\x1c\x85\xa0é中1²'s't ,.|Ⅷ​😀ßʼn", "<|endoftext|>", " word", "\nWord", "don't", " 1234", "...", "###"]


def expected(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize(
    "text",
    ["", " ", "\n", "a", " a", "a ", "a\nb", "a\n\nb", "a\n\n\nb", "a  b", "a\t b", "<|endoftext|>", "x<|endoftext|> y", "é́ x",
     "A.\n\nB\n C \nD", "aaaa" * 900, "ab" * 3000, "中文 字", "<|endoftext", "don't we'll I'M"],
)
def test_counts(text):
    assert token_counts.counter(PATH).count(text) == expected(text)


def test_random_texts():
    rng, counter = random.Random(1), token_counts.counter(PATH)
    for _ in range(2500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 40)))
        assert counter.count(text) == expected(text), repr(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 3)
    counter = token_counts.Counter(PATH)
    for text in ("one two three four five six", "one two seven", "one"):
        assert counter.count(text) == expected(text)
    assert len(counter.by_chunk) <= 3


def test_query(spark, sf_dir):
    found = queries.queries()["op6_token_counts"](spark, sf_dir).toPandas().set_index("doc_id")
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas().set_index("doc_id").text
    assert len(found) == len(texts)
    assert found.n_tokens.to_dict() == {k: expected(t) for k, t in texts.items()}
    assert found.n_bytes.to_dict() == {k: len(t.encode()) for k, t in texts.items()}
    assert (found.over_limit == (found.n_tokens > 512)).all()


def test_odd_inputs(spark):
    docs = with_clashes(odd_documents(spark), "n_tokens", "n_bytes")
    texts = [r.text for r in docs.collect()]
    rows = token_counts.count_tokens(docs, PATH).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(map(expected, texts))
    assert token_counts.count_tokens(no_documents(spark), PATH).count() == 0
    edge = spark.createDataFrame([(1, "a " * 511 + "a", "en", "s", 1), (2, "a " * 512 + "a", "en", "s", 1)], DOCUMENT)
    limits = {r.doc_id: (r.n_tokens, r.over_limit) for r in token_counts.count_tokens(edge, PATH).collect()}
    assert limits == {1: (512, False), 2: (513, True)}
