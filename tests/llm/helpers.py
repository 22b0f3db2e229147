"""Small corpora and the odd inputs that every operator must take."""

import random

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOWELS, CONSONANTS = "aeiou", "bdfglmnprstv"


def word(rng: random.Random) -> str:
    return "".join(rng.choice(CONSONANTS) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4)))


def prose(rng: random.Random, n: int) -> str:
    """Sentences of invented words on a few lines."""
    out = []
    for k in range(n):
        w = word(rng)
        out.append(w + ("." if k % 9 == 8 or k == n - 1 else ""))
    return "\n".join(" ".join(out[i : i + 45]) for i in range(0, n, 45))


def odd_rows(rng: random.Random) -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = prose(rng, 6000)
    return [
        (1, None, "en", "a", 0),
        (2, "", None, None, 0),
        (None, prose(rng, 80), "en", "b", None),
        (None, None, None, None, None),
        (3, long, "en", "a", len(long)),
        (4, "same words here.", "en", "a", 16),
        (4, "same words here.", "en", "a", 16),
        (5, "same words here.", "en", "b", 16),
        (6, " \n\t ", "en", "b", 4),
    ]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(random.Random(5)), DOCUMENT)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)


def with_clashes(docs, *names):
    """Extra columns under names that results or intermediate columns have."""
    for name in ("key", "size", "_text", "_row", "x", "page", *names):
        if name not in docs.columns:
            docs = docs.selectExpr("*", f"'extra' as `{name}`")
    return docs
