"""Line rules against plain Python and against their SQL."""

import random
import re
from collections import Counter

import pytest
from compare import differences
from llm.helpers import DOCUMENT, no_documents, odd_documents, prose, with_clashes

from quayside.llm import line_rules, queries, sql

BLANK = re.compile(r"[\x20\x09-\x0D]+")
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base(text):
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def repeated_text(rng):
    """Sentences from so few words that windows repeat in every way."""
    return " ".join(rng.choice("ab bc ca ab, \n".split(" ")) for _ in range(rng.randint(0, 120)))


def test_base_counts_equal_python(spark):
    rng = random.Random(2)
    texts = [repeated_text(rng) for _ in range(300)] + [prose(rng, 300), "é ß\x0b漢字\u2003x " * 30, "one", "a b", "a b c a b c"]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], DOCUMENT)
    got = {r.doc_id: tuple(r[f] for f in FIELDS) for r in line_rules.judge_lines(docs).collect()}
    assert got == {k: base(t) for k, t in enumerate(texts)}


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("An ordinary line of prose.", False),
        ("Short title", False),
        ("", False),
        (" \t ", False),
        ("Home", True),
        ("Next page >", True),
        ("one | two | three", True),
        ("all### the*** words&&& marked$$$", True),
        ("SHOUT!! LOUD!! NOW!!", True),
        ("Copyright 2021 by someone", True),
        ("Please enable JavaScript to read on.", True),
        (" ".join(["word"] * 50), True),
        (" ".join(["word"] * 50) + ".", False),
        (" ".join(["word"] * 50) + " privacy policy.", False),
    ],
)
def test_lines(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(line_rules.failing_line(df.line)).first()[0] is fails


def test_cleaning_and_verdict(spark):
    rng = random.Random(3)
    good, menu = prose(rng, 90), "\n".join(["Home", "a | b | c", "Log in"])
    junk = "\n".join(" ".join(f"{w}###" for w in prose(rng, 20).split()) for _ in range(10))
    texts = {1: good, 2: f"{good}\n{menu}", 3: f"{good}\n{junk}", 4: "too short."}
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in texts.items()], DOCUMENT)
    got = {r.doc_id: r for r in line_rules.judge_lines(docs).collect()}
    assert {k: r.kept for k, r in got.items()} == {1: True, 2: True, 3: False, 4: False}
    assert got[2].clean_text == good and got[1].clean_text == good
    kept = line_rules.clean(docs).collect()
    assert sorted(tuple(r) for r in kept) == sorted((k, texts[k], "en", "s", 1) for k in (1, 2))


def test_odd_inputs(spark):
    docs = with_clashes(odd_documents(spark), "kept", "n_words", "clean_text")
    rows = line_rules.judge_lines(docs).collect()
    assert len(rows) == docs.count() and all(r.kept is not None for r in rows)
    assert all(r.n_words == 0 and not r.kept for r in rows if r.clean_text in ("", " \n\t "))
    kept = line_rules.clean(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {None, 3}
    assert line_rules.judge_lines(no_documents(spark)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.queries()["op3_line_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_equals_sql(spark, sf_dir):
    assert differences(queries.queries()["op3_line_rules"](spark, sf_dir), sql.LINE_RULES, sf_dir) == []
