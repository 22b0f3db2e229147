"""Line-first cleaning: judge every line, remove the failing ones, reject a document that loses too much.

Built-in functions only. Each row is worked on by itself, so nothing is shuffled and no group can grow hot; a row
costs time and memory in proportion to its own text (its windows are sorted: n log n).

Results for odd input: a null or empty text has no words and fails the base check, so it is not kept and its
cleaned text is empty. Repeated rows are judged alike, each for itself. An empty table gives an empty table. Columns
of the input other than the key and the text are ignored by ``judge_lines`` and returned untouched by ``clean``,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.words import WORD, let, whole, words

SYMBOLS = r"[#*$%&|<>]"
SENTENCE_MARKS = r"[.!?,;:。！？、…]"
# Fixed values of the rules: phrases of site navigation and of legal or technical boilerplate.
NAVIGATION = (
    r"(?i)^[^\pL\pN]*(home|menu|log ?in|sign (in|up)|register|next( page)?|prev(ious)?( page)?|back to top|"
    r"skip to (main )?content|read more|search|site ?map|contact( us)?|about us|share|print|reply)[^\pL\pN]*$"
)
BOILERPLATE = (
    r"(?i)(all rights reserved|copyright (\(c\)|©|[0-9])|privacy policy|terms of (use|service)|"
    r"(accept|use[s]?) (all )?cookies|enable javascript|lorem ipsum|licensed under|permission is hereby granted|"
    r"without warranty|subscribe to our|click here)"
)
UNMARKED_WORDS = 40  # a line this long has some sentence mark
BOILERPLATE_WORDS = 40  # a longer line is prose that mentions the phrase
KEEP_PERCENT = 70  # of the words must be left after cleaning


def failing_line(line: Column) -> Column:
    """Whether a rule rejects the line. A line without a word passes: it holds nothing to remove."""

    def rules(n: Column) -> Column:
        symbols = F.regexp_count(line, F.lit(SYMBOLS))
        punctuation = (
            (symbols >= n)
            | (F.regexp_count(line, F.lit("!!")) * 2 >= n)
            | ((n >= UNMARKED_WORDS) & ~line.rlike(SENTENCE_MARKS))
        )
        navigation = (F.regexp_count(line, F.lit(r"[|»›]")) * 3 >= n) | ((n <= 4) & line.rlike(NAVIGATION))
        boilerplate = (n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
        return (n > 0) & (punctuation | navigation | boilerplate)

    return let(F.regexp_count(line, F.lit(WORD)), rules)


def cleaned(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~failing_line(line)), "\n")


PLACE_BITS = 30  # a text has fewer words than 2 ** 30, as its bytes are counted with 31 bits


def repeated_words(tokens: Column, n: Column) -> Column:
    """Words that stand in a 3-word window found twice or more in the text.

    Windows are first sorted as plain numbers, the upper bits of their hash before their place: only those next to
    one with the same bits can be repeated. Windows are told apart by the whole 64-bit hash.
    """

    def window(i: Column) -> Column:
        return F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2))

    def beside_their_like(s: Column, mark: Callable[[Column], Column], place: Callable[[Column], Column]) -> Column:
        def like(e: Column, i: Column) -> Column:
            return F.coalesce(mark(F.get(s, i)) == mark(e), F.lit(False))

        return F.array_compact(F.transform(s, lambda e, i: F.when(like(e, i - 1) | like(e, i + 1), place(e))))

    def exact(places: Column) -> Column:
        hashed = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("at"))))
        return let(hashed, lambda s: beside_their_like(s, lambda e: e["h"], lambda e: e["at"]))

    def covered(starts: Column) -> Column:
        every = F.concat(starts, F.transform(starts, lambda x: x + 1), F.transform(starts, lambda x: x + 2))
        return F.size(F.array_distinct(every))

    low = (1 << PLACE_BITS) - 1
    numbers = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: window(i).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint")),
    )
    near = let(
        F.sort_array(numbers),
        lambda s: beside_their_like(s, lambda e: F.shiftright(e, PLACE_BITS), lambda e: e.bitwiseAND(F.lit(low)).cast("int")),
    )
    return F.when(n >= 3, let(near, lambda places: let(exact(places), covered))).otherwise(F.lit(0))


def judged(text: Column) -> Column:
    """All results of a text as one struct.

    Intermediate results are bound with ``let``, not kept as columns: the optimizer would copy the expressions of
    columns into the functions that run per element.
    """

    def with_clean(n: Column, repeats: Column, clean_text: Column, clean_words: Column, others: list[Column]) -> Column:
        base_failed = (n < 50) | (repeats * 100 > n * 50)
        return F.struct(
            clean_text.alias("clean_text"),
            n.cast("bigint").alias("n_words"),
            *others,
            repeats.cast("bigint").alias("n_repeat_words"),
            clean_words.cast("bigint").alias("n_clean_words"),
            base_failed.alias("base_failed"),
            (~base_failed & (clean_words * 100 >= n * KEEP_PERCENT)).alias("kept"),
        )

    def with_words(tokens: Column, n: Column) -> Column:
        with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
        others = [
            F.length(F.array_join(tokens, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ]
        return let(
            repeated_words(tokens, n),
            lambda repeats: let(
                cleaned(text),
                lambda kept: let(F.regexp_count(kept, F.lit(WORD)), lambda m: with_clean(n, repeats, kept, m, others)),
            ),
        )

    return let(words(text), lambda tokens: let(F.size(tokens), lambda n: with_words(tokens, n)))


def judge_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, the cleaned text, the counts of the base check, ``base_failed`` and ``kept``."""
    return docs.select(F.col(f"`{key}`").alias("_key"), judged(whole(text)).alias("_j")).select(F.col("_key").alias(key), "_j.*")


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents, all columns, their texts as they are."""
    return docs.where(judged(whole(text))["kept"])
