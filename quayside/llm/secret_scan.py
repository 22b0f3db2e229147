"""Secrets: three fixed patterns, and strings that dictionary-primed compression finds new.

A candidate is a run of key-like characters of more than one class, or a longer one of a single class. It matters only in a sensitive
context: a word such as key, token or password shortly before it, or in its own run where that is NAME=VALUE, of which
the value alone is the candidate. A run that follows another with nothing but blanks, line breaks, dots, commas, quotes
or backslashes between shares its context, so the lines of a key and the parts of a token stand together. Its novelty is what it adds to a compressed frame:
the bytes of zstandard for the text around it with the candidate, less those without it, primed with a dictionary of
identifiers; it must be new as written and in lower case. Prose, identifiers and repeated values add little; a secret adds most of its own length. The dictionary
is a fixed list of identifiers common in code, followed by those most frequent in the corpus' own sensitive contexts.

Scale. Texts are read once: a task finds patterns and candidates with the text around them, which is all that is kept.
Identifiers are counted by key, and the few most frequent ones (as many as a dictionary holds) go to every task.

Results for odd input: a null or empty text has no spans. Repeated rows and null keys are scanned each for itself.
A very long text is scanned whole; the memory for its candidates is in proportion to it. An empty table gives an
empty one. Other columns are ignored by ``scan`` and returned untouched by ``redact``, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.words import whole
from quayside.session import stage

# The base patterns, as (kind, pattern, group that must be long enough, its least length).
BASE = (
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
PATTERNS = tuple((kind, re.compile(p, re.ASCII), group, least) for kind, p, group, least in BASE)
KINDS = (*(kind for kind, *_ in BASE), "novel")
# Texts without one of these can't hold the kind; looking for them is much faster than the pattern.
HINTS = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",)}
HEX_RUN = re.compile(r"[0-9a-f]{24}", re.ASCII)

LEAST = 16  # characters of a candidate
LEAST_PLAIN = 20  # of one that holds a single class
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}", re.ASCII)
END = "-----END"  # what a key of several lines ends with; the line before it may be short
TAIL = re.compile(r"(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_=-]{1,15})[\s.,'\"`\\]+n?\Z", re.ASCII)
JOINED = re.compile(r"[\s.,'\"`\\]*", re.ASCII)
PIECE = re.compile(r"[^=]+(?:=+\Z|==+)?")  # of a run cut where a single = assigns; what pads a value stays with it
# Short words only where a word or a hump of one begins, and none goes on: author, capital and accessory are no context.
SENSITIVE = re.compile(
    r"(?i:pass(?:word|wd|phrase)|secret|token|credential|private|signature|bearer|authoriz|authentic|key\b)"
    r"|(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?i:auth|api|access)(?![a-z])",
    re.ASCII,
)
SENSITIVE_HINTS = ("pass", "secret", "token", "credential", "private", "signature", "bearer", "auth", "api", "access", "key")
# Identifiers common in code and configuration, so that they are never news.
IDENTIFIERS = (
    "access account address api_key apikey array attribute auth authorization base64 bearer boolean bucket cache "
    "certificate class client client_id client_secret collection column config configuration connection constant "
    "container content context cookie counter create credentials data database debug default delete description "
    "directory document element email enable endpoint environment error example exception export expires false field "
    "file filename filter float format function global handler hash header headers host hostname https identifier "
    "import index input instance integer interface internal item json key length license list local localhost login "
    "manager message method model module name namespace network node null number object option options output package "
    "parameter parse passwd password path port prefix private private_key process production profile project property "
    "protected provider public public_key query queue read record reference region register release remote request "
    "resource response result return role root schema secret secret_key self server service session setting settings "
    "signature size source static status storage string super system table target template test text this thread "
    "timeout timestamp token true type undefined update upload user username value variable version void width write"
)
AROUND = 120  # characters of context on either side
BEFORE = 48  # how far before a candidate's run the sensitive word may stand
LONGEST_WORD = 10  # characters of a sensitive word
DICTIONARY_WORDS = 4096  # identifiers of the corpus that the dictionary takes
NOVEL_SHARE = 0.65  # of a candidate's own length that it must add
FOLDED_SHARE = 0.55  # the same in lower case, in which names in capitals or humps are the words they are made of

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost matches per kind, none overlapping another of its kind; matches that are too short are dropped."""
    low, spans = text.lower(), []
    for kind, pattern, group, least in PATTERNS:
        if kind in HINTS and not any(hint in low for hint in HINTS[kind]) or kind == "hex" and not HEX_RUN.search(text):
            continue
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                spans.append((kind, m.start(), m.end()))
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def values(text: str) -> list[tuple[int, int, int]]:
    """Start and end of key-like values, and where the run of each begins; a run of short pieces is a value as it is."""
    found = []
    for m in CANDIDATE.finditer(text):
        at = m.start()
        parts = [(at + p.start(), at + p.end(), at) for p in PIECE.finditer(m[0]) if len(p[0]) >= LEAST]
        found += parts or [(at, m.end(), at)]
    at = text.find(END)
    while at >= 0:
        tail = TAIL.search(text, max(0, at - AROUND), at)
        if tail:
            found.append((*tail.span(1), tail.start(1)))
        at = text.find(END, at + len(END))
    return sorted(found)


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int, str, str, str]]:
    """Start, end, text before, text after and text near of key-like values in a sensitive context, apart from base spans.

    The text near is that before and after without base spans and the other values of the same secret.
    """
    low = text.lower()
    if not any(hint in low for hint in SENSITIVE_HINTS):
        return []
    assigned = sorted(e for kind, _, e in taken if kind == "assign")
    cover = joined_spans(taken)
    starts = [s for s, _ in cover]
    found, last_run, sensitive, searched, last, chain = [], -1, False, 0, -1, 0
    for start, end, run in values(text):
        if run != last_run:
            last_run, sensitive, searched = run, False, max(0, run - BEFORE)
        sensitive = sensitive or bool(SENSITIVE.search(text, searched, start))
        searched = max(searched, start - LONGEST_WORD)
        classes = sum(bool(re.search(c, text[start:end])) for c in ("[a-z]", "[A-Z]", "[0-9]"))
        k = bisect_right(assigned, start)
        follows = last >= 0 and bool(JOINED.fullmatch(text, last, start))
        joined = follows or k > 0 and bool(JOINED.fullmatch(text, assigned[k - 1], start))
        enough = classes > 1 or classes == 1 and end - start >= LEAST_PLAIN or joined and end - start < LEAST
        if not enough or not (sensitive or joined):
            continue
        last, chain = end, chain + (not follows)
        begun = bisect_left(starts, end)
        if begun and cover[begun - 1][1] > start:
            continue
        found.append((start, end, chain, classes))
    out = []
    for k, (start, end, _, _) in enumerate(found):
        low, high = max(0, start - AROUND), min(len(text), end + AROUND)
        fixed = cover[max(bisect_right(starts, low) - 1, 0) : bisect_left(starts, high)]
        out.append((start, end, text[low:start], text[end:high], without(text, low, high, fixed + key_material(found, k, low, high))))
    return out


def joined_spans(spans: list[Span]) -> list[tuple[int, int]]:
    """The stretches that spans cover, in order and apart."""
    cover: list[tuple[int, int]] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if cover and start <= cover[-1][1]:
            start, end = cover[-1][0], max(end, cover.pop()[1])
        cover.append((start, end))
    return cover


def key_material(found: list[tuple[int, int, int, int]], k: int, low: int, high: int) -> list[tuple[int, int]]:
    """Candidate ``k`` and those of its chain between ``low`` and ``high`` that hold all classes or are short."""
    chain, first, spans = found[k][2], k, []
    while first and found[first - 1][2] == chain and found[first - 1][1] > low:
        first -= 1
    for other in range(first, len(found)):
        start, end, its, classes = found[other]
        if its != chain or start >= high:
            break
        if other == k or classes == 3 or end - start < LEAST:
            spans.append((start, end))
    return spans


def without(text: str, low: int, high: int, spans: list[tuple[int, int]]) -> str:
    """``text[low:high]`` with the spans cut out."""
    parts, at = [], low
    for start, end in sorted(spans):
        parts.append(text[at : max(at, start)])
        at = max(at, end)
    return " ".join([*parts, text[at : max(at, high)]])


def compressor(identifiers: list[str]) -> zstandard.ZstdCompressor:
    """Primed with the identifiers; the last ones are the cheapest to refer to."""
    body = " ".join([*reversed(identifiers), IDENTIFIERS]).lower().encode()
    dictionary = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=dictionary, write_content_size=False, write_checksum=False)


def novelty(value: str, before: str, after: str, frame: zstandard.ZstdCompressor) -> float:
    """Compressed bytes the value adds to the text around it, as a share of its length."""
    with_it = len(frame.compress((before + value + after).encode()))
    return (with_it - len(frame.compress((before + after).encode()))) / len(value.encode())


def is_novel(value: str, before: str, after: str, frame: zstandard.ZstdCompressor) -> bool:
    """Whether the value adds enough as it is written, and in lower case too."""
    if novelty(value, before, after, frame) < NOVEL_SHARE:
        return False
    return novelty(value.lower(), before.lower(), after.lower(), frame) >= FOLDED_SHARE


def found_in(docs: DataFrame, text: str, **keys) -> DataFrame:
    """Per row: ``keys``, the base spans and the candidates."""
    names = list(keys)
    chosen = docs.select(*[c.alias(name) for name, c in keys.items()], whole(text).alias("_text"))
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    news = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("before", pa.string()), ("after", pa.string()), ("near", pa.string())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, new = [], []
            for body in batch.column("_text"):
                body = body.as_py()
                own = base_spans(body)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in own])
                new.append(
                    [
                        {"start": s, "end": e, "value": body[s:e], "before": x, "after": y, "near": z}
                        for s, e, x, y, z in candidates(body, own)
                    ]
                )
            columns = [*[batch.column(name) for name in names], pa.array(base, spans), pa.array(new, news)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "base", "candidates"])

    kept = "".join(f"{name} {kind}, " for name, kind in chosen.dtypes[:-1])
    return chosen.mapInArrow(
        run,
        f"{kept}base array<struct<kind string, start bigint, end bigint>>, "
        "candidates array<struct<start bigint, end bigint, value string, before string, after string, near string>>",
    )


def corpus_identifiers(found: DataFrame) -> list[str]:
    """The identifiers most frequent around candidates, most frequent first."""
    around = found.select(F.explode("candidates.near").alias("near"))
    names = around.select(F.explode(F.regexp_extract_all("near", F.lit("([A-Za-z_][A-Za-z_.]{2,31})"), 1)).alias("name"))
    ranked = names.select(F.lower("name").alias("name")).groupBy("name").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "name")
    return [row.name for row in ranked.limit(DICTIONARY_WORDS).collect()]  # the dictionary's size


def judged(found: DataFrame, keys: list[str], identifiers: list[str]) -> DataFrame:
    """Adds ``spans``: base spans and novel candidates in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = compressor(identifiers)
        for batch in batches:
            base, every, digests = [], [], []
            counts = {kind: [] for kind, *_ in BASE}
            for own, new in zip(batch.column("base").to_pylist(), batch.column("candidates").to_pylist()):
                own = [(s["kind"], s["start"], s["end"]) for s in own]
                novel = [
                    ("novel", c["start"], c["end"])
                    for c in new
                    if is_novel(c["value"], c["before"], c["after"], frame)
                ]
                base.append(listed(own))
                digests.append(hashlib.sha256(base[-1].encode()).hexdigest())
                every.append(listed(in_order(own + novel)))
                for kind, tally in counts.items():
                    tally.append(sum(k == kind for k, _, _ in own))
            tallies = [pa.array(t, pa.int64()) for t in counts.values()]
            columns = [*[batch.column(name) for name in keys], *tallies, pa.array(digests), pa.array(every)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, *[f"n_{k}" for k in counts], "base_sha256", "spans"])

    kinds = dict(found.dtypes)
    kept = ", ".join(f"{name} {kinds[name]}" for name in keys)
    return found.mapInArrow(run, f"{kept}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_assign, n_access, n_hex``, ``base_sha256`` and ``spans`` (``kind:start:end``, comma-joined)."""
    found = stage(found_in(docs, text, key=F.col(f"`{key}`")), "secret-candidates")
    return judged(found, ["key"], corpus_identifiers(found)).withColumnRenamed("key", key)


def hidden(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with every stretch covered by spans replaced by one mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by ``mark``; texts without any, and nulls, stay as they are.

    The dictionary comes from a first reading of the texts; the second finds, judges and replaces row by row, so
    that no text is shuffled.
    """
    identifiers = corpus_identifiers(stage(found_in(docs, text), "secret-candidates"))
    at, columns = docs.columns.index(text), docs.columns
    numbered = docs.toDF(*[f"c{k}" for k in range(len(columns))])  # clashing names can't matter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = compressor(identifiers)

        def clean(body: str | None) -> str | None:
            own = base_spans(body or "")
            new = [(s, e) for s, e, x, y, _ in candidates(body or "", own) if is_novel(body[s:e], x, y, frame)]
            spans = [(s, e) for _, s, e in own] + new
            return hidden(body, spans, mark) if spans else body

        for batch in batches:
            texts = pa.array([clean(x.as_py()) for x in batch.column(at)], pa.string())
            yield batch.set_column(at, batch.schema.field(at), texts.cast(batch.schema.field(at).type))

    return numbered.mapInArrow(run, numbered.schema).toDF(*columns)
