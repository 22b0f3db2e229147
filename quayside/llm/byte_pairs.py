"""How a byte-level BPE file of the tokenizers library cuts text, as far as the operators here share it.

Text is cut at added special tokens, then into pieces by the library's byte-level rule, and each piece is merged by
itself. Most blanks in prose are single spaces or line breaks between words; there a piece never spans the blank,
so a text is a list of chunks (a word with the blank before it) whose results can be remembered. Chunks repeat, so
remembering them makes most of a text one dictionary lookup per word.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

from tokenizers import Tokenizer

# Fixed values of byte-level BPE: the printable bytes stand for themselves, the others for code points from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# The rule's letters, digits and the rest, spelled out for a range of characters whose classes never change.
LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
OUTSIDE = re.compile("[^\x00-\x1b\x20-ɏ‐-‧€]")
PIECE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+"
)
OTHER_BLANK = re.compile(r"[^\S \n]")
REMEMBERED = 300_000  # chunks a worker keeps at most (about 60 MB); beyond, it starts anew
LONGEST_REMEMBERED = 48  # characters of a chunk


def byte_alphabet() -> dict[int, str]:
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {b: chr(b) for b in PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(others)}


ALPHABET = byte_alphabet()


def spelled(piece: str) -> str:
    """The piece's UTF-8 bytes in the alphabet of the vocabulary."""
    return piece.encode().decode("latin-1").translate(ALPHABET)


def vocabulary(path: str) -> dict:
    """The file's content, which is large and not kept."""
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(maxsize=4)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def special_tokens(path: str) -> tuple[dict[str, int], re.Pattern | None]:
    ids = {t["content"]: t["id"] for t in vocabulary(path)["added_tokens"]}
    longest_first = sorted(ids, key=len, reverse=True)
    return ids, re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if ids else None


def pieces(text: str, path: str) -> list[str]:
    """The pieces of a text without special tokens, spelled in the vocabulary's alphabet."""
    if OUTSIDE.search(text):
        return [p for p, _ in library(path).pre_tokenizer.pre_tokenize_str(text)]
    return [spelled(p) for p in PIECE.findall(text)]


def chunk_pieces(chunk: str, path: str) -> list[str]:
    """The pieces of one chunk of ``chunks``; one that doesn't begin with a line break follows a space."""
    if chunk.isascii() and chunk.isalpha():
        return ["Ġ" + chunk]
    return pieces(chunk if chunk[0] == "\n" else " " + chunk, path)


def even(text: str) -> bool:
    """Whether the text has no other blanks than the chunks can show."""
    ends = text[:1].isspace() or text[-1:].isspace()
    if ends or "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text:
        return False
    return OTHER_BLANK.search(text) is None


def chunks(text: str) -> tuple[str, list[str]] | None:
    """The first word and the chunks after it, or None if the text has other blanks than the chunks can show."""
    if not even(text):
        return None
    first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


def has_special(text: str, path: str) -> bool:
    return any(s in text for s in special_tokens(path)[0])


def segments(text: str, path: str) -> list[str | int]:
    """Text between special tokens, and the ids of those."""
    ids, pattern = special_tokens(path)
    if pattern is None or not has_special(text, path):
        return [text] if text else []
    return [ids.get(s, s) for s in pattern.split(text) if s]
