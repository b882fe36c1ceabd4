"""Vectorised word splitting and hashing shared by the text operators.

A word is a longest run of letters, digits and combining marks of the lower-cased text. Every word gets a
64-bit hash of its code points; operators work on these integers instead of string objects.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np

PIECE = 1 << 19  # code points handled at once; longer texts are cut between words
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BREAK = re.compile(r"[\s!-/:-@\[-`{-~]")


@cache
def word_chars() -> np.ndarray:
    """For each code point, whether it belongs to a word."""
    table = np.zeros(0x110000, bool)
    for code in range(0x110000):
        c = chr(code)
        table[code] = c.isalnum() or unicodedata.category(c)[0] == "M"
    return table


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter or a combining mark."""
    table = np.zeros(0x110000, bool)
    for code in range(0x110000):
        c = chr(code)
        table[code] = c.isalpha() or unicodedata.category(c)[0] == "M"
    return table


@cache
def marks() -> np.ndarray:
    """For each code point, whether it is a combining mark that is no letter by itself."""
    table = np.zeros(0x110000, bool)
    for code in np.flatnonzero(letters()).tolist():
        table[code] = not chr(code).isalpha()
    return table


@cache
def token_kinds() -> np.ndarray:
    """For each code point: 0 white space, 1 word, 2 any other mark."""
    table = np.where(word_chars(), 1, 2).astype(np.int8)
    table[[code for code in range(0x110000) if chr(code).isspace()]] = 0
    return table


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)
    return powers(_BASE), powers(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def _tokens(codes: np.ndarray, marks: bool) -> tuple[np.ndarray, np.ndarray]:
    if not marks:
        return spans(word_chars()[codes])
    kind = token_kinds()[codes]
    start = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1]))) if len(kind) else np.zeros(0, np.int64)
    end = np.append(start[1:], len(kind))[: len(start)]
    kept = kind[start] > 0
    return start[kept], end[kept]


def _hash_runs(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = 1 << max(16, int(len(codes) - 1).bit_length())
    power, inverse = _powers(size)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])


def _cut(text: str) -> Iterator[str]:
    """Pieces of a long text, cut only between words."""
    at = 0
    while at < len(text):
        found = _BREAK.search(text, min(len(text), at + PIECE))
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end


def hash_words(texts: Iterable[str | None], marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the offsets of each text's words (one more than texts).

    A null text has no words. With `marks`, runs of other characters than white space count as words too.
    """
    hashes: list[np.ndarray] = []
    counts: list[int] = []
    group: list[str] = []
    size = 0

    def flush() -> None:
        nonlocal group, size
        if not group:
            return
        codes = codepoints("\n".join(group))
        start, end = _tokens(codes, marks)
        hashes.append(_hash_runs(codes, start, end))
        limits = np.cumsum([len(x) + 1 for x in group])
        counts.extend(np.diff(np.searchsorted(start, limits), prepend=0).tolist())
        group, size = [], 0

    for text in texts:
        low = "" if text is None else text.lower()
        if len(low) > PIECE:
            flush()
            n = 0
            for piece in _cut(low):
                codes = codepoints(piece)
                start, end = _tokens(codes, marks)
                hashes.append(_hash_runs(codes, start, end))
                n += len(start)
            counts.append(n)
            continue
        group.append(low)
        size += len(low) + 1
        if size > PIECE:
            flush()
    flush()
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.asarray(counts, np.int64), out=offsets[1:])
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), offsets


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values (len - n + 1 of them)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:size].copy()
    for k in range(1, n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + size]
    return mix(total)
