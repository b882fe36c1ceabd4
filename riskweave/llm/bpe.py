"""Byte-pair encoding in batched merge rounds, and decoding.

Texts are cut at the special tokens and then into words by the vocabulary's pattern. The symbols of many words
lie in one flat array. In each round the key of every adjacent pair is looked up by binary search in the sorted
pair keys, each word takes its pair of lowest rank, and all its non-overlapping occurrences from the left are
merged; words without a known pair leave the array. Each distinct word of a stretch of text is merged once.
Decoding looks every id up, joins the bytes and replaces what is not UTF-8.

Defined results: a null text is an empty one and gives no ids. Texts are encoded whole. Rows are independent, so
repeated rows and ties need no rule; a null doc_id is kept. Other columns are not read. The vocabulary file's
path is a parameter; every worker reads it from there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache, lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.words import _hash_runs, codepoints

# Fixed value: the pattern that byte-level vocabularies of this kind split words with. `word_starts` finds the
# same words for whole arrays of code points.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER, _LETTER, _NUMBER, _SPACE, _EDGE = range(5)
KEPT_WORDS = 400_000  # words whose ids a worker remembers; they are forgotten all at once
STRETCH = 1 << 19  # code points of text whose new words are merged together


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def classes() -> np.ndarray:
    """The class of every code point as the pattern sees it."""
    every = "".join(map(chr, range(0x110000)))
    table = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            table[found.start() : found.end()] = kind
    return table


def word_starts(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the pattern's words begin; the last place of `kind` must be an edge, and edges are words too.

    A word is a run of one class. It takes a blank right before it along; other white space is a word of its
    own, without its last character where a word follows. An apostrophe that no blank precedes takes one of
    the fixed endings along.
    """
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    first = np.concatenate(([0], change))
    starts = np.zeros(len(kind), bool)
    starts[first] = True
    starts[kind == _EDGE] = True
    # White space before a word: its last character starts anew.
    space_end = change[(kind[change - 1] == _SPACE) & (kind[change] != _EDGE)]
    starts[space_end - 1] = True
    joined = space_end[codes[space_end - 1] == 32]
    starts[joined] = False
    # Apostrophe and ending: the apostrophe alone in its run, no blank joined to it.
    mark = np.flatnonzero((codes[:-1] == 39) & starts[:-1] & (kind[1:] == _LETTER) & (kind[:-1] == _OTHER))
    if len(mark):
        a, b = codes[mark + 1], codes[np.minimum(mark + 2, len(codes) - 1)]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        two &= kind[np.minimum(mark + 2, len(codes) - 1)] == _LETTER
        size = np.where(one, 1, np.where(two, 2, 0))
        mark, size = mark[size > 0], size[size > 0]
        starts[mark + 1] = False
        after = mark + 1 + size
        starts[after[kind[after] == _LETTER]] = True
    return np.flatnonzero(starts)


class _Ragged:
    """Rows of different lengths in one flat array."""

    def __init__(self, dtype):
        self.flat, self.start, self.size = np.zeros(0, dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.flat = np.concatenate((self.flat, flat))

    def rows(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the wanted rows one after the other, the end of each)."""
        size = self.size[wanted]
        end = np.cumsum(size)
        place = np.arange(int(end[-1]) if len(end) else 0)
        place += np.repeat(self.start[wanted] - (end - size), size)
        return self.flat[place], end


class Codec:
    """Encoder and decoder of one vocabulary file (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        vocabulary, letters = given["model"]["vocab"], _byte_letters()
        self.special = {x["content"]: x["id"] for x in given["added_tokens"]}
        self.token = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if all(c in letters for c in t)}
        self.token |= {i: t.encode() for t, i in self.special.items()}
        self.first = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.first[b] = vocabulary[letter]
        self.size = max(vocabulary.values()) + 1
        left, right, merged = [], [], []
        for a, b in given["model"]["merges"]:
            left.append(vocabulary[a])
            right.append(vocabulary[b])
            merged.append(vocabulary[a + b])
        keys = np.asarray(left, np.int64) * self.size + np.asarray(right, np.int64)
        order = np.argsort(keys, kind="stable")
        # Sorted pair keys with the rank of each; what the pair of a rank becomes.
        self.keys, self.rank, self.product = keys[order], order, np.asarray(merged, np.int64)
        self.cuts = regex.compile("|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.decimal, self.plain = _Ragged(np.uint8), _Ragged(np.uint8)
        most = max(self.token)
        for table, row in ((self.decimal, lambda i: b"%d," % i), (self.plain, lambda i: self.token.get(i, b""))):
            rows = [row(i) for i in range(most + 1)]
            table.add(np.frombuffer(b"".join(rows), np.uint8), np.asarray([len(x) for x in rows], np.int64))
        self._forget()

    def _ranks(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pairs that begin at places `at`; those without one, or across words, get the end rank."""
        none = len(self.keys)
        following = np.minimum(at + 1, len(symbol) - 1)
        key = symbol[at] * self.size + symbol[following]
        found = np.minimum(np.searchsorted(self.keys, key), none - 1)
        good = (self.keys[found] == key) & (word[following] == word[at]) & (following > at)
        return np.where(good, self.rank[found], none)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each word)."""
        sizes = np.asarray([len(w) for w in words], np.int64)
        symbol = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_words, none = [], [], len(self.keys)
        # Rank of the pair that begins at each place; only pairs beside a merged symbol change.
        rank = self._ranks(symbol, word, np.arange(len(symbol))) if none else np.zeros(len(symbol), np.int64)
        while len(symbol):
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, start)
            lowest = np.repeat(best, np.diff(start, append=len(symbol)))
            ended = lowest == none
            if ended.any():
                done_ids.append(symbol[ended])
                done_words.append(word[ended])
                going = ~ended
                symbol, word, rank, lowest = symbol[going], word[going], rank[going], lowest[going]
                if not len(symbol):
                    break
            chosen = np.flatnonzero(rank == lowest)
            # In a run of overlapping occurrences (a a a) every second one merges, from the left.
            place = np.arange(len(chosen))
            opens = np.concatenate(([True], chosen[1:] != chosen[:-1] + 1))
            chosen = chosen[(place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0]
            symbol[chosen] = self.product[rank[chosen]]
            left = np.ones(len(symbol), bool)
            left[chosen + 1] = False
            at = chosen - np.arange(len(chosen))  # every merge before a place has taken one symbol away
            symbol, word, rank = symbol[left], word[left], rank[left]
            changed = np.concatenate((at, at[at > 0] - 1))
            rank[changed] = self._ranks(symbol, word, changed)
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        every, owner = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(owner, kind="stable")
        return every[order], np.bincount(owner, minlength=len(words))

    def _forget(self) -> None:
        """Known words by hash, and their ids; the first rows are the special tokens."""
        self.known: dict[int, int] = {}
        self.ids = _Ragged(np.int64)
        every = np.asarray(list(self.special.values()), np.int64)
        self.ids.add(every, np.ones(len(every), np.int64))

    def _rows_of(self, joined: str, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The row of `ids` for each word; new words are merged together."""
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > KEPT_WORDS:
            self._forget()
        keys = distinct.tolist()
        found = list(map(self.known.get, keys))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            at = first[new]
            words = [joined[s:e].encode("utf-8", "surrogatepass") for s, e in zip(start[at].tolist(), end[at].tolist())]
            ids, size = self.merge(words)
            row = len(self.ids.size)
            self.ids.add(ids, size)
            for i in new:
                self.known[keys[i]] = found[i] = row
                row += 1
        return np.asarray(found, np.int64)[which]

    def _encode_pieces(self, pieces: list[tuple[str, bool]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, end of each piece's ids). Pieces are cut at special tokens, which are pieces too."""
        joined = "".join([f"{'' if special else text}\0" for text, special in pieces])
        codes = codepoints(joined)
        edge = np.cumsum([1 if special else len(text) + 1 for text, special in pieces]) - 1
        kind = classes()[codes]
        kind[edge] = _EDGE
        start = word_starts(codes, kind)
        end = np.append(start[1:], len(codes))
        words = kind[start] != _EDGE
        row = np.full(len(start), -1, np.int64)
        if words.any():
            s, e = start[words], end[words]
            row[words] = self._rows_of(joined, s, e, _hash_runs(codes, s, e))
        order = {x: i for i, x in enumerate(self.special)}
        mark = np.flatnonzero(~words)
        row[mark] = [order[text] if special else -1 for text, special in pieces]
        ends = np.zeros(len(pieces), np.int64)
        kept = row >= 0
        ids, id_end = self.ids.rows(row[kept])
        upto = np.cumsum(kept)[mark]
        ends[upto > 0] = id_end[upto[upto > 0] - 1]
        return ids, ends

    def encode_texts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
        """For each text: its ids, the same in decimal joined by commas, and the bytes they decode to.

        Words are told apart by a 64-bit hash. As every vocabulary of this kind decodes to what was encoded, a
        text that does not come back has met a hash collision and is encoded alone with nothing remembered.
        """
        for group in _stretches(texts):
            cut = [self._pieces(t) or [("", False)] for t in group]
            ids, ends = self._encode_pieces([p for pieces in cut for p in pieces])
            ends = ends[np.cumsum([len(x) for x in cut]) - 1]
            number, number_end = self.decimal.rows(ids)
            plain, plain_end = self.plain.rows(ids)
            number, plain = number.tobytes(), plain.tobytes()
            lo = at_number = at_plain = 0
            for text, hi in zip(group, ends.tolist()):
                end_number = int(number_end[hi - 1]) if hi else 0
                end_plain = int(plain_end[hi - 1]) if hi else 0
                back = plain[at_plain:end_plain]
                if back == text.encode("utf-8", "surrogatepass"):
                    yield ids[lo:hi], number[at_number : max(at_number, end_number - 1)], back
                else:
                    yield self._alone(text)
                lo, at_number, at_plain = hi, end_number, end_plain

    def _alone(self, text: str) -> tuple[np.ndarray, bytes, bytes]:
        ids: list[int] = []
        for piece, special in self._pieces(text):
            if special:
                ids.append(self.special[piece])
            else:
                ids += self.merge([w.encode("utf-8", "surrogatepass") for w in regex.findall(PATTERN, piece)])[0].tolist()
        return np.asarray(ids, np.int64), ",".join(map(str, ids)).encode(), b"".join([self.token[i] for i in ids])

    def _pieces(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special tokens: (piece, whether it is one)."""
        if self.cuts is None:
            return [(text, False)] if text else []
        out, at = [], 0
        for found in self.cuts.finditer(text):
            if found.start() > at:
                out.append((text[at : found.start()], False))
            out.append((found[0], True))
            at = found.end()
        if at < len(text):
            out.append((text[at:], False))
        return out

    def encode(self, text: str) -> list[int]:
        (ids, _, _), = self.encode_texts([text])
        return ids.tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.token[i] for i in ids]).decode("utf-8", "replace")


def _stretches(texts: list[str | None]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size > STRETCH:
            yield group
            group, size = [], 0
    if group:
        yield group


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a file, read once per worker."""
    return Codec(path)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of `docs` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            count, ids_digest, text_digest = [], [], []
            for ids, decimal, decoded in own.encode_texts(batch.column("text").to_pylist()):
                count.append(len(ids))
                ids_digest.append(sha256(decimal).hexdigest())
                text_digest.append(sha256(decoded.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids_digest, pa.string()),
                 pa.array(text_digest, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of `docs` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                ids = [x for x, _, _ in own.encode_texts(part.column("text").to_pylist())]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of every row of `tokens` (doc_id, ids); null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [None if x is None else own.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
