"""Byte-level byte-pair encoding by a segment tree over byte positions, and decoding.

A text is cut into the matches of the vocabulary's pattern; a match that is a token itself is done, every other one
is merged alone. A leaf of its tree stands for a byte position where a token begins and holds the rank of the pair
that begins there, with the position as tie-breaker, so that the root is the leftmost pair of lowest rank. A merge
takes the second token's position out of the list of live positions and sets three leaves: that position, the
merged one and its live neighbour on the left; each update walks up until nothing changes. A match of n bytes
thus takes O(n log n), however long it is. Each distinct match of a stretch of text is merged once, and a worker
remembers a bounded number of matches. Decoding looks every id up and joins the bytes.

Defined results: a null text is an empty one and gives no ids. Texts are encoded whole. Rows are independent, so
repeated rows and ties need no rule; a null doc_id is kept. An empty table gives no rows. Other columns are not
read. The file of ranks is a parameter; every worker reads it from there.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.bpe import _EDGE, PATTERN, _Ragged, _stretches, classes, word_starts
from riskweave.llm.words import _hash_runs, codepoints

KEPT_MATCHES = 400_000  # matches whose ids a worker remembers; they are forgotten all at once
_NONE = 1 << 62


class LowestPair:
    """Segment tree over positions; `top` is the lowest (rank, position) there is, as rank * width + position."""

    def __init__(self, ranks: list[int | None]):
        self.width = 1 << max(0, len(ranks) - 1).bit_length()
        nodes = [_NONE] * (2 * self.width)
        for i, rank in enumerate(ranks):
            if rank is not None:
                nodes[self.width + i] = rank * self.width + i
        for i in range(self.width - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = a if a < b else b
        self.nodes = nodes

    def leftmost(self) -> int | None:
        """Position of the leftmost pair of lowest rank; None if there is no pair left."""
        top = self.nodes[1]
        return None if top == _NONE else top & (self.width - 1)

    def set(self, at: int, rank: int | None) -> None:
        nodes = self.nodes
        i = at + self.width
        nodes[i] = _NONE if rank is None else rank * self.width + at
        while i > 1:
            a, b, i = nodes[i], nodes[i ^ 1], i >> 1
            low = a if a < b else b
            if nodes[i] == low:
                return
            nodes[i] = low


def merge(match: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match of the pattern."""
    whole = ranks.get(match)
    if whole is not None:
        return [whole]
    n, get = len(match), ranks.get
    tree = LowestPair([get(match[i : i + 2]) for i in range(n - 1)])
    after, before = list(range(1, n + 1)), list(range(-1, n))
    while (i := tree.leftmost()) is not None:
        gone = after[i]
        end = after[i] = after[gone]
        before[end] = i
        if gone < n - 1:
            tree.set(gone, None)
        tree.set(i, get(match[i : after[end]]) if end < n else None)
        if i:
            left = before[i]
            tree.set(left, get(match[left:end]))
    out, i = [], 0
    while i < n:
        out.append(ranks[match[i : after[i]]])
        i = after[i]
    return out


class TreeCodec:
    """Encoder and decoder of one file of ranks (a token in base64 and its rank per line)."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.decimal, self.plain = _Ragged(np.uint8), _Ragged(np.uint8)
        for table, row in ((self.decimal, lambda i: b"%d," % i), (self.plain, lambda i: self.token.get(i, b""))):
            rows = [row(i) for i in range(max(self.token) + 1)]
            table.add(np.frombuffer(b"".join(rows), np.uint8), np.asarray([len(x) for x in rows], np.int64))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = _Ragged(np.int64)

    def _rows_of(self, joined: str, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The row of `ids` for each match; new ones are merged."""
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > KEPT_MATCHES:
            self._forget()
        keys = distinct.tolist()
        rows = list(map(self.known.get, keys))
        new = [i for i, x in enumerate(rows) if x is None]
        if new:
            at, flat, sizes, row = first[new], [], [], len(self.ids.size)
            for i, s, e in zip(new, start[at].tolist(), end[at].tolist()):
                ids = merge(joined[s:e].encode("utf-8", "surrogatepass"), self.ranks)
                flat += ids
                sizes.append(len(ids))
                self.known[keys[i]] = rows[i] = row
                row += 1
            self.ids.add(np.asarray(flat, np.int64), np.asarray(sizes, np.int64))
        return np.asarray(rows, np.int64)[which]

    def encode_texts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
        """For each text: its ids, the same in decimal joined by commas, and the bytes they decode to.

        Matches are told apart by a 64-bit hash. Every byte is a token, so ids decode to what was encoded; a text
        that does not come back has met a hash collision and is encoded alone with nothing remembered.
        """
        for group in _stretches(texts):
            joined = "".join([f"{text}\0" for text in group])
            codes = codepoints(joined)
            edge = np.cumsum([len(text) + 1 for text in group]) - 1
            kind = classes()[codes]
            kind[edge] = _EDGE
            start = word_starts(codes, kind)
            end = np.append(start[1:], len(codes))
            match = kind[start] != _EDGE
            start, end = start[match], end[match]
            rows = self._rows_of(joined, start, end, _hash_runs(codes, start, end)) if len(start) else np.zeros(0, np.int64)
            ids, upto = self.ids.rows(rows)
            matches = np.searchsorted(start, edge)  # matches before the end of each text
            upto = np.concatenate(([0], upto))[matches]
            number, number_end = self.decimal.rows(ids)
            plain, plain_end = self.plain.rows(ids)
            number, plain = number.tobytes(), plain.tobytes()
            number_end, plain_end = np.concatenate(([0], number_end)), np.concatenate(([0], plain_end))
            lo = 0
            for text, hi in zip(group, upto.tolist()):
                back = plain[plain_end[lo] : plain_end[hi]]
                if back == text.encode("utf-8", "surrogatepass"):
                    yield ids[lo:hi], number[number_end[lo] : max(number_end[lo], number_end[hi] - 1)], back
                else:
                    yield self._alone(text)
                lo = hi

    def _alone(self, text: str) -> tuple[np.ndarray, bytes, bytes]:
        ids = [i for m in regex.findall(PATTERN, text) for i in merge(m.encode("utf-8", "surrogatepass"), self.ranks)]
        return np.asarray(ids, np.int64), ",".join(map(str, ids)).encode(), self.decode(ids)

    def encode(self, text: str) -> list[int]:
        (ids, _, _), = self.encode_texts([text])
        return ids.tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


@lru_cache(maxsize=2)
def codec(path: str) -> TreeCodec:
    """The codec of a file, read once per worker."""
    return TreeCodec(path)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of `docs` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = [(len(ids), sha256(decimal).hexdigest(), sha256(back).hexdigest())
                    for ids, decimal, back in own.encode_texts(batch.column("text").to_pylist())]
            count, ids_digest, text_digest = zip(*rows) if rows else ((), (), ())
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
    """(doc_id, bytes) of every row of `tokens` (doc_id, ids); null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            found = [None if x is None else own.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "bytes"])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, bytes binary")
