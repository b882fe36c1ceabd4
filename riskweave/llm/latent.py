"""Benchmark leaks in documents by latent semantic retrieval.

Every document is written once as the sequence of benchmark word numbers (0: a word that no item has). Its
passages of 32 words are TF-IDF rows over those words; a randomised SVD of all passages of all documents gives
a latent space (two passes of sums by word, added up in Spark). Windows of the documents and items are compared by
cosine in that space, scaled by the singular values:

* an item of 12 to 64 words with all windows of 32 words, 16 apart;
* a longer one in parts of about 48 words, each of which may find its place, as one window is little of the whole;
* a shorter one with windows of its own size, since it is little of a long one. They lie where one of its rarest words
  stands in its place; so many of these are tried that a text with 60 % of the item holds one of them.

A near enough pair is confirmed by the longest common subsequence of the whole item and the words around the window (60 %
of the item), and by the same for the item's answer, its closing sentence (50 %). Paraphrases that keep most words in
order are thus found.

Words in over a tenth of the passages carry no weight, unless an item has fewer than four others. The items are
the stated query set: distinct texts are dealt by hash to blocks of about 5000, each with its own space, so that nothing
held in a task grows with the documents or the item count.

Defined results: null and wordless texts match nothing; an item under five words is no evidence and matches
nothing; items with a null id or text are left out. Repeated items and rows are each reported. With no
documents or no items the result is empty. Further columns of either table are ignored. text_md5 tells rows of one
doc_id apart.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.align import common_subsequence
from riskweave.llm.words import hash_words
from riskweave.session import scratch_path

BLOCK_ITEMS = 5_000
PASSAGE = 32
STRIDE = 16
RANK = 64
SPARE = 8  # further random directions of the range finder
COMMON = 0.1
COSINE = 0.45
MATCHED = 0.6
ANSWERED = 0.5
SHORTEST = 5
SHORT = 12  # items below this many words are compared with windows of their own size
PART = 48  # words of a part of an item of more than two passages
CACHED = 16_384  # words whose vectors are handled at once: small enough for a processor's cache
SLICE = 256  # words per message of partial sums
LANES = 64
_CODED = "doc_id long, text_md5 string, numbers binary"
_MATCHES = "doc_id long, text_md5 string, key string, cosine double, matched double, answered double, first_word long"


class _Items:
    """A block of benchmark texts as word numbers."""

    def __init__(self, keys: list[str], texts: list[str]):
        self.keys = keys
        hashes, offsets = hash_words(texts)
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes).astype(np.int64) + 1
        self.words = [numbers[s:e] for s, e in zip(offsets, offsets[1:])]
        self.answers = [w[-n:] if n else w for w, n in zip(self.words, map(_answer_size, texts))]

    def parts(self) -> tuple[list[int], list[np.ndarray]]:
        """(item, words) of what is compared with windows of a passage's size."""
        cut = [(i, part) for i, w in enumerate(self.words) if len(w) >= SHORT
               for part in np.array_split(w, 1 if len(w) <= 2 * PASSAGE else -(-len(w) // PART))]
        return [i for i, _ in cut], [part for _, part in cut]

    def anchors(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first entry of each word, item, place of the word in it): the rarest words of short items."""
        word, item, place = [], [], []
        for i, w in enumerate(self.words):
            if SHORTEST <= len(w) < SHORT:
                # A match of MATCHED of the words leaves out fewer than these.
                rarest = np.argsort(-weights[w], kind="stable")[: len(w) - math.ceil(MATCHED * len(w)) + 1]
                word.append(w[rarest])
                item.append(np.full(len(rarest), i))
                place.append(rarest)
        if not word:
            return np.zeros(len(weights) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, item, place = map(np.concatenate, (word, item, place))
        order = np.argsort(word, kind="stable")
        return np.searchsorted(word[order], np.arange(len(weights) + 1)), item[order], place[order]


def _answer_size(text: str) -> int:
    """Words of the closing sentence, with the sentences before it while it has under three."""
    sentences, n = re.split(r"(?<=[.!?])\s+", text.strip()), 0
    _, offsets = hash_words(sentences)
    for size in np.diff(offsets)[::-1].tolist():
        n += size
        if n >= 3:
            break
    return n


def _number(vocabulary: np.ndarray):
    dtype = np.uint16 if len(vocabulary) < 65_535 else np.uint32

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("text_md5")
            for lo in range(0, len(ids), 256):
                hashes, offsets = hash_words(batch.column("text")[lo : lo + 256].to_pylist())
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                number = np.where(vocabulary[at] == hashes, at + 1, 0).astype(dtype)
                yield pa.RecordBatch.from_arrays(
                    [ids[lo : lo + 256], marks[lo : lo + 256],
                     pa.array([number[s:e].tobytes() for s, e in zip(offsets, offsets[1:])], pa.binary())],
                    ["doc_id", "text_md5", "numbers"])
    return encode, dtype


def _documents(batches: Iterator[pa.RecordBatch], dtype, most: int = 400_000):
    """((id, mark) of each, numbers, offsets) of groups of encoded documents."""
    ids, parts, total = [], [], 0
    for batch in batches:
        for doc, mark, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text_md5").to_pylist(), batch.column("numbers")):
            part = np.frombuffer(raw.as_buffer(), dtype)
            ids.append((doc, mark))
            parts.append(part)
            total += len(part)
            if total > most:
                yield ids, np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))
                ids, parts, total = [], [], 0
    if parts:
        yield ids, np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))


def _blocks(numbers: np.ndarray, offsets: np.ndarray, size: int):
    """(positions of numbered words, the block each lies in, first block of each document and the total)."""
    count = (np.diff(offsets) + size - 1) // size
    first = np.concatenate(([0], np.cumsum(count)))
    place = np.flatnonzero(numbers)
    doc = np.searchsorted(offsets, place, side="right") - 1
    return place, first[doc] + (place - offsets[doc]) // size, first


def _document_counts(size: int, dtype):
    """Per task: in how many passages each word occurs (word 0: the number of passages)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for _, numbers, offsets in _documents(batches, dtype):
            place, block, first = _blocks(numbers, offsets, PASSAGE)
            pair = np.unique(block * (size + 1) + numbers[place])
            total += np.bincount(pair % (size + 1), minlength=size + 1)
            total[0] += first[-1]
        word = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(total[word])], ["word", "n"])
    return count


def _row_sums(runs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct runs, sums of the rows of each); equal runs are adjacent."""
    if not len(runs):
        return runs, values
    start = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
    return runs[start], np.add.reduceat(values, start, axis=0)


def _range_sums(weights: np.ndarray, basis: np.ndarray, dtype):
    """Per task: the product of (passages transposed) (passages) (basis), in messages of a few words."""
    weighted = basis * weights[:, None]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(basis.shape, np.float32)
        for _, numbers, offsets in _documents(batches, dtype, CACHED):
            place, block, _ = _blocks(numbers, offsets, PASSAGE)
            word = numbers[place].astype(np.int64)
            weight = weights[word]
            kept = weight > 0
            word, block, weight = word[kept], block[kept], weight[kept]
            if not len(word):
                continue
            group = np.cumsum(np.concatenate(([0], block[1:] != block[:-1])))
            norm = np.bincount(group, weight * weight)
            _, rows = _row_sums(group, weighted[word])
            rows /= norm[:, None].astype(np.float32)
            order = np.argsort(word, kind="stable")
            found, sums = _row_sums(word[order], rows[group[order]])
            total[found] += sums * weights[found, None]
        lane = int(np.abs(total[:, 0]).sum() * 1e6) % LANES
        starts = range(0, len(total), SLICE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(starts), pa.int64()), pa.array([lane] * len(starts), pa.int32()),
             pa.array([total[s : s + SLICE].astype(np.float64).tobytes() for s in starts], pa.binary())],
            ["slice", "lane", "sums"])
    return multiply


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.float64) for x in group.column("sums"))
    return pa.table({"slice": group.column("slice")[:1], "lane": group.column("lane")[:1],
                     "sums": pa.array([total.tobytes()], pa.binary())})


def _product(coded: DataFrame, weights: np.ndarray, basis: np.ndarray, dtype) -> np.ndarray:
    schema = "slice long, lane int, sums binary"
    parts = coded.mapInArrow(_range_sums(weights, basis.astype(np.float32), dtype), schema)
    summed = parts.groupBy("slice", "lane").applyInArrow(_add, schema).groupBy("slice").applyInArrow(_add, schema)
    rows = summed.select("slice", "sums").toArrow().sort_by("slice")
    return np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in rows.column("sums")]).reshape(basis.shape)


def latent_space(coded: DataFrame, items: _Items, dtype) -> tuple[np.ndarray, np.ndarray] | None:
    """(word weights, matrix from words to scaled latent coordinates); word 0 has no weight."""
    size = len(items.vocabulary)
    counts = coded.mapInArrow(_document_counts(size, dtype), "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")).toArrow()
    total = np.zeros(size + 1, np.int64)
    total[counts.column("word").to_numpy()] = counts.column("n").to_numpy()
    passages = int(total[0])
    if not passages:
        return None
    weights = np.log((1 + passages) / (1 + total)).clip(1e-6)
    rare = total <= COMMON * passages
    for words in items.words:
        if len(words) and rare[words].sum() < 4:
            rare[words] = True
    weights = np.where(rare, weights, 0).astype(np.float32)
    weights[0] = 0
    rank = min(RANK + SPARE, size)
    basis = np.random.default_rng(20_240_229).standard_normal((size + 1, rank))
    basis, _ = np.linalg.qr(_product(coded, weights, basis, dtype))
    image = _product(coded, weights, basis, dtype)
    inner = basis.T @ image
    strength, turn = np.linalg.eigh((inner + inner.T) / 2)
    used = np.argsort(-strength)[: min(RANK, rank)]
    used = used[strength[used] > 1e-9 * max(strength.max(), 1e-300)]
    space = basis @ turn[:, used] / np.sqrt(strength[used])
    return weights, (space * weights[:, None]).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


class _Confirm:
    """The best confirmed match of each document and item among a group of documents."""

    def __init__(self, items: _Items, numbers: np.ndarray, offsets: np.ndarray):
        self.items, self.numbers, self.offsets = items, numbers, offsets
        self.best: dict[tuple[int, int], tuple[float, float, float, int]] = {}

    def window(self, doc: int, at: int, width: int, near: Iterable[tuple[int, float]]) -> None:
        """Try the items (number, cosine) that are near to the window of `width` words at `at`."""
        plain, around = self.items.plain, {}
        low, high = int(self.offsets[doc]), int(self.offsets[doc + 1])
        for i, cosine in near:
            words, own, repeats, spare, needed, room = plain[i]
            if room not in around:
                around[room] = frozenset(self.numbers[max(low, at - room) : min(high, at + width + room)].tolist())
            # No subsequence is longer than what is there at all, with every occurrence of the item.
            missing = needed - len(own & around[room])
            if missing > 0 and (missing > spare or sum(n for x, n in repeats if x in around[room]) < missing):
                continue
            self._align(doc, i, at, width, cosine)

    def _align(self, doc: int, i: int, at: int, width: int, cosine: float) -> None:
        low, high = int(self.offsets[doc]), int(self.offsets[doc + 1])
        known = self.best.get((doc, i), (0.0,))
        if known[0] == 1 and known[1] >= cosine:
            return
        words, size = self.items.plain[i][0], len(self.items.words[i])
        region = self.numbers[max(low, at - size) : min(high, at + width + size)].tolist()
        matched = common_subsequence(words, region) / size
        if matched < MATCHED:
            return
        answer = self.items.answers[i].tolist()
        answered = common_subsequence(answer, region) / len(answer)
        if answered < ANSWERED:
            return
        new = (matched, cosine, answered, max(low, at) - low)
        if new > known:
            self.best[doc, i] = new


def _plain(words: list[int]) -> tuple:
    """(words, distinct words, further occurrences of each repeated one, their total, words of a match, words around a window)."""
    repeats = [(x, n - 1) for x, n in Counter(words).items() if n > 1]
    # Few different surroundings a window.
    return words, frozenset(words), repeats, sum(n for _, n in repeats), MATCHED * len(words), 1 << len(words).bit_length()


def _own_windows(items: _Items, anchors, asked: np.ndarray, space: np.ndarray, numbers: np.ndarray, offsets: np.ndarray):
    """(document, item, start, cosine) of windows of short items' own sizes that are near to them."""
    first, item, place = anchors
    sizes = np.asarray([len(w) for w in items.words])
    count = np.diff(first)
    spot = np.flatnonzero(count[numbers])
    step = max(1, 100_000 // max(1, int(count.max(initial=0))))
    for lo in range(0, len(spot), step):
        at = spot[lo : lo + step]
        n = count[numbers[at]]
        entry = np.repeat(first[numbers[at]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        doc = np.repeat(np.searchsorted(offsets, at, side="right") - 1, n)
        own, start = item[entry], np.repeat(at, n) - place[entry]
        # Several anchors of one copy give the same window; it may begin up to an item's length before the document.
        span = int(np.diff(offsets).max()) + SHORT
        window = np.unique((doc * len(sizes) + own) * span + start - offsets[doc] + SHORT - 1)
        doc, own = np.divmod(window // span, len(sizes))
        start = window % span - (SHORT - 1) + offsets[doc]
        for part in range(0, len(own), 16_384):
            d, i, s = doc[part : part + 16_384], own[part : part + 16_384], start[part : part + 16_384]
            total = np.zeros((len(i), space.shape[1]), np.float32)
            for k in range(int(sizes[i].max())):
                there = (k < sizes[i]) & (s + k >= offsets[d]) & (s + k < offsets[d + 1])
                total[there] += space[numbers[s[there] + k]]
            cosine = (_unit(total) * asked[i]).sum(axis=1)
            for j in np.flatnonzero(cosine >= COSINE).tolist():
                yield int(d[j]), int(i[j]), int(s[j]), float(cosine[j])


def _search(items: _Items, weights: np.ndarray, space: np.ndarray, dtype):
    known, parts = items.parts()
    owners = np.asarray(known, np.int64)
    asked = _unit(np.stack([space[w].sum(axis=0) for w in parts])).T.copy() if known else None
    anchors = items.anchors(weights)
    whole = _unit(np.stack([space[w].sum(axis=0) for w in items.words]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items.plain = [_plain(w.tolist()) for w in items.words]
        live = space.any(axis=1)
        for ids, numbers, offsets in _documents(batches, dtype, CACHED):
            confirm = _Confirm(items, numbers, offsets)
            if known:
                place, block, first = _blocks(numbers, offsets, STRIDE)
                weighty = live[numbers[place]]
                found, sums = _row_sums(block[weighty], space[numbers[place[weighty]]])
                rows = np.zeros((first[-1] + 1, space.shape[1]), np.float32)
                rows[found] = sums
                inner = np.ones(first[-1], bool)
                inner[first[1:][np.diff(first) > 0] - 1] = False
                rows[:-1][inner] += rows[1:][inner]
                rows = _unit(rows[:-1])
                owner = np.repeat(np.arange(len(ids)), np.diff(first))
                step = max(1, 8_000_000 // len(known))
                for lo in range(0, len(rows), step):
                    cosine = rows[lo : lo + step] @ asked
                    window, item = np.nonzero(cosine >= COSINE)
                    first_of = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1]))) if len(window) else window
                    values, numbered = cosine[window, item].tolist(), owners[item].tolist()
                    for s_, e in zip(first_of.tolist(), np.append(first_of[1:], len(window)).tolist()):
                        w = int(window[s_]) + lo
                        doc = int(owner[w])
                        confirm.window(doc, int(offsets[doc]) + (w - int(first[doc])) * STRIDE, PASSAGE, zip(numbered[s_:e], values[s_:e]))
            if len(anchors[1]):
                for doc, i, at, c in _own_windows(items, anchors, whole, space, numbers, offsets):
                    confirm.window(doc, at, len(items.words[i]), [(i, c)])
            rows_out = [(*ids[d], items.keys[i], c, m, a, p) for (d, i), (m, c, a, p) in sorted(confirm.best.items())]
            if rows_out:
                names = [x.split()[0] for x in _MATCHES.split(", ")]
                types = (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows_out), types)], names)
    return find


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, matched, answered, first_word, text_md5): items found in each document of `docs` (doc_id, text).

    One row for each row of `docs` and item, with the place where most of the item matches.
    """
    spark = docs.sparkSession
    items = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("long"), "text", F.sha2("text", 256).alias("key"))
    texts = items.select("key", "text").dropDuplicates(["key"])
    blocks = -(-texts.count() // BLOCK_ITEMS)
    found = None
    for block in range(blocks):
        rows = texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        part = _block_leaks(docs, _Items([x.key for x in rows], [x.text for x in rows]), scratch_path(spark, "coded")) if rows else None
        if part is not None:
            found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], _MATCHES)
    return found.join(items.select("key", "item_id"), "key").select(
        "doc_id", "item_id", "cosine", "matched", "answered", "first_word", "text_md5")


def _block_leaks(docs: DataFrame, items: _Items, path: str) -> DataFrame | None:
    if not len(items.vocabulary):
        return None
    encode, dtype = _number(items.vocabulary)
    docs.filter("text is not null").select(
        F.col("doc_id").cast("long"), "text", F.md5(F.col("text").cast("binary")).alias("text_md5")).mapInArrow(encode, _CODED).write.parquet(path)
    coded = docs.sparkSession.read.schema(_CODED).parquet(path)
    found = latent_space(coded, items, dtype)
    if found is None:
        return None
    return coded.mapInArrow(_search(items, *found, dtype), _MATCHES)
