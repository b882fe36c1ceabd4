"""Near-duplicate classes by Order MinHash over five-word shingles.

A document is the sequence of its words (`words.py`). Each sketch hashes the (shingle, occurrence number) pairs
of the text with its own hash, takes the smallest few and keeps them in text order, so that two texts share a
sketch with a probability that falls with their edit distance and not only with their set overlap. Texts that
share a sketch are candidates; a candidate pair is a link if the sets of their five-word shingles overlap
(common / all) by at least 0.8 and a banded alignment of the two word sequences confirms the order: an edit
similarity (1 - edits / longer length) of at least 0.8. Classes are the connected components.

Equal word sequences are one node from the start, numbered once and for all, so that ids that repeat with other texts do
no harm. In a bucket (texts with one sketch in common) each text is compared with the bucket's first, the text that shares
most buckets with others; this is linear in groups of any size and joins most of each group. It decides nothing: all texts of buckets that still hold
several components go through an exact search (`overlaps`), so that every pair of different components that shares a
bucket is verified or ruled out by a bound. The search orders the shingles by how many of these texts hold them, rare ones
first. Two sets that overlap by 0.8 share a shingle among the first fifth of each, and among the first ninth
of the smaller; passages that thousands of texts share come last and are not in these parts. At a shingle overlap of
0.8 a pair misses all 16 sketches with a probability of about 1e-7.

Sketches, buckets, pairs and links are rows of numbers; texts are read again only for nodes that share a bucket.
Few exchanges matter here: with many small partitions every exchange costs files, not bytes.

Defined results: class_id is the smallest doc_id of the class, exact_id the smallest doc_id with the same word
sequence; class_key is one number per class, and text_md5 tells rows of one doc_id apart. A text without any word equals
only the same text. Texts under five words have one shingle of all their words. Rows that repeat a doc_id are classed by
their texts, each row being returned. Rows without a doc_id are classed like others and have null ids where no row of their
class has one. A null text equals nothing: its class is its own doc_id, its key null. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.align import similar
from riskweave.llm.components import components
from riskweave.llm.words import combine, hash_words, mix
from riskweave.session import checkpointed

SHINGLE = 5
SKETCHES = 16
TAKEN = 2  # smallest shingles kept in a sketch
OVERLAP = 4, 5  # least shingle overlap of a link, as a fraction of whole numbers
SIMILARITY = 0.8
COUNTERS = 20  # bits of a shingle that choose its counter
SLICE = 2048  # counters per message
_SEEDS = mix(np.arange(1, 1025, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def sketch(words: np.ndarray, sketches: int = SKETCHES, taken: int = TAKEN) -> np.ndarray:
    """Order MinHash sketches of one text's word hashes; none for a text without words."""
    if not len(words):
        return np.zeros(0, np.int64)
    shingles = combine(words, min(SHINGLE, len(words)))
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    again = np.concatenate(([False], ranked[1:] == ranked[:-1]))
    labelled = shingles
    if again.any():
        at = np.arange(len(ranked))
        first = np.maximum.accumulate(np.where(again, 0, at))
        labelled = shingles.copy()
        number = (at - first).astype(np.uint64)
        labelled[order] = np.where(again, mix(ranked + number * np.uint64(0xE7037ED1A0B428DB)), ranked)
    n, out = min(taken, len(shingles)), []
    step = max(1, (1 << 20) // len(shingles))
    for lo in range(0, sketches, step):
        seeds = _SEEDS[lo : min(lo + step, sketches), None]
        values = (labelled[None, :] ^ seeds) * np.uint64(0x8EBC6AF09C88C6E3)
        values ^= values >> np.uint64(29)
        values *= np.uint64(0x589965CC75374CC3)
        places, line = [], np.arange(len(values))
        for _ in range(n):
            place = values.argmin(axis=1)
            places.append(place)
            values[line, place] = np.uint64(0xFFFFFFFFFFFFFFFF)
        chosen = np.sort(np.stack(places, axis=1), axis=1)
        total = seeds[:, 0].copy()
        for k in range(n):
            total = mix(total * np.uint64(0x1D8E4E27C47D124F) + shingles[chosen[:, k]])
        out.append(total)
    return np.concatenate(out).view(np.int64)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The distinct shingles of one text's word hashes, sorted."""
    return np.unique(combine(words, min(SHINGLE, len(words)))) if len(words) else np.zeros(0, np.uint64)


def overlapping(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets overlap enough for a link."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return OVERLAP[1] * common >= OVERLAP[0] * (len(a) + len(b) - common)


def words_key(words: np.ndarray, text: str) -> bytes:
    """What is equal for texts of the same words, or of the same characters if there are no words."""
    return md5(words.tobytes() if len(words) else b"text:" + text.encode("utf-8", "surrogatepass")).digest()


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        hashes, offsets = hash_words(texts)
        keys, sketches = [], []
        for text, start, end in zip(texts, offsets, offsets[1:]):
            keys.append(None if text is None else words_key(hashes[start:end], text))
            sketches.append(sketch(hashes[start:end]))
        sizes = [len(x) for x in sketches]
        values = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
            pa.array(np.concatenate(sketches) if sketches else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_md5"), pa.array(keys, pa.binary()), pa.array(np.diff(offsets), pa.int64()), values],
            ["doc_id", "text_md5", "words_key", "n_words", "sketches"])


def _rekey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts with their keys."""
    for batch in batches:
        for lo in range(0, len(batch), 256):
            column = batch.column("text")[lo : lo + 256]
            texts = column.to_pylist()
            hashes, offsets = hash_words(texts)
            keys = [words_key(hashes[s:e], t) for t, s, e in zip(texts, offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), column], ["words_key", "text"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        close: list[float | None] = []
        left, right = batch.column("text_a"), batch.column("text_b")
        for lo in range(0, len(a), 64):
            pair = left[lo : lo + 64].to_pylist() + right[lo : lo + 64].to_pylist()
            hashes, offsets = hash_words(pair)
            cut, half = [hashes[s:e] for s, e in zip(offsets, offsets[1:])], len(pair) // 2
            close += [similar(cut[i].tolist(), cut[half + i].tolist(), SIMILARITY)
                      if overlapping(shingle_set(cut[i]), shingle_set(cut[half + i])) else None for i in range(half)]
        kept = [i for i, x in enumerate(close) if x is not None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in kept], pa.int64()), pa.array([b[i] for i in kept], pa.int64()),
             pa.array([close[i] for i in kept], pa.float64())], ["a", "b", "similarity"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts overlap and align well enough, with the similarity of the alignment."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify, "a long, b long, similarity double")


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, exact_id, n_words, class_key, text_md5) for every row of `docs` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    prepared = checkpointed(docs.withColumn("text_md5", F.md5(F.col("text").cast("binary"))).mapInArrow(
        _prepare, "doc_id long, text_md5 string, words_key binary, n_words long, sketches array<long>"))
    # Numbers of nodes are given as the table is written and do not change after that.
    nodes = checkpointed(prepared.filter("words_key is not null").groupBy("words_key").agg(
        F.min("doc_id").alias("exact_id"), F.first("n_words").alias("n_words"), F.first("sketches").alias("sketches")).withColumn(
        "node", F.monotonically_increasing_id()))
    labels = _labels(docs, nodes)
    classed = nodes.select("words_key", "node", "exact_id")
    if labels is not None:
        classed = classed.join(labels.withColumnRenamed("node", "labelled"), F.col("node") == F.col("labelled"), "left")
    else:
        classed = classed.withColumn("label", F.lit(None).cast("long"))
    classed = classed.select("words_key", "exact_id", F.coalesce("label", "node").alias("class_key"))
    # Only classes of several nodes need their smallest id looked up.
    several = classed.groupBy("class_key").agg(F.min("exact_id").alias("class_id"), F.count("*").alias("nodes")).filter("nodes > 1")
    classed = classed.join(several.drop("nodes"), "class_key", "left").select(
        "words_key", "exact_id", "class_key", F.coalesce("class_id", "exact_id").alias("class_id"))
    found = prepared.drop("sketches").join(classed, "words_key", "left")
    return found.select(
        "doc_id", F.when(F.col("words_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("words_key").isNull(), F.col("doc_id")).otherwise(F.col("exact_id")).alias("exact_id"), "n_words",
        "class_key", "text_md5")


def _labels(docs: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """(node, label) of the nodes in links; None without links."""
    members = nodes.filter("n_words > 0").select("node", "exact_id", "n_words", F.posexplode("sketches").alias("band", "value"))
    members = members.select("node", "exact_id", "n_words", F.xxhash64("band", "value").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = checkpointed(members.join(sizes, "bucket"))
    # The first of a bucket is the text with the most company over all its buckets: what copies were made from, if anything.
    company = members.groupBy("node").agg(F.sum("n").alias("company"))
    firsts = members.join(company, "node").groupBy("bucket").agg(
        F.max(F.struct("company", (-F.col("exact_id")).alias("id"), "node", "n_words")).alias("it")).select(
        "bucket", F.col("it.node").alias("first"), F.col("it.n_words").alias("first_words"))
    members = checkpointed(members.drop("n").join(firsts, "bucket"))
    bodies = _bodies(docs, nodes, members)
    near = F.least("n_words", "first_words") >= SIMILARITY * F.greatest("n_words", "first_words") - 1e-6
    tested = checkpointed(members.filter((F.col("node") != F.col("first")) & near).select(
        F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    links = checkpointed(verified(tested, bodies).select("a", "b"))
    labels = None if links.isEmpty() else components(links)
    more = _left_over(members, bodies, labels, tested)
    if more is not None:
        # Nodes joined so far stand for their component.
        links = more if labels is None else labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more)
        labels = components(links)
    return labels


def _bodies(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, n_words, text) of the nodes that share a bucket, once each."""
    wanted = checkpointed(members.select("node", "exact_id", "n_words").distinct().join(
        nodes.select("words_key", F.col("node").alias("same")), F.col("node") == F.col("same")).drop("same"))
    # An id may have further texts, so what it finds is told apart by its key.
    ids = wanted.select(F.col("exact_id").alias("wanted_id")).distinct()
    texts = docs.filter("text is not null").join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    texts = texts.mapInArrow(_rekey, "words_key binary, text string")
    return checkpointed(wanted.join(texts, "words_key").dropDuplicates(["words_key"]).select("node", "n_words", "text"))


def _left_over(members: DataFrame, bodies: DataFrame, labels: DataFrame | None, tested: DataFrame) -> DataFrame | None:
    """The links (a, b) between components that still share a bucket; None if there are none."""
    placed = members.select("bucket", "node", F.col("node").alias("component"))
    if labels is not None:
        placed = members.select("bucket", "node").join(labels, "node", "left").select(
            "bucket", "node", F.coalesce("label", "node").alias("component"))
    # Both texts of a bucket of two have been compared.
    mixed = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).filter("low != high and n > 2")
    open_ = placed.join(mixed.select("bucket"), "bucket", "left_semi").select("node", "component").distinct()
    texts = checkpointed(bodies.join(open_, "node"))
    if texts.isEmpty():
        return None
    pairs = overlaps(texts)
    done = tested.union(tested.select("b", "a")).withColumnRenamed("a", "x").withColumnRenamed("b", "y")
    pairs = checkpointed(pairs.join(done, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti"))
    if pairs.isEmpty():
        return None
    found = checkpointed(verified(pairs, bodies).select("a", "b"))
    return None if found.isEmpty() else found


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle set) of the texts of a batch."""
    for lo in range(0, batch.num_rows, 256):
        hashes, offsets = hash_words(batch.column("text")[lo : lo + 256].to_pylist())
        for i, (start, end) in enumerate(zip(offsets, offsets[1:])):
            yield lo + i, shingle_set(hashes[start:end])


def _places(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTERS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how many texts hold a shingle of each counter, in messages of a few counters."""
    total = np.zeros(1 << COUNTERS, np.int64)
    for batch in batches:
        for _, shingles in _sets(batch):
            np.add.at(total, _places(shingles), 1)
    parts = [(s, total[s : s + SLICE]) for s in range(0, len(total), SLICE)]
    parts = [(s, x) for s, x in parts if x.any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([s for s, _ in parts], pa.int64()), pa.array([x.astype(np.int32).tobytes() for _, x in parts], pa.binary())],
        ["slice", "counts"])


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.int32).astype(np.int64) for x in group.column("counts"))
    return pa.table({"slice": group.column("slice")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _first_parts(counts: np.ndarray):
    """The first fifth of each text's shingles, rare ones first; a shingle that one text alone holds pairs nothing."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, places, sizes = [], [], [], []
            for row, shingles in _sets(batch):
                n, often = len(shingles), counts[_places(shingles)]
                first = np.lexsort((shingles, often))[: n - -(-OVERLAP[0] * n // OVERLAP[1]) + 1]
                place = np.flatnonzero(often[first] > 1)
                rows.append(np.full(len(place), row))
                parts.append(shingles[first[place]])
                places.append(place)
                sizes.append(np.full(len(place), n))
            if not rows:
                continue
            row = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts).view(np.int64)), batch.column("node").take(row), batch.column("component").take(row),
                 batch.column("n_words").take(row), pa.array(np.concatenate(sizes), pa.int32()), pa.array(np.concatenate(places), pa.int32())],
                ["shingle", "node", "component", "n_words", "n", "place"])
    return cut


def overlaps(texts: DataFrame) -> DataFrame:
    """(a, b): pairs of different components in `texts` (node, n_words, text, component) that may be links; no link is left out."""
    schema = "slice long, counts binary"
    summed = texts.mapInArrow(_count, schema).groupBy("slice").applyInArrow(_add, schema).toArrow()
    counts = np.zeros(1 << COUNTERS, np.int64)
    for start, part in zip(summed.column("slice").to_pylist(), summed.column("counts")):
        counts[start : start + SLICE] = np.frombuffer(part.as_buffer(), np.int64)
    parts = checkpointed(texts.mapInArrow(
        _first_parts(counts), "shingle long, node long, component long, n_words long, n int, place int"))
    mixed = parts.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    parts = parts.join(mixed.select("shingle"), "shingle", "left_semi")
    # Sizes of a link differ by a factor of 1.25 at most, so they lie in one band or in neighbouring ones.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.26)))
    of, whole = OVERLAP[0], OVERLAP[0] + OVERLAP[1]
    small = parts.filter(f"place < n - ceil({2 * of} * n / {whole}) + 1").select(
        "shingle", band.alias("band"), *[F.col(x).alias(f"{x}_b") for x in ("node", "component", "n_words", "n", "place")])
    large = parts.withColumn("band", F.explode(F.array(band, band - 1)))
    pairs = large.join(small, ["shingle", "band"]).filter("component != component_b and (n_b < n or n_b = n and node_b < node)").filter(
        f"{OVERLAP[1]} * n_b >= {of} * n and {whole} * least(n - place, n_b - place_b) >= {of} * (n + n_b)").filter(
        F.least("n_words", "n_words_b") >= SIMILARITY * F.greatest("n_words", "n_words_b") - 1e-6)
    return pairs.select(F.col("node_b").alias("a"), F.col("node").alias("b")).distinct()
