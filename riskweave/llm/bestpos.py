"""Ranked lexical search by the Best Position Algorithm over impact lists.

Terms are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased. One pass writes every
document as the numbers and counts of the terms that some item has, with its length; sums over it give the document
frequencies. Then blocks of documents are searched where they lie: a block holds, for each term, an impact list (its
documents by falling impact) and the same postings by document. An item reads its lists from the top in growing steps.
Every document met is scored at once by direct accesses to the item's other lists, and every place touched on the way
counts as seen. A list's best position is the end of its seen run from the top; as documents met in one list are
seen in all the others, best positions run ahead of the places read. No unseen document can score more than the impacts
at the best positions together, so an item ends as soon as this sum is strictly below its kth score (equal scores could
still win by id), or all lists are seen. The best of a task's earlier blocks raise the kth score; the best of all tasks are merged by
windows, first over lanes and then over the item.

Scores are whole numbers: the sum of w * ((1000000000 * tf) div (1000 * tf + 12 * m)) over the item's terms with
repeats, where w = floor(1000 * ln((2N+2) / (2df+1))) and m = 75 + (25 * n * N) div L.

Items are the stated query set. Equal texts are searched once; distinct texts are dealt by hash to blocks of about BLOCK_ITEMS
items or BLOCK_CHARS characters, so what a task holds does not grow with their number, and each block is searched in all documents.

Defined results: a null or termless text is no document of N and never found; null or termless items, and those without
an id, find nothing. Rows that repeat a doc_id are documents of their own; equal scores go by ascending doc_id, a null
one last. A repeated item row is one item; an item_id with several texts is ranked once for each. With no documents or no
items the result is empty. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.words import PIECE, _hash_runs, codepoints, spans
from riskweave.session import scratch_path

BEST = 20
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 20_000_000
BLOCK_POSTINGS = 2_000_000  # postings of a block of documents, and thus of a task's lists
FIRST_STEP = 16  # places read from each list before the first look at the threshold
LANES = 64
_BREAK = re.compile(r"[\x00-/:-@\[-`{-\x7f]")
_TERM = np.ones(0x110000, bool)
_TERM[:0x80] = [chr(c).isalnum() for c in range(0x80)]
_CODED = "doc_id long, n long, terms binary, counts binary"
_FOUND = "item int, doc_id long, score long, lane int"


def pieces_of(texts: list[str | None], breaks: re.Pattern, longest: int) -> Iterator[tuple[int, str]]:
    """(row, piece) of all texts; those beyond `longest` are cut behind the next break."""
    for row, text in enumerate(texts):
        at, size = 0, len(text or "")
        while at < size:
            found = breaks.search(text, at + longest) if size - at > longest else None
            end = found.end() if found else size
            yield row, text[at:end]
            at = end


def _hash_group(group: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    codes = codepoints("\0".join([text for _, text in group]))
    capital = (codes >= 65) & (codes <= 90)
    codes = codes + (capital * np.uint32(32))
    start, end = spans(_TERM[codes])
    piece = np.searchsorted(np.cumsum([len(text) + 1 for _, text in group]), start, side="right")
    return np.asarray([row for row, _ in group])[piece], _hash_runs(codes, start, end)


def hash_terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every term, by row."""
    rows, hashes, group, size = [], [], [], 0
    for part in pieces_of(texts, _BREAK, PIECE):
        group.append(part)
        size += len(part[1]) + 1
        if size > PIECE:
            row, found = _hash_group(group)
            rows.append(row)
            hashes.append(found)
            group, size = [], 0
    if group:
        row, found = _hash_group(group)
        rows.append(row)
        hashes.append(found)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


def _code(vocabulary: np.ndarray):
    """Documents as numbers and counts of the vocabulary's terms."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                row, hashes = hash_terms(part.column("text").to_pylist())
                n = np.bincount(row, minlength=len(part))
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = vocabulary[at] == hashes
                pair, count = np.unique(row[known] * len(vocabulary) + at[known], return_counts=True)
                cut = np.searchsorted(pair, np.arange(len(part) + 1) * len(vocabulary))
                term, count = (pair % len(vocabulary)).astype(np.int32), count.astype(np.int32)
                kept = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(kept)), pa.array(n[kept]),
                     pa.array([term[cut[i] : cut[i + 1]].tobytes() for i in kept], pa.binary()),
                     pa.array([count[cut[i] : cut[i + 1]].tobytes() for i in kept], pa.binary())],
                    ["doc_id", "n", "terms", "counts"])
    return encode


def _frequencies(size: int):
    """Per task: documents that hold each term; -1 the documents, -2 all their terms."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            docs += len(batch)
            length += int(batch.column("n").to_numpy().sum())
            terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            total += np.bincount(terms, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((held, [-1, -2]))), pa.array(np.concatenate((total[held], [docs, length])))], ["term", "n"])
    return count


class ImpactLists:
    """The postings of a block of documents: by falling impact, and by document, for each term."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int):
        order = np.argsort(term, kind="stable")  # postings come by document
        term, self.doc, impact = term[order], doc[order], impact[order]
        self.start = np.searchsorted(term, np.arange(terms + 1))
        by_impact = np.lexsort((-impact, term))
        self.listed, self.impact = self.doc[by_impact], impact[by_impact]
        self.place = np.empty(len(term), np.int64)  # where a posting by document stands in its impact list
        self.place[by_impact] = np.arange(len(term)) - self.start[term]

    def direct(self, term: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of `docs` the list has, their places in it); `docs` ascend."""
        low, high = self.start[term], self.start[term + 1]
        at = np.searchsorted(self.doc[low:high], docs)
        held = np.flatnonzero(at < high - low)
        held = held[self.doc[low + at[held]] == docs[held]]
        return held, self.place[low + at[held]]


def best_positions(lists: ImpactLists, terms: np.ndarray, weights: np.ndarray, docs: int, best: int = BEST, floor: int = 0,
                   step: int = FIRST_STEP) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that hold all of the `best` highest scores from `floor` on (those equal to the last included)."""
    used = [(int(t), int(w)) for t, w in zip(terms, weights) if w > 0 and lists.start[t + 1] > lists.start[t]]
    sizes = [int(lists.start[t + 1] - lists.start[t]) for t, _ in used]
    seen = [np.zeros(n + 1, bool) for n in sizes]  # the place behind the end is never seen
    position = [0] * len(used)
    met = np.zeros(docs, bool)
    kept_docs, kept_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    read = 0
    while used:
        fresh = []
        for k, (t, _) in enumerate(used):
            low = lists.start[t]
            fresh.append(lists.listed[low + min(read, sizes[k]) : low + min(read + step, sizes[k])])
            seen[k][min(read, sizes[k]) : min(read + step, sizes[k])] = True
        read += step
        step += step // 2
        new = np.concatenate(fresh)
        new = np.unique(new[~met[new]])
        met[new] = True
        score = np.zeros(len(new), np.int64)
        threshold = 0
        for k, (t, w) in enumerate(used):
            held, place = lists.direct(t, new)
            score[held] += w * lists.impact[lists.start[t] + place]
            seen[k][place] = True
            position[k] += int(seen[k][position[k] :].argmin())
            if position[k] < sizes[k]:
                # All before this place is seen; the place itself bounds what is not.
                threshold += w * int(lists.impact[lists.start[t] + position[k]])
        kept_docs, kept_scores = np.concatenate((kept_docs, new)), np.concatenate((kept_scores, score))
        last = floor
        if len(kept_scores) >= best:
            last = max(floor, int(np.partition(kept_scores, -best)[-best]))
        good = kept_scores >= max(last, 1)
        kept_docs, kept_scores = kept_docs[good], kept_scores[good]
        if threshold < last or not threshold:
            break
    return kept_docs, kept_scores


class _Top:
    """The best documents of one item so far: highest score first, then smallest id, null ids last."""

    def __init__(self):
        self.ids, self.null, self.score = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) >= BEST else 0

    def add(self, ids: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        ids, null, score = np.concatenate((self.ids, ids)), np.concatenate((self.null, null)), np.concatenate((self.score, score))
        first = np.lexsort((ids, null, -score))[:BEST]
        self.ids, self.null, self.score = ids[first], null[first], score[first]


def _doc_blocks(batches: Iterator[pa.RecordBatch]):
    """(doc_id column, lengths, document, term and count of each posting) of blocks of documents."""
    group, size = [], 0
    for batch in batches:
        for lo in range(0, len(batch), 1024):
            part = batch.slice(lo, 1024)
            group.append(part)
            size += part.column("terms").nbytes // 4
            if size > BLOCK_POSTINGS:
                yield _postings(group)
                group, size = [], 0
    if group:
        yield _postings(group)


def _postings(group: list[pa.RecordBatch]):
    whole = pa.Table.from_batches(group)
    raw = whole.column("terms").to_pylist()
    doc = np.repeat(np.arange(len(raw)), [len(x) // 4 for x in raw])
    term, count = (np.frombuffer(b"".join(x), np.int32).astype(np.int64) for x in (raw, whole.column("counts").to_pylist()))
    return whole.column("doc_id"), whole.column("n").to_pylist(), doc, term, count


def _search(items: list[tuple[np.ndarray, np.ndarray]], terms: int, documents: int, length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, _Top] = {}
        for doc_id, n, doc, term, count in _doc_blocks(batches):
            m = np.asarray([75 + 25 * x * documents // length for x in n], np.int64)
            lists = ImpactLists(term, doc, 1_000_000_000 * count // (1000 * count + 12 * m[doc]), terms)
            null = np.asarray(doc_id.is_null())
            ids = doc_id.fill_null(0).to_numpy()
            for i, (own, weights) in enumerate(items):
                found = top.get(i)
                docs, scores = best_positions(lists, own, weights, len(n), floor=found.floor if found else 0)
                if len(docs):
                    found = top.setdefault(i, _Top())
                    found.add(ids[docs], null[docs], scores)
        if top:
            sizes = [len(x.ids) for x in top.values()]
            ids, null, score = (np.concatenate([getattr(x, name) for x in top.values()]) for name in ("ids", "null", "score"))
            lane = int(ids.sum() % LANES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(top), sizes), pa.int32()), pa.array(ids, mask=null), pa.array(score),
                 pa.array(np.full(len(ids), lane), pa.int32())], ["item", "doc_id", "score", "lane"])
    return find


def rank(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): the BEST documents of `docs` (doc_id, text) for each item of `benchmark` (item_id, text)."""
    spark = docs.sparkSession
    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    items = items.withColumn("key", F.sha2("text", 256))
    texts = items.select("key", "text").dropDuplicates(["key"])
    n, chars = texts.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    found = None
    for block in range(blocks):
        part = _rank_block(docs, texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect())
        if part is not None:
            found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = found.join(items.select("key", "item_id"), "key")
    return found.select("item_id", "rank", "doc_id", "score")


def _rank_block(docs: DataFrame, rows: list) -> DataFrame | None:
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "terms")
    row, hashes = hash_terms([x.text for x in rows])
    vocabulary, number = np.unique(hashes, return_inverse=True)
    if not len(vocabulary):
        return None
    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_code(vocabulary), _CODED).write.parquet(path)
    coded = spark.read.schema(_CODED).parquet(path)
    counts = coded.mapInArrow(_frequencies(len(vocabulary)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = dict(zip(counts.column("term").to_pylist(), counts.column("n").to_pylist()))
    documents, length = total.get(-1, 0), total.get(-2, 0)
    if not documents:
        return None
    weight = np.asarray([math.floor(1000 * math.log((2 * documents + 2) / (2 * total.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
    wanted, cut = [], np.searchsorted(row, np.arange(len(rows) + 1))
    for low, high in zip(cut, cut[1:]):
        own, repeats = np.unique(number[low:high], return_counts=True)
        wanted.append((own, weight[own] * repeats))
    found = coded.mapInArrow(_search(wanted, len(vocabulary), documents, length), _FOUND)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for part in (("item", "lane"), ("item",)):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).filter(F.col("rank") <= BEST)
    keys = spark.createDataFrame([(i, x.key) for i, x in enumerate(rows)], "item int, key string")
    return found.join(keys, "item").select("key", "rank", "doc_id", "score")


def rank_sql() -> str:
    """The same in DuckDB SQL over `documents` and `benchmark`."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with cut as (
  select row_number() over () as row, doc_id, regexp_extract_all({lower.format('text')}, '{term}') as terms from documents),
docs as (select row, doc_id, terms, len(terms) as n from cut where len(terms) > 0),
total as (select count(*) as docs, cast(sum(n) as bigint) as length from docs),
held as (select row, term, count(*) as tf from (select row, unnest(terms) as term from docs) group by row, term),
items as (select distinct item_id, text from benchmark where item_id is not null and text is not null),
asked as (
  select item_id, text, term, count(*) as repeats
  from (select item_id, text, unnest(regexp_extract_all({lower.format('text')}, '{term}')) as term from items) group by item_id, text, term),
weighed as (
  select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w
  from held, total where term in (select term from asked) group by term),
scored as (
  select a.item_id, a.text, d.row, d.doc_id,
         cast(sum(a.repeats * w.w * ((1000000000 * h.tf) // (1000 * h.tf + 12 * (75 + (25 * d.n * t.docs) // t.length)))) as bigint) as score
  from asked a join weighed w using (term) join held h using (term) join docs d on d.row = h.row cross join total t
  group by a.item_id, a.text, d.row, d.doc_id)
select item_id, rank, doc_id, score from (
  select item_id, doc_id, score,
         cast(row_number() over (partition by item_id, text order by score desc, doc_id nulls last) as integer) as rank
  from scored where score > 0)
where rank <= {BEST}"""
