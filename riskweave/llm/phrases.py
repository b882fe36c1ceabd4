"""Collocations by vertically partitioned suffix subtrees.

Texts (A-Z lower-cased) are cut at punctuation and line breaks into pieces and at blanks and tabs into words; everything
counts per language. The suffix at a word is cut off after four words, as longer phrases are not asked for. Two passes:

1. Counts of all single words, and of two-word prefixes in counters: a prefix is hashed to one of 2^28, every task sends its
   counters by slice, packed, and each slice is added up in one place. A counter below 30 proves its prefixes rare; their
   suffixes are left out of the second pass and those of their left neighbours end early. A slice also cuts its
   frequent prefixes into groups of about BUDGET suffixes, in the order of their counters; a prefix above the budget gets
   several groups, into which its whole suffixes are hashed. The bit map of frequent counters (32 MB at most) and the
   groups' first counters are all that is broadcast.
2. Every task sends its distinct suffixes, with their numbers, to their groups. A group sorts its suffixes, which lays out
   its subtree: a node is a run of equal prefixes, and its count is the total of the leaves below. Nodes above the place where a hot
   prefix was split have a part in each of its groups, and these parts are added.

A hash of language and word stands for a word (64 bits; a collision in the table stops the job with an error). Cuts and
longer phrases are looked up by joins on phrases. A score is floor(2000000 * a / (l + r)) in whole decimals.

Defined results: a null text is an empty one, a null language is `und`. Repeated rows count as often as they are there;
doc_id is not read, nor are other columns. An empty table, or one without a phrase of 30 occurrences, gives no rows.
Ties go by the stated order. Long texts are taken in stretches that end at a cut between pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.bestpos import pieces_of
from riskweave.llm.words import _hash_runs, codepoints, mix, spans
from riskweave.session import checkpointed

DEEPEST = 4  # words of a phrase
LEAST = 30  # occurrences of a candidate
INSIDE = 80  # percent of a phrase's occurrences within a longer one that drop it
BEST = 2000
NO_LANGUAGE = "und"
COUNTERS = 28  # bits of a two-word prefix's counter
SLICE = 18  # bits of a counter within its slice
BUDGET = 1 << 20  # suffixes of a group
STRETCH = 1 << 20  # code points handled at once
KEPT = 500_000  # words and counters a task adds up before it sends them
_CUT = re.compile("[.,;:!?\n-\r]")
_WORD = np.ones(0x110000, bool)
_WORD[[ord(c) for c in ".,;:!?\n\v\f\r \t"]] = False
_STEP = np.uint64(0xD6E8FEB86659FD93)
_FIRST = "kind int, key long, n long, word string, lang string, packed binary"
_GROUPS = "slice long, frequent binary, starts array<long>, parts array<long>"
_SUFFIX = "grp long, w1 long, w2 long, w3 long, w4 long, n long"
_NODE = "w1 long, w2 long, w3 long, w4 long, n long"
WORDS = ["w1", "w2", "w3", "w4"]


class _Stretch:
    """The words of some texts: their keys, and whether each goes on to the next within a piece."""

    def __init__(self, parts: list[tuple[int, str]], langs: list[str]):
        self.text = "\n".join([text for _, text in parts])
        codes = codepoints(self.text)
        capital = (codes >= 65) & (codes <= 90)
        codes = codes + capital * np.uint32(32)
        self.start, self.end = spans(_WORD[codes])
        breaks = np.cumsum(~_WORD[codes] & (codes != 32) & (codes != 9))
        part = np.searchsorted(np.cumsum([len(text) + 1 for _, text in parts]), self.start, side="right")
        self.lang = [langs[row] for row, _ in parts]
        self.part = part
        salt = np.asarray([_salt(x) for x in self.lang], np.uint64)
        self.key = mix(_hash_runs(codes, self.start, self.end) + salt[part]) | np.uint64(1)
        at = breaks[self.start] if len(codes) else np.zeros(0, np.int64)
        self.joined = at[1:] == at[:-1]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, counter) of every two neighbours in a piece."""
        at = np.flatnonzero(self.joined)
        return at, (mix(self.key[at] * _STEP + self.key[at + 1]) >> np.uint64(64 - COUNTERS)).astype(np.int64)

    def name(self, at: int) -> tuple[str, str]:
        word = self.text[self.start[at] : self.end[at]]
        return word.translate(_LOWER), self.lang[self.part[at]]


_LOWER = {c: c + 32 for c in range(65, 91)}
_SALTS: dict[str, int] = {}


def _salt(lang: str) -> int:
    if lang not in _SALTS:
        if len(_SALTS) > 10_000:
            _SALTS.clear()
        _SALTS[lang] = int.from_bytes(md5(lang.encode("utf-8", "surrogatepass")).digest()[:8], "little")
    return _SALTS[lang]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[_Stretch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lo in range(0, len(batch), 1024):
            group, size = [], 0
            for row, text in pieces_of(batch.column("text")[lo : lo + 1024].to_pylist(), _CUT, STRETCH):
                group.append((lo + row, text))
                size += len(text)
                if size > STRETCH:
                    yield _Stretch(group, langs)
                    group, size = [], 0
            if group:
                yield _Stretch(group, langs)


def _totals(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, sums of their counts)."""
    value, count = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(value, kind="stable")
    value, count = value[order], count[order]
    start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, np.int64)
    return value[start], np.add.reduceat(count, start) if len(start) else count


def pack(counters: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending counters of a slice with their counts."""
    return zlib.compress(np.diff(counters, prepend=0).astype(np.uint32).tobytes() + counts.astype(np.uint32).tobytes(), 1)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.int64).reshape(2, -1)
    return np.cumsum(steps), counts


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: words with their numbers (kind 0) and counters of two-word prefixes by slice (kind 1)."""
    count: dict[int, int] = {}
    named: dict[int, tuple[str, str]] = {}
    counters, numbers, waiting = [], [], 0

    def send_words() -> pa.RecordBatch:
        keys = np.fromiter(count, np.uint64, len(count)).view(np.int64)
        words, langs = zip(*map(named.__getitem__, count))
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(keys)), pa.int32()), pa.array(keys), pa.array(list(count.values()), pa.int64()),
             pa.array(words, pa.string()), pa.array(langs, pa.string()), pa.nulls(len(keys), pa.binary())], _names(_FIRST))
        count.clear()
        named.clear()
        return out

    def send_counters() -> pa.RecordBatch:
        value, number = _totals(counters, numbers)
        slices = value >> SLICE
        start = np.flatnonzero(np.concatenate(([True], slices[1:] != slices[:-1])))
        packed = [pack(value[s:e] & ((1 << SLICE) - 1), number[s:e]) for s, e in zip(start, np.append(start[1:], len(value)))]
        counters.clear()
        numbers.clear()
        n = len(start)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(n), pa.int32()), pa.array(slices[start]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()),
             pa.nulls(n, pa.string()), pa.array(packed, pa.binary())], _names(_FIRST))

    for stretch in _stretches(batches):
        if not len(stretch.key):
            continue
        keys, first, number = np.unique(stretch.key, return_index=True, return_counts=True)
        for key, at, n in zip(keys.tolist(), first.tolist(), number.tolist()):
            if key in count:
                count[key] += n
            else:
                count[key] = n
                named[key] = stretch.name(at)
        if len(count) > KEPT:
            yield send_words()
        _, counter = stretch.pairs()
        counter, number = np.unique(counter, return_counts=True)
        counters.append(counter)
        numbers.append(number)
        waiting += len(counter)
        if waiting > 8 * KEPT:
            value, number = _totals(counters, numbers)
            counters[:], numbers[:], waiting = [value], [number], len(value)
            if waiting > 4 * KEPT:
                yield send_counters()
                waiting = 0
    if count:
        yield send_words()
    if any(map(len, counters)):
        yield send_counters()


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _add_slice(group: pa.Table) -> pa.Table:
    """The frequent counters of a slice as bits, and its groups of prefixes: first counter, number of parts."""
    total = np.zeros(1 << SLICE, np.int64)
    for packed in group.column("packed"):
        counter, count = unpack(packed.as_buffer())
        total[counter] += count
    frequent = total >= LEAST
    held = np.flatnonzero(frequent)
    mass = total[held]
    hot = mass > BUDGET
    # A hot prefix stands alone; the others are cut where their running total passes a multiple of the budget.
    run = np.cumsum(np.where(hot, 0, mass)) // BUDGET + 2 * np.cumsum(hot) - hot
    start = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(held) else np.zeros(0, np.int64)
    slice_ = group.column("key")[0].as_py()
    starts = held[start] + (slice_ << SLICE)
    parts = np.where(hot[start], -(-mass[start] // BUDGET), 1)
    bits = zlib.compress(np.packbits(frequent).tobytes(), 1) if len(held) else None
    return pa.table({"slice": [slice_], "frequent": pa.array([bits], pa.binary()), "starts": pa.array([starts.tolist()], pa.list_(pa.int64())),
                     "parts": pa.array([parts.tolist()], pa.list_(pa.int64()))})


class Prefixes:
    """Frequent two-word prefixes and the groups of their suffixes."""

    def __init__(self, rows: list):
        self.bits: dict[int, bytes] = {x["slice"]: x.frequent for x in rows if x.frequent is not None}
        every = sorted((s, p) for x in rows for s, p in zip(x.starts, x.parts))
        self.starts = np.asarray([s for s, _ in every], np.int64)
        self.parts = np.asarray([p for _, p in every], np.int64)
        self.base = np.cumsum(self.parts) - self.parts

    def frequent(self) -> np.ndarray:
        """The bit map of all counters, as bytes."""
        out = np.zeros(1 << (COUNTERS - 3), np.uint8)
        size = 1 << (SLICE - 3)
        for slice_, bits in self.bits.items():
            out[slice_ * size : (slice_ + 1) * size] = np.frombuffer(zlib.decompress(bits), np.uint8)
        return out

    def group(self, counter: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.starts, counter, side="right") - 1
        return self.base[at] + (suffix % self.parts[at].astype(np.uint64)).astype(np.int64)


def _suffixes(shared):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = shared.value
        bits = prefixes.frequent()
        for stretch in _stretches(batches):
            n = len(stretch.key)
            at, counter = stretch.pairs()
            good = (bits[counter >> 3] >> (7 - (counter & 7)).astype(np.uint8)) & 1 > 0
            at, counter = at[good], counter[good]
            if not len(at):
                continue
            goes_on = np.zeros(n + DEEPEST, bool)
            goes_on[at] = True
            padded = np.concatenate((stretch.key, np.zeros(DEEPEST, np.uint64)))
            words = [padded[at], padded[at + 1]]
            going = np.ones(len(at), bool)
            for d in range(2, DEEPEST):
                going = going & goes_on[at + d - 1]
                words.append(np.where(going, padded[at + d], np.uint64(0)))
            whole = mix(((words[0] * _STEP + words[1]) * _STEP + words[2]) * _STEP + words[3])
            order = np.argsort(whole, kind="stable")
            words, whole, counter = [w[order] for w in words], whole[order], counter[order]
            change = np.zeros(len(whole), bool)
            change[0] = True
            for w in words:
                change[1:] |= w[1:] != w[:-1]
            start = np.flatnonzero(change)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefixes.group(counter[start], whole[start])), *[pa.array(w[start].view(np.int64)) for w in words],
                 pa.array(np.diff(start, append=len(whole)))], _names(_SUFFIX))
    return cut


def subtree(suffixes: pa.Table, whole: bool = True) -> pa.Table:
    """The nodes of two words and more over a group's suffixes (w1 to w4, 0 behind the end; n) with their totals.

    Of a whole subtree only nodes of LEAST occurrences are returned; parts of a split one are all needed.
    """
    words = [suffixes.column(w).to_numpy() for w in WORDS]
    order = np.lexsort(words[::-1])
    words, n = [w[order] for w in words], suffixes.column("n").to_numpy()[order]
    change = np.zeros(len(n), bool)
    change[:1] = True
    out: list[list[np.ndarray]] = [[] for _ in range(DEEPEST + 1)]
    for depth, w in enumerate(words, 1):
        change[1:] |= w[1:] != w[:-1]
        if depth == 1:
            continue
        start = np.flatnonzero(change)
        total = np.add.reduceat(n, start) if len(start) else n
        kept = (w[start] != 0) & ((total >= LEAST) | (not whole))
        for k, other in enumerate(words):
            out[k].append(other[start[kept]] if k < depth else np.zeros(int(kept.sum()), np.int64))
        out[DEEPEST].append(total[kept])
    return pa.table(dict(zip([*WORDS, "n"], map(np.concatenate, out))))


def _subtrees(shared):
    def build(group: pa.Table) -> pa.Table:
        prefixes = shared.value
        at = np.searchsorted(prefixes.base, group.column("grp")[0].as_py(), side="right") - 1
        return subtree(group, bool(prefixes.parts[at] == 1))
    return build


def _word_at(k: int, shift):
    """The k-th word of a phrase's part that begins `shift` words in, 0 behind the phrase's end."""
    return F.coalesce(F.get(F.array(*WORDS), (shift + (k - 1)).cast("int")), F.lit(0).cast("long"))


def collocations(docs: DataFrame, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `best` phrases of two to four words of each language of `docs` (lang, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    first = checkpointed(docs.mapInArrow(_first_pass, _FIRST))
    words = checkpointed(first.filter("kind = 0").groupBy("key").agg(
        F.sum("n").alias("n"), F.min("word").alias("word"), F.min("lang").alias("lang"),
        (F.min(F.struct("lang", "word")) != F.max(F.struct("lang", "word"))).alias("mixed")))
    if not words.filter("mixed").isEmpty():
        raise ArithmeticError("two words share a 64-bit hash; change the hash")
    prefixes = Prefixes(first.filter("kind = 1").groupBy("key").applyInArrow(_add_slice, _GROUPS).collect())
    shared = spark.sparkContext.broadcast(prefixes)
    suffixes = docs.mapInArrow(_suffixes(shared), _SUFFIX)
    nodes = suffixes.groupBy("grp").applyInArrow(_subtrees(shared), _NODE)
    phrases = checkpointed(nodes.groupBy(*WORDS).agg(F.sum("n").alias("a")).filter(F.col("a") >= LEAST))
    return _scored(phrases, words, best)


def _scored(phrases: DataFrame, words: DataFrame, best: int) -> DataFrame:
    zero = F.lit(0).cast("long")
    single = words.filter(F.col("n") >= LEAST).select(
        F.col("key").alias("w1"), *[zero.alias(w) for w in WORDS[1:]], F.col("n").alias("a"))
    counts = phrases.union(single)
    size = F.lit(2) + (F.col("w3") != 0).cast("int") + (F.col("w4") != 0).cast("int")

    # Longer candidates with their parts; the most frequent one that holds a phrase decides.
    longer = phrases.filter("w3 != 0").withColumn("size", size)
    longer = longer.withColumn("part", F.explode(F.expr(
        "filter(array(struct(0 as at, 2 as n), struct(1 as at, 2 as n), struct(2 as at, 2 as n), struct(0 as at, 3 as n), struct(1 as at, 3 as n)),"
        " x -> x.n < size and x.at + x.n <= size)")))
    parts = longer.select(*[F.when(F.col("part.n") >= k, _word_at(k, F.col("part.at"))).otherwise(zero).alias(w)
                            for k, w in enumerate(WORDS, 1)], F.col("a").alias("longer"))
    parts = parts.groupBy(*WORDS).agg(F.max("longer").alias("longer"))
    kept = phrases.join(parts, WORDS, "left").filter(f"longer is null or longer < a / 100 * {INSIDE} and 100 * cast(longer as decimal(20)) < {INSIDE} * cast(a as decimal(20))")
    kept = kept.select(*WORDS, "a")

    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        *WORDS, "a", "k", *[F.when(F.col("k") >= i, F.col(w)).otherwise(zero).alias(f"f{i}") for i, w in enumerate(WORDS, 1)],
        *[_word_at(i, F.col("k")).alias(f"g{i}") if i < DEEPEST else zero.alias(f"g{i}") for i in range(1, DEEPEST + 1)])
    for side, name in (("f", "l"), ("g", "r")):
        counted = counts.select(*[F.col(w).alias(f"{side}{i}") for i, w in enumerate(WORDS, 1)], F.col("a").alias(name))
        cuts = cuts.join(counted, [f"{side}{i}" for i in range(1, DEEPEST + 1)])
    score = F.expr("cast(2000000 * cast(a as decimal(20)) as decimal(30)) div (cast(l as decimal(20)) + cast(r as decimal(20)))")
    low = cuts.withColumn("score", score).groupBy(*WORDS).agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("it"))

    # The words behind the hashes.
    spelled = low.select(*WORDS, F.posexplode(F.array(*WORDS)).alias("at", "key")).filter("key != 0").join(
        words.select("key", "word", "lang"), "key")
    spelled = spelled.groupBy(*WORDS).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"),
        F.first("lang").alias("lang"))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    out = low.join(spelled, WORDS).select(
        "lang", "phrase", "a", F.col("it.l").alias("l"), F.col("it.r").alias("r"), F.col("it.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= best)
    return out.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql() -> str:
    """The same in DuckDB SQL over `documents`."""
    return rf"""
with docs as (
  select coalesce(lang, '{NO_LANGUAGE}') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
pieces as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from docs),
lists as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as words from pieces),
total as (select lang, cast(sum(len(words)) as bigint) as n from lists group by lang),
grams as (
  select lang, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) as phrase, size
  from lists, (select unnest([1, 2, 3, 4]) as size) where len(words) >= size),
counts as (select lang, phrase, size, count(*) as a from grams group by lang, phrase, size having count(*) >= {LEAST}),
candidates as (select *, string_split(phrase, ' ') as words from counts where size > 1),
inner_parts as (
  select c.lang, array_to_string(c.words[s.at:s.at + s.n - 1], ' ') as phrase, c.a
  from candidates c, (select unnest([1, 2, 3, 1, 2]) as at, unnest([2, 2, 2, 3, 3]) as n) s where s.n < c.size and s.at + s.n - 1 <= c.size),
longer as (select lang, phrase, max(a) as longer from inner_parts group by lang, phrase),
kept as (
  select c.* from candidates c left join longer g using (lang, phrase)
  where g.longer is null or 100 * cast(g.longer as hugeint) < {INSIDE} * cast(c.a as hugeint)),
cuts as (
  select c.lang, c.phrase, c.a, k.k, f.a as l, g.a as r, (2000000 * cast(c.a as hugeint)) // (cast(f.a as hugeint) + g.a) as score
  from kept c join (select unnest([1, 2, 3]) as k) k on k.k < c.size
  join counts f on f.lang = c.lang and f.phrase = array_to_string(c.words[1:k.k], ' ')
  join counts g on g.lang = c.lang and g.phrase = array_to_string(c.words[k.k + 1:c.size], ' ')),
low as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from low)
join total using (lang) where rank <= {BEST}"""
