"""Language identification by rank-order profiles of character n-grams.

Training counts the 1- to 3-grams of the labelled texts per language and keeps each language's most frequent
ones, in order. A text is described the same way and goes to the language with the smallest out-of-place
distance: the sum of rank differences, where an n-gram that the profile lacks costs the whole profile length.

Defined results: a text that is null or has no letter gets `und` with score 0, and so does every text when no
labelled text exists. Equally frequent n-grams are ordered by code points, equally near languages by name.
Texts are used whole, at any length. Only the text column is read for a prediction; further columns of the
input, whatever their names, are ignored. Repeated rows get the same answer each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from riskweave.llm.tables import held_out
from riskweave.llm.words import codepoints, letters, marks

PROFILE = 400  # n-grams of a profile
MOST_LANGUAGES = 10_000  # languages have names, not rows: a table with more labels is refused
GROUP = 1 << 17  # code points of short texts handled at once
UNKNOWN = "und"
_SPACE = np.uint32(32)


def _letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased letters; everything between two words is one space, also at the ends.

    Combining marks go with letters; where there are only marks, nothing is left.
    """
    codes = codepoints(f" {text.lower()} ")
    kept = letters()[codes]
    if marks()[codes[kept]].all():
        return codes[:1]
    edge = np.empty(len(kept), bool)
    edge[0] = True
    edge[1:] = kept[:-1]
    codes = np.where(kept, codes, _SPACE)
    return codes[kept | edge]


def _groups(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(letters, length of each text's letters) for runs of texts."""
    parts, sizes, total = [], [], 0
    for text in texts:
        part = _letters_only(text or "")
        parts.append(part)
        sizes.append(len(part))
        total += len(part)
        if total > GROUP:
            yield np.concatenate(parts), np.asarray(sizes)
            parts, sizes, total = [], [], 0
    if parts:
        yield np.concatenate(parts), np.asarray(sizes)


def _grams(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, n-gram) with counts, sorted by owner and n-gram: owners, n-grams, counts, index.

    An n-gram is three code points in one integer, with zeros behind a shorter one. No n-gram has a space
    inside, so neighbouring texts cannot mix.
    """
    present = np.zeros(0x110000, bool)
    present[codes] = True
    alphabet = np.concatenate(([0], np.flatnonzero(present))).astype(np.int64)
    dense = np.zeros(0x110000, np.int32)
    dense[alphabet] = np.arange(len(alphabet))
    s = dense[codes].astype(np.int64)
    inner = np.flatnonzero(codes != _SPACE)
    if not len(inner):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    base = len(alphabet)
    before, here, after, who = s[inner - 1], s[inner], s[inner + 1], owner[inner] * base**3
    last = codes[inner + 1] == _SPACE
    keys = np.concatenate((
        who + here * base * base,
        who + before * base * base + here * base,
        (who + here * base * base + after * base)[last],
        who + (before * base + here) * base + after,
    ))
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(first, append=len(keys))
    keys = keys[first]
    owners, gram = np.divmod(keys, base**3)
    a, rest = np.divmod(gram, base * base)
    b, c = np.divmod(rest, base)
    return owners, alphabet[a] << 42 | alphabet[b] << 21 | alphabet[c], counts, keys


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the texts that this task reads."""
    names: dict[str, int] = {}
    held: list[np.ndarray] = []
    total = 0

    def merged() -> np.ndarray:
        every = np.concatenate(held, axis=1)
        order = np.lexsort((every[1], every[0]))
        every = every[:, order]
        first = np.flatnonzero(np.concatenate((
            [True], (every[0, 1:] != every[0, :-1]) | (every[1, 1:] != every[1, :-1]))))
        return np.vstack((every[0, first], every[1, first], np.add.reduceat(every[2], first)))

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        at = 0
        for codes, sizes in _groups(batch.column("text").to_pylist()):
            label = np.asarray([names.setdefault(x, len(names)) for x in langs[at : at + len(sizes)]], np.int64)
            at += len(sizes)
            owners, grams, counts, _ = _grams(codes, np.repeat(label, sizes))
            held.append(np.vstack((owners, grams, counts)))
            total += len(owners)
            if total > 1_000_000:
                held = [merged()]
                total = held[0].shape[1]
                if total > 500_000:  # a wide alphabet: pass on and start again
                    yield _rows(held[0], list(names))
                    held, total = [], 0
    if held:
        yield _rows(merged(), list(names))


def _rows(found: np.ndarray, names: list[str]) -> pa.RecordBatch:
    lang = pa.DictionaryArray.from_arrays(pa.array(found[0], pa.int32()), pa.array(names, pa.string()))
    return pa.RecordBatch.from_arrays(
        [lang.cast(pa.string()), pa.array(found[1]), pa.array(found[2])], ["lang", "gram", "n"])


def profiles(labelled: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, gram, rank from 0) of each language's most frequent n-grams in `labelled` (text, lang)."""
    counted = labelled.filter("text is not null and lang is not null").select("text", "lang").mapInArrow(
        _count, "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return totals.withColumn("rank", F.row_number().over(best) - 1).filter(F.col("rank") < size).select(
        "lang", "gram", "rank")


def gathered(profile: DataFrame, size: int = PROFILE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Profiles as (languages, sorted n-grams, matrix of ranks): at most `size` rows a language."""
    rows = profile.limit(MOST_LANGUAGES * size + 1).toArrow()
    langs = sorted(set(rows.column("lang").to_pylist()))
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages are labelled")
    place = {x: i for i, x in enumerate(langs)}
    gram = rows.column("gram").to_numpy()
    grams = np.unique(gram)
    ranks = np.full((len(grams), len(langs)), -1, np.int32)
    ranks[np.searchsorted(grams, gram), [place[x] for x in rows.column("lang").to_pylist()]] = rows.column("rank").to_numpy()
    return langs, grams, ranks


def _distances(codes: np.ndarray, sizes: np.ndarray, grams: np.ndarray, ranks: np.ndarray, size: int):
    """(distance to each language, n-grams compared) of each text of a group."""
    owners, found, counts, _ = _grams(codes, np.repeat(np.arange(len(sizes)), sizes))
    n = np.bincount(owners, minlength=len(sizes))
    start = np.cumsum(n) - n
    # By text, then most frequent first, then code points, which is the order they have now.
    shift = max(1, int(len(owners)).bit_length())
    most = int(counts.max(initial=0)) + 1
    order = np.sort((owners * most + (most - 1 - counts) << shift) | np.arange(len(owners))) & ((1 << shift) - 1)
    rank = np.arange(len(owners)) - start[owners]
    keep = rank < size
    order, rank, owners = order[keep], rank[keep], owners[keep]
    used = np.minimum(n, size)
    found = found[order]
    at = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
    known = grams[at] == found
    out = np.zeros((len(sizes), ranks.shape[1]), np.int64)
    step = max(1, 2_000_000 // ranks.shape[1])
    for lo in range(0, len(found), step):
        part = slice(lo, lo + step)
        profile = ranks[at[part]]
        cost = np.where((profile >= 0) & known[part, None], np.abs(profile - rank[part, None]), size)
        first = np.flatnonzero(np.concatenate(([True], owners[part][1:] != owners[part][:-1])))
        np.add.at(out, owners[part][first], np.add.reduceat(cost, first, axis=0))
    return out, used


def predict(docs: DataFrame, profile: DataFrame, size: int = PROFILE, carried: str | None = None) -> DataFrame:
    """`docs` (doc_id, text, held_out) as (doc_id, held_out, lang_pred, score, distance), and the column `carried` as it is.

    distance is the mean out-of-place cost of the best language as a share of the profile length, 0 to 1;
    score is how much nearer the best language is than the next one, 0 to 1 (with one language: 1 - distance).
    """
    langs, grams, ranks = gathered(profile, size)
    schema = StructType.fromDDL("doc_id long, held_out boolean, lang_pred string, score double, distance double")
    further = [carried] if carried else []
    for name in further:
        schema = schema.add(docs.schema[name])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[str] = []
            score: list[np.ndarray] = []
            near: list[np.ndarray] = []
            for codes, sizes in _groups(batch.column("text").to_pylist()):
                if not langs:
                    names += [UNKNOWN] * len(sizes)
                    score.append(np.zeros(len(sizes)))
                    near.append(np.ones(len(sizes)))
                    continue
                cost, used = _distances(codes, sizes, grams, ranks, size)
                best = cost.argmin(axis=1)
                share = cost / np.maximum(used * size, 1)[:, None]
                ordered = np.sort(share, axis=1)
                second = ordered[:, 1] if len(langs) > 1 else np.ones(len(sizes))
                blank = used == 0
                names += [UNKNOWN if b else langs[i] for b, i in zip(blank, best)]
                score.append(np.where(blank, 0.0, 1 - ordered[:, 0] / np.maximum(second, 1e-12)))
                near.append(np.where(blank, 1.0, ordered[:, 0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(np.concatenate(score or [np.zeros(0)])), pa.array(np.concatenate(near or [np.zeros(0)])),
                 *[batch.column(x) for x in further]],
                ["doc_id", "held_out", "lang_pred", "score", "distance", *further])

    return docs.select(F.col("doc_id").cast("long"), "text", "held_out", *further).mapInArrow(label, schema)


def identify(docs: DataFrame, size: int = PROFILE, row: bool = False) -> DataFrame:
    """Languages of all `docs` (doc_id, text, lang), learned from those that are labelled and not held out.

    With `row`, the whole row of `docs` comes along as a struct of that name.
    """
    split = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"), *([F.struct("*").alias("row")] if row else []))
    return predict(split, profiles(split.filter(~F.col("held_out")), size), size, "row" if row else None)
