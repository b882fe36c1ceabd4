"""Phrase subtrees against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import phrases

SCHEMA = "doc_id long, text string, lang string, n long, a long, w1 long, word string, key long, rank int, phrase string"


def docs(spark, rows):
    """Documents with further columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, lang, 1, 2, 3, "w", 4, 5, "p") for i, (t, lang) in enumerate(rows)], SCHEMA)


def word_lists(rows):
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            yield "und" if lang is None else lang, re.findall("[^ \t]+", piece)


def plain_counts(rows):
    count = Counter()
    for lang, words in word_lists(rows):
        for size in range(1, 5):
            for i in range(len(words) - size + 1):
                count[lang, tuple(words[i : i + size])] += 1
    return count


def plain_collocations(rows, best=2000):
    count = plain_counts(rows)
    total = Counter()
    for (lang, words), a in count.items():
        if len(words) == 1:
            total[lang] += a
    candidates = {x: a for x, a in count.items() if len(x[1]) > 1 and a >= 30}
    inside = {}
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                x = lang, words[i : i + size]
                inside[x] = max(inside.get(x, 0), a)
    found = []
    for (lang, words), a in candidates.items():
        if 100 * inside.get((lang, words), 0) >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (count[lang, words[:k]] + count[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        phrase = " ".join(words)
        found.append((lang, -score, -a, phrase.encode(), phrase, count[lang, words[:k]], count[lang, words[k:]]))
    out, rank = [], Counter()
    for lang, score, a, _, phrase, l, r in sorted(found):
        rank[lang] += 1
        if rank[lang] <= best:
            out.append((lang, rank[lang], phrase, -a, l, r, total[lang], -score))
    return out


def texts(r, n):
    words = ["The", "the", "of", "New", "york", "É", "é", "a-b", "naïve", "x"] + [f"w{i}" for i in range(30)]
    fixed = ["in the new york times", "one two three four five six", "é é é é é"]

    def text():
        parts = []
        for _ in range(r.randrange(1, 30)):
            parts.append(r.choice(fixed) if r.random() < 0.15 else words[min(int(r.expovariate(0.15)), len(words) - 1)])
            parts.append(r.choice([" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!?", "\x0b", " "]))
        return "".join(parts)
    return [(text(), r.choice(["en", "en", "en", "de", None])) for _ in range(n)]


def in_one_process(rows, parts=3):
    """Counts of phrases of two words and more by both passes, and of single words, without Spark."""
    batches = [pa.RecordBatch.from_pydict({"lang": ["und" if x is None else x for _, x in rows[k::parts]], "text": pa.array([t for t, _ in rows[k::parts]], pa.string())})
               for k in range(parts)]
    first = pa.Table.from_batches([x for b in batches for x in phrases._first_pass(iter([b]))])
    words, single, by_slice = {}, Counter(), {}
    for x in first.to_pylist():
        if x["kind"] == 0:
            words[x["key"]] = x["lang"], x["word"]
            single[x["lang"], (x["word"],)] += x["n"]
        else:
            by_slice.setdefault(x["key"], []).append(x)
    rows_of = [phrases._add_slice(pa.table({"key": [k] * len(v), "packed": pa.array([x["packed"] for x in v], pa.binary())})).to_pylist()[0]
               for k, v in by_slice.items()]

    class Row(dict):
        __getattr__ = dict.__getitem__
    prefixes = phrases.Prefixes([Row(x) for x in rows_of])

    class Shared:
        value = prefixes
    suffixes = pa.Table.from_batches([x for b in batches for x in phrases._suffixes(Shared)(iter([b]))])
    nodes, sizes = Counter(), []
    for g in np.unique(suffixes.column("grp").to_numpy()):
        group = suffixes.filter(pa.compute.equal(suffixes.column("grp"), g))
        sizes.append(sum(group.column("n").to_pylist()))
        for x in phrases._subtrees(Shared)(group).to_pylist():
            key = [words[x[w]] for w in phrases.WORDS if x[w]]
            nodes[key[0][0], tuple(w for _, w in key)] += x["n"]
    return {x: a for x, a in nodes.items() if a >= phrases.LEAST}, dict(single), prefixes, sizes


@pytest.mark.parametrize("least, budget, stretch, kept", [(5, 1 << 20, 1 << 20, 500_000), (3, 40, 50, 20), (8, 7, 5, 3)])
def test_counts_at_any_budget(monkeypatch, least, budget, stretch, kept):
    for name, value in (("LEAST", least), ("BUDGET", budget), ("STRETCH", stretch), ("KEPT", kept)):
        monkeypatch.setattr(phrases, name, value)
    rows = texts(random.Random(least), 300) + [(None, "en"), ("", "en"), ("...", None)]
    nodes, single, prefixes, sizes = in_one_process(rows)
    want = plain_counts(rows)
    assert single == {x: a for x, a in want.items() if len(x[1]) == 1}
    assert nodes == {x: a for x, a in want.items() if len(x[1]) > 1 and a >= least}
    if budget < 100:
        assert (prefixes.parts > 1).any() and len(sizes) > 20
        # A whole suffix that is more frequent than the budget can't be split; its task-wise sums can.
        assert np.median(sizes) <= 2 * budget + least


def test_pack():
    r = np.random.default_rng(3)
    counters = np.unique(r.integers(0, 1 << phrases.SLICE, 500))
    counts = r.integers(1, 1 << 30, len(counters))
    a, b = phrases.unpack(phrases.pack(counters, counts))
    assert (a == counters).all() and (b == counts).all()


def test_collocations(spark):
    rows = texts(random.Random(11), 900) + [(None, "en"), ("", "fr"), ("only once here", "fr"), ("zz yy " * 3000 + "é " * 200, "es")]
    want = plain_collocations(rows)
    assert len({x[0] for x in want}) == 4 and len(want) > 40
    cut = lambda df: sorted((x.lang, x["rank"], x.phrase, x.a, x.l, x.r, x.n, x.score) for x in df.collect())
    got = phrases.collocations(docs(spark, rows).repartition(5))
    assert cut(got) == sorted(want)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert cut(phrases.collocations(docs(spark, rows), best=7)) == sorted(plain_collocations(rows, 7))


def test_collocations_in_sql(spark):
    import duckdb
    rows = texts(random.Random(12), 500) + [(None, None)]
    con = duckdb.connect()
    documents = docs(spark, rows).select("text", "lang").toArrow()
    con.register("documents", documents)
    names = "lang, rank, phrase, a, l, r, n, score"
    assert sorted(con.sql(f"select {names} from ({phrases.collocations_sql()})").fetchall()) == sorted(plain_collocations(rows))


def test_ties_go_by_bytes(spark):
    rows = [(". ".join(f"{x} b{x}" for x in ("a", "é", "z", "Z1", "\U0001f600", "￮")), None)] * 31
    found = sorted(phrases.collocations(docs(spark, rows)).collect(), key=lambda x: x["rank"])
    assert [x.phrase for x in found] == ["a ba", "z bz", "z1 bz1", "é bé", "￮ b￮", "\U0001f600 b\U0001f600"]
    assert {(x.lang, x.a, x.score) for x in found} == {("und", 31, 1_000_000)}


def test_nothing_to_find(spark):
    for rows in ([], [(None, None)], [("a b c", "en")] * 29):
        assert phrases.collocations(docs(spark, rows)).count() == 0
