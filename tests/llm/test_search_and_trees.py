"""Segment-tree BPE against its library, best-position search against plain scoring."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from riskweave.llm import bestpos, treebpe
from riskweave.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, n long, terms string, item int, lane int, rank string, score string, key string"


def docs(spark, rows):
    """Documents with further columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, 7, "x", 1, 2, "w", "s", "k") for i, t in rows], SCHEMA)


# Segment-tree BPE

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    own = treebpe.codec(vocabulary("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_lowest_pair():
    r = random.Random(5)
    for size in (0, 1, 2, 3, 8, 13):
        ranks = [r.choice([None, 0, 1, 5, 5, 9]) for _ in range(size)]
        tree = treebpe.LowestPair(ranks)
        for _ in range(60):
            known = [(x, i) for i, x in enumerate(ranks) if x is not None]
            assert tree.leftmost() == (min(known)[1] if known else None)
            if size:
                at = r.randrange(size)
                ranks[at] = r.choice([None, 0, 3, 5, 9])
                tree.set(at, ranks[at])


def test_tree_codec_equals_library(library):
    r = random.Random(6)
    own = treebpe.TreeCodec(vocabulary("byte_bpe_multi_50k.tiktoken"))
    pool = "abcdeéñ '’sTllrmd1239٣\n\t \r \x1c\x0b 语言😀́.,!?-\0<|endoftext|>"
    texts = ["".join(r.choice(pool) for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += ["", None, "a" * 3000, "ab" * 2000 + "c", "é" * 2500, " " * 900, "\n\n  x", "we'll I've 's don't", "".join(r.choice("abcdefgh") for _ in range(70_000))]
    texts += [x + y for x in ("z", " ", "1") for y in map(chr, range(0, 0x3000, 7))]
    for text, (ids, decimal, back) in zip(texts, own.encode_texts(texts)):
        want = library.encode_ordinary(text or "")
        assert ids.tolist() == want and decimal.decode() == ",".join(map(str, want)) and back == (text or "").encode()
        assert own.decode(want) == back


def test_tree_codec_forgets_and_survives_collisions(library, monkeypatch):
    texts = [f"word{i} and {i * 7919} more" for i in range(400)]
    want = [library.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(treebpe, "KEPT_MATCHES", 50)
    own = treebpe.TreeCodec(vocabulary("byte_bpe_multi_50k.tiktoken"))
    assert [own.encode(t) for t in texts] == want
    monkeypatch.setattr(treebpe, "_hash_runs", lambda codes, start, end: np.zeros(len(start), np.uint64))
    assert [own.encode(t) for t in texts] == want


def test_tree_digests(spark, library, data_dir):
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    rows = [(1, "Hello wörld"), (1, "Hello wörld"), (2, None), (3, ""), (None, "x"), (4, "ab " * 200_000)]
    given = docs(spark, rows)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    want = sorted((str(i), len(ids := library.encode_ordinary(t or "")), digest(",".join(map(str, ids)).encode()), digest((t or "").encode())) for i, t in rows)
    assert sorted((str(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in treebpe.digests(given, path).collect()) == want
    tokens = treebpe.encoded(given, path)
    assert sorted((str(x.doc_id), x.ids) for x in tokens.collect()) == sorted((str(i), library.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((str(x.doc_id), bytes(x.bytes)) for x in treebpe.decoded(tokens, path).collect()) == sorted((str(i), (t or "").encode()) for i, t in rows)
    assert treebpe.digests(docs(spark, []), path).count() == 0


# Best-position search

def terms(text):
    return [re.sub("[A-Z]", lambda x: x[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_rank(documents, items):
    cut = [(i, terms(t)) for i, t in documents]
    cut = [(i, t) for i, t in cut if t]
    n, length = len(cut), sum(len(t) for _, t in cut)
    df = {}
    for _, t in cut:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in sorted({x for x in items if None not in x}):
        scores = []
        for doc, own in cut:
            m, score = 75 + 25 * len(own) * n // length, 0
            for x in terms(text):
                if x in own:
                    tf = own.count(x)
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:20])]
    return out


def test_hash_terms():
    texts = ["The the THE; É é x1_y2", None, "", "...", "a\x7fb\x80c", "ÀB", "w " * 5]
    row, hashes = bestpos.hash_terms(texts)
    flat = [(i, t) for i, x in enumerate(texts) for t in terms(x)]
    assert row.tolist() == [i for i, _ in flat]
    named = {}
    for (_, t), h in zip(flat, hashes.tolist()):
        assert named.setdefault(t, h) == h
    assert len(set(named.values())) == len(named)


def test_hash_terms_of_long_texts(monkeypatch):
    texts = ["ab, cd. " * 50 + "x" * 300, "short"]
    want = [x.tolist() for x in bestpos.hash_terms(texts)]
    monkeypatch.setattr(bestpos, "PIECE", 7)
    assert [x.tolist() for x in bestpos.hash_terms(texts)] == want


def test_best_positions_stop_early_and_miss_nothing():
    r = np.random.default_rng(8)
    for case in range(30):
        n, t = 3000, 6
        held = [np.sort(r.choice(n, r.integers(1, n), replace=False)) for _ in range(t)]
        doc, term = np.concatenate(held), np.repeat(np.arange(t), [len(x) for x in held])
        impact = r.integers(1, 4 if case % 3 == 0 else 100_000, len(doc)) ** (1 if case % 2 else 2)
        order = np.argsort(doc, kind="stable")
        lists = bestpos.ImpactLists(term[order], doc[order], impact[order], t)
        weights = r.integers(0, 50, t)
        total = np.bincount(doc, impact * weights[term], n).astype(np.int64)
        docs_, scores = bestpos.best_positions(lists, np.arange(t), weights, n, step=4)
        assert (total[docs_] == scores).all() and len(set(docs_.tolist())) == len(docs_)
        kth = np.sort(total)[-20]
        assert set(np.flatnonzero((total >= kth) & (total > 0))) <= set(docs_.tolist())
    # One document ahead in every list: the threshold falls behind it at once.
    doc = np.tile(np.arange(50_000), 3)
    impact = np.concatenate([np.where(np.arange(50_000) < 40, 1_000_000 - np.arange(50_000), 1)] * 3)
    order = np.argsort(doc, kind="stable")
    lists = bestpos.ImpactLists(np.repeat(np.arange(3), 50_000)[order], doc[order], impact[order], 3)
    scored, direct = [], lists.direct
    lists.direct = lambda t, d: (scored.append(len(d)), direct(t, d))[1]
    bestpos.best_positions(lists, np.arange(3), np.ones(3), 50_000)
    assert sum(scored) < 1000


def test_rank_equals_plain_scores(spark, monkeypatch):
    r = random.Random(9)
    words = [f"w{i}" for i in range(60)] + ["Éa", "x_y", "THE", "the"]
    text = lambda n: " ".join(words[min(int(r.expovariate(0.1)), len(words) - 1)] for _ in range(n))
    rows = [(i, text(r.randrange(1, 80))) for i in range(400)]
    rows += [(900 + i, "same words again the w1 w2 w3") for i in range(30)] + [(1000, None), (1001, ""), (1002, "?!"), (None, "w1 w50 w51 w52"), (None, "w1 w50"),
             (5, "w50 w51 w52 w53"), (5, "w50 w51 w52 w53"), (1003, "w3 w40 " * 20_000)]
    items = [(i, text(r.randrange(1, 15))) for i in range(12)] + [(20, None), (21, ""), (22, "unknown terms"), (None, "w1"), (23, "w1 w2 same"),
                                                                  (23, "w1 w2 same"), (24, "w1 w2 same"), (25, "w50"), (25, "w51 w51 w1"), (26, "the " * 40)]
    asked = spark.createDataFrame([(i, t, 1, "r") for i, t in items], "item_id long, text string, rank int, key string")
    want = sorted(plain_rank(rows, items), key=str)
    cut = lambda df: sorted(((x.item_id, x["rank"], x.doc_id, x.score) for x in df.collect()), key=str)
    assert cut(bestpos.rank(docs(spark, rows).repartition(3), asked)) == want
    monkeypatch.setattr(bestpos, "BLOCK_ITEMS", 5)
    assert cut(bestpos.rank(docs(spark, rows), asked)) == want


def test_rank_in_many_blocks_of_documents():
    r = random.Random(10)
    rows = [(i, " ".join(f"w{min(int(r.expovariate(0.1)), 40)}" for _ in range(r.randrange(1, 40)))) for i in range(500)]
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]})
    item = "w0 w3 w20 w33"
    _, hashes = bestpos.hash_terms([item])
    vocabulary, number = np.unique(hashes, return_inverse=True)
    coded = [x for x in bestpos._code(vocabulary)(iter([batch]))]
    coded = [x.slice(lo, 50) for x in coded for lo in range(0, len(x), 50)]
    (counts,) = bestpos._frequencies(len(vocabulary))(iter(coded))
    total = dict(zip(counts.column("term").to_pylist(), counts.column("n").to_pylist()))
    weight = np.asarray([math.floor(1000 * math.log((2 * total[-1] + 2) / (2 * total[t] + 1))) for t in range(4)])
    own, repeats = np.unique(number, return_counts=True)
    old = bestpos.BLOCK_POSTINGS
    bestpos.BLOCK_POSTINGS = 60
    try:
        (found,) = bestpos._search([(own, weight[own] * repeats)], 4, total[-1], total[-2])(iter(coded))
    finally:
        bestpos.BLOCK_POSTINGS = old
    assert list(zip(found.column("doc_id").to_pylist(), found.column("score").to_pylist())) == [(d, s) for _, _, d, s in plain_rank(rows, [(1, item)])]


def test_rank_without_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert bestpos.rank(docs(spark, []), some).count() == 0
    assert bestpos.rank(docs(spark, [(1, "w1")]), none).count() == 0
    assert bestpos.rank(docs(spark, [(1, None)]), some).count() == 0
    assert [x.doc_id for x in bestpos.rank(docs(spark, [(1, "w1")]), some).collect()] == [1]
