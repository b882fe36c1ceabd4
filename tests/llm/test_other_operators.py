"""Tokens, shards, neighbours, sampling and WARC records on small tables, against plain versions."""

import gzip
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import bpe, permutation, resample, shards, warc
from riskweave.llm.queries import vocabulary
from riskweave.llm.tables import table

CLASH = "key long, n int, v string, block int, rank int, x double"


def clashing(df):
    return df.select("*", *[F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in CLASH.split(", ")])


# Tokens

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary())


def test_bpe_equals_the_library(library):
    r = random.Random(5)
    parts = ["a", " ", "  ", "\n", "'s", "'LL", "'", "'re", "'ll", "'v", "''s", "é", "日本", "😀", "١٢", "½", "<|endoftext|>", "<|end",
             "\x85", "\x1c", "　", "​", "_", "aaaaaaa", "é", "\t", " x", "0123", "\0", "re"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(4000)]
    texts += ["", "a" * 5000, " " * 777, "<|endoftext|>", "x" * (bpe.STRETCH + 5)]
    own = bpe.Codec(vocabulary())
    for text, want, (ids, decimal, back) in zip(texts, library.encode_batch(texts, add_special_tokens=False), own.encode_texts(texts)):
        assert ids.tolist() == want.ids
        assert decimal.decode() == ",".join(map(str, want.ids))
        assert back.decode("utf-8", "replace") == library.decode(want.ids, skip_special_tokens=False)
    assert own.decode(own.encode("hello é <|endoftext|>")) == "hello é <|endoftext|>"


def test_a_hash_collision_is_noticed():
    own = bpe.Codec(vocabulary())
    ids = own.encode("word")
    own.known = {key: own.known[next(iter(own.known))] for key in own.known}
    real = bpe._hash_runs
    bpe._hash_runs = lambda codes, start, end: np.full(len(start), next(iter(own.known)), np.uint64)
    try:
        assert own.encode("word") == ids
        assert own.encode("another text") == bpe.Codec(vocabulary())._alone("another text")[0].tolist()
    finally:
        bpe._hash_runs = real


def test_bpe_tables(spark, library):
    texts = {1: "some text, some more", 2: None, 3: "", 4: "long " * 30_000}
    df = clashing(spark.createDataFrame([*texts.items(), (1, texts[1]), (None, "x")], "doc_id long, text string"))
    for x in bpe.digests(df, vocabulary()).collect():
        text = "x" if x.doc_id is None else texts[x.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert x.n_tokens == len(ids)
        assert x.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {x.doc_id: x.text for x in bpe.decoded(bpe.encoded(df, vocabulary()), vocabulary()).collect()}
    assert back == {i: t or "" for i, t in texts.items()} | {None: "x"}
    assert bpe.digests(df.filter("doc_id < 0"), vocabulary()).count() == 0


# Shards

def jump(key, n):
    key &= (1 << 64) - 1
    last, ahead = -1, 0
    while ahead < n:
        last = ahead
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        ahead = int((last + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return last


def test_jump_hash(spark):
    r = random.Random(6)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(r.randrange(-(2**63), 2**63) for _ in range(2000))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 50):
        assert [x.s for x in df.select(shards.jump_shard(F.col("k"), n).alias("s")).collect()] == [jump(k, n) for k in keys]


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(shards, "RANGE_ROWS", 40)
    rows = [(i, f"text {i} é") for i in range(300)] + [(7, "text 7 é")] * 50 + [(None, None)] * 3 + [(8, "y")] * 2 + [(500, "")]
    got = shards.assign(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert len(got) == len(rows)
    text = {}
    for i, t in rows:
        text.setdefault(i, []).append(t or "")
    for x in got:
        assert x.shard == jump(x.doc_id or 0, 8) and x.grown_shard == jump(x.doc_id or 0, 9) and x.law == "key"
        assert (x.size, x.text_crc32) in {(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in text[x.doc_id]}
        assert x.grown_shard in (x.shard, 8)
    for s in range(8):
        own = sorted((x for x in got if x.shard == s), key=lambda x: x.slot)
        assert [x.slot for x in own] == list(range(len(own)))
        order = [(x.doc_id is not None, x.doc_id or 0, x.text_crc32, x.size) for x in own]
        assert order == sorted(order)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = con.sql(shards.assign_sql()).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(x)) for x in got)
    assert shards.assign(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Neighbours

def brute(rows, queries, k=10):
    """rows: (vec_id, vector) that take part."""
    out = {}
    for q in sorted({i for i, _ in rows if queries(i)}):
        best = {}
        for i, v in rows:
            for j, w in rows:
                if j == q and i != q and len(v) == len(w):
                    far = float(np.sqrt(((np.asarray(v, float) - np.asarray(w, float)) ** 2).sum()))
                    best[i] = min(far, best.get(i, np.inf))
        out[q] = sorted((d, i) for i, d in best.items())[:k]
    return out


def test_neighbours_small_tables_are_exact(spark, monkeypatch):
    monkeypatch.setattr(permutation, "BLOCK", 30)
    monkeypatch.setattr(permutation, "ASKED", 3)
    r = np.random.default_rng(7)
    rows = [(i, r.standard_normal(6).tolist()) for i in range(150)]
    same = r.standard_normal(6).tolist()
    rows += [(i, same) for i in range(200, 420)] + [(7, rows[7][1])] * 2 + [(500, [1.0, 2.0]), (501, [1.0, 2.5]), (600, [9.0])]
    bad = [(700, None), (800, [0.0] * 6), (801, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (900, [float("nan")] + [1.0] * 5), (901, [float("inf")] + [1.0] * 5),
           (None, same)]
    df = clashing(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>"))
    got = {}
    for x in permutation.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.score, x.vec_id))
        assert x.rank == len(got[x.query_id])
    want = {q: v for q, v in brute(rows, lambda i: i % 100 == 0).items() if v}
    assert set(got) == set(want)
    for q, found in want.items():
        assert [i for _, i in got[q]] == [i for _, i in found]
        assert [d for d, _ in got[q]] == pytest.approx([d for d, _ in found])
    assert permutation.nearest(df.filter("vec_id is null"), F.col("vec_id") % 100 == 0).count() == 0
    assert permutation.nearest(df.filter("vec_id = 1"), F.col("vec_id") % 100 == 0).count() == 0


def test_neighbour_recall(spark, data_dir):
    vectors = table(spark, data_dir, "embeddings")
    rows = [(x.vec_id, x.embedding) for x in vectors.collect()]
    ids, matrix = np.asarray([i for i, _ in rows]), np.asarray([v for _, v in rows], float)
    got = {}
    for x in permutation.nearest(vectors, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    hit = 0
    for q in got:
        far = np.sqrt(((matrix - matrix[ids == q][0]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        hit += len(got[q] & set(ids[np.lexsort((ids, far))[:10]].tolist()))
    assert hit >= 0.9 * 10 * len(got)


# Sampling

def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr(resample, "LAST_ROWS", 20)
    r = random.Random(8)
    values = [r.gauss(0, 1) * 10 ** r.randrange(4) for _ in range(3000)] + [5.0] * 500 + [None] * 9
    df = spark.createDataFrame([(x,) for x in values], "x double").select(F.col("x").alias("key"))
    order = sorted((x for x in values if x is not None), reverse=True)
    for k in (1, 2, 700, 1500, 3499, 3500):
        assert resample.kth_largest(df, "key", k) == order[k - 1]
    assert resample.kth_largest(df, "key", 3501) is None and resample.kth_largest(df, "key", 0) is None


def test_weights_equal_a_plain_model(spark):
    r = random.Random(9)
    good = [" ".join(r.choice("fine good word text.".split()) for _ in range(20)) for _ in range(40)]
    junk = [" ".join(r.choice("### | $$$ %%% x1".split()) for _ in range(20)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(good + junk)] + [(90, None), (91, " \n"), (5, good[5]), (None, good[0])]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(0, 60, 2)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = resample.sample(clashing(spark.createDataFrame(rows, "doc_id long, text string")), labels).collect()
    assert len(got) == len(rows)

    from riskweave.llm.words import hash_words

    def grams(text):
        h = [int(x) for x in hash_words([text], marks=True)[0]]
        return h, [(a, b) for a, b in zip(h, h[1:])]
    from collections import Counter
    raw, target = Counter(), Counter()
    for i, t in rows:
        if t:
            one, two = grams(t)
            raw.update(one + two)
            if i is not None and i % 2 == 0 and i < 40:
                target.update(one + two)
    # Without bucket collisions the buckets are the n-grams; the empty ones share the smoothing.
    n_raw, n_target = sum(raw.values()) + resample.BUCKETS, sum(target.values())
    for x in got:
        text = next(t for i, t in rows if i == x.doc_id)
        if not text or not text.strip():
            assert x.n_grams == 0 and x.log_weight is None and not x.selected
            continue
        one, two = grams(text)
        want = sum(np.log(0.9 * target[g] / n_target + 0.1 * (raw[g] + 1) / n_raw) - np.log((raw[g] + 1) / n_raw) for g in one + two)
        assert x.n_grams == len(one + two) and x.log_weight == pytest.approx(want, rel=1e-6, abs=1e-6)
    chosen = [x for x in got if x.selected]
    k = round(62 * 20 / 30)
    assert len(chosen) >= k
    keys = sorted((x.key for x in got if x.key is not None), reverse=True)
    assert all(x.selected == (x.key is not None and x.key >= keys[k - 1]) for x in got)
    every = resample.sample(spark.createDataFrame(rows, "doc_id long, text string"), labels.filter("doc_id < 0")).collect()
    assert sum(x.selected for x in every) == 62
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.sample(none, labels).count() == 0


def test_sample_separates_labelled_rows(spark, data_dir):
    labels = table(spark, data_dir, "labels")
    found = resample.sample(table(spark, data_dir, "documents"), labels).join(labels, "doc_id")
    rows = [(x.log_weight, x.quality) for x in found.collect() if x.log_weight is not None]
    good, bad = [w for w, q in rows if q == 1], [w for w, q in rows if q == 0]
    ordered = sum((a > b) + 0.5 * (a == b) for a in good for b in bad)
    assert ordered / (len(good) * len(bad)) > 0.95


# WARC

def test_plain_text():
    html = ("<!DOCTYPE html><html lang=\"en\"><title>T &amp; t</title><style>p{}</style><script>var a='</p>';</script>"
            "<!-- x --><p>One &lt;b&gt; two<br>three <b>bo</b>ld</p><a href='/x?a=1&amp;b=2' title=\"a>b\">link</a> 1 < 2"
            "<div>four<template><p>no</p></template></div><!-- open <p>lost</p>")
    text, title, language, links = warc.plain_text(html)
    assert text == "One <b> two\nthree bold\nlink 1 < 2\nfour"
    assert (title, language, links) == ("T & t", "en", ["/x?a=1&b=2"])
    assert warc.plain_text("") == ("", "", "", [])
    assert warc.plain_text("<p title='" + "<" * 20_000)[0].count("<") > 10_000


def test_warc_records(spark, tmp_path):
    pages = [(1, "http://a.example/d/p", "<html lang=fr><title>A</title><a href='../q'>x</a><p>é text</p>"), (2, None, "plain"), (3, "http://b.example", None),
             (None, "http://c.example", ""), (1, "http://a.example/d/p", "<html lang=fr><title>A</title><a href='../q'>x</a><p>é text</p>")]
    df = clashing(spark.createDataFrame(pages, "page_id long, url string, html string"))
    rows = warc.derivatives(warc.responses(df)).collect()
    assert len(rows) == 2 * len(pages)
    for x in rows:
        url, html = next((u, h) for i, u, h in pages if i == x.page_id)
        payload = (html or "").encode()
        assert x.source_payload_digest == warc.digest(payload)
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        assert x.source_block_digest == warc.digest(head + payload)
        assert x.block_digest == warc.digest(x.block.encode()) and x.content_length == len(x.block.encode())
        fields = dict(line.split(": ", 1) for line in x.header.split("\r\n")[1:])
        assert fields["WARC-Type"] == x.record_type and fields["WARC-Refers-To"] == x.refers_to and fields["WARC-Record-ID"] == x.record_id
        assert fields.get("WARC-Target-URI") == url
        twin = next(y for y in rows if y.refers_to == x.refers_to and y.record_type != x.record_type)
        assert fields["WARC-Concurrent-To"] == twin.record_id
        if x.record_type == "conversion":
            assert x.block == warc.plain_text(html or "")[0]
        else:
            assert f"source-payload-digest: {x.source_payload_digest}" in x.block and "source-http-Content-Type: text/html" in x.block
    one = next(x for x in rows if x.page_id == 1 and x.record_type == "metadata")
    assert "outlink: http://a.example/q\r\n" in one.block and "language: fr\r\n" in one.block
    warc.write(warc.derivatives(warc.responses(df)).coalesce(1), str(tmp_path / "out"))
    data = b"".join(gzip.open(p).read() for p in (tmp_path / "out").glob("*.gz"))
    count = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
        data, count = rest[size + 4 :], count + 1
    assert count == len(rows)
    assert warc.derivatives(warc.responses(df.filter("page_id < 0"))).count() == 0
