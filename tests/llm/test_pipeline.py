"""The pipeline against a plain version of its decisions, on a copy of the tables with planted cases."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from riskweave.llm import secrets
from riskweave.llm.components import components
from riskweave.llm.queries import vocabulary
from riskweave.llm.tables import table


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1090)] + [(7, 7), (None, 3)]
    links += [(2000, 2001 + i) for i in range(300)] + links[:20]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = {x.node: x.label for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark, data_dir, tmp_path):
    documents, benchmark = table(spark, data_dir, "documents"), table(spark, data_dir, "benchmark")
    rows = [tuple(x) for x in documents.collect()]
    item = benchmark.first().text
    clean = next(x for x in rows if x[2] == "en" and len(x[1]) > 1500)
    edited = clean[1].split(" ")
    edited[20:21], edited[90] = ["quite", "other"], "words"
    backwards = lambda text: " ".join(reversed(text.split()[:200]))
    key = "Zx9Kq2Lm8Wt4Rb7Yc1Vn5"
    planted = [(90_001, clean[1], "en", "p", 1), (90_002, " ".join(edited), "en", "p", 1), (90_003, f"{rows[3][1][:900]}\n{item}\nend", "en", "p", 1),
               (90_004, "12345 !!! ###", "en", "p", 13), (90_005, None, None, None, None), (90_006, "", "en", "p", 0),
               (None, f"The and of to with this key {key} of the and that", "en", "p", 1),
               # Rows without an id and ids with several texts are decided about row by row.
               (None, "12345 ###", "en", "p", 9), (None, f"{rows[5][1][:700]} {item}", "en", "p", 1), (None, clean[1], "en", "p", 1),
               (90_010, "999 000 ---", "en", "p", 1), (90_010, backwards(rows[7][1]), "en", "p", 1),
               (90_011, backwards(clean[1]), "en", "p", 1), (90_011, backwards(f"{item} {rows[9][1]}"), "en", "p", 1)]
    folder = tmp_path / "tables"
    spark.createDataFrame(rows + planted, documents.schema).write.parquet(str(folder / "documents.parquet"))
    benchmark.write.parquet(str(folder / "benchmark.parquet"))

    docs = spark.read.parquet(str(folder / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(x) for x in docs.collect()]
        stage(spark, docs, str(folder)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == documents.columns
        after = [tuple(x) for x in docs.collect()]
        gone = Counter(before) - Counter(after)
        ids = {x[0] for x in after}
        if name == "language":
            assert {(x[0], x[1]) for x in gone} == {(90_004, "12345 !!! ###"), (90_005, None), (90_006, ""), (None, "12345 ###"), (90_010, "999 000 ---")}
        elif name == "near_copies":
            assert {90_001, 90_002}.isdisjoint(ids) and clean in after and (None, clean[1], "en", "p", 1) not in after

            def plain(text):
                return " ".join(re.findall(r"[^\W_]+", text.lower()))
            assert len({plain(x[1]) for x in after}) == len(after)
            assert [x[0] for x in after].count(90_011) == 2 and [x[0] for x in after].count(90_010) == 1 and None in ids
        elif name == "benchmark_leaks":
            items = [" ".join(re.findall(r"[^\W_]+", x.text.lower())) for x in benchmark.collect()]
            leaked = {x for x in before if any(f" {y} " in f" {' '.join(re.findall(r'[^\W_]+', x[1].lower()))} " for y in items)}
            assert set(gone) == leaked and 90_003 in {x[0] for x in leaked} and None in {x[0] for x in leaked} and None in ids
        else:
            assert Counter(x[0] for x in before) == Counter(x[0] for x in after)
            for x in after:
                assert len(x[1]) == x[4] or x in before
                assert not re.search(secrets.HEX, x[1]) and key not in x[1]
            assert any("[SECRET]" in x[1] for x in after)
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary())
    want = Counter((x.doc_id, hashlib.sha256(",".join(map(str, library.encode(x.text, add_special_tokens=False).ids)).encode()).hexdigest())
                   for x in docs.collect())
    assert Counter((x.doc_id, x.ids_sha256) for x in corpus_pipeline.run(spark, str(folder)).collect()) == want
