import random

import numpy as np
import pytest

from riskweave.llm import words as w
from riskweave.llm.align import banded_distance, common_subsequence, similar


def edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        line = [i]
        for j, y in enumerate(b, 1):
            line.append(min(last[j] + 1, line[-1] + 1, last[j - 1] + (x != y)))
        last = line
    return last[-1]


def subsequence(a, b):
    last = [0] * (len(b) + 1)
    for x in a:
        line = [0]
        for j, y in enumerate(b, 1):
            line.append(last[j - 1] + 1 if x == y else max(last[j], line[-1]))
        last = line
    return last[-1]


def test_alignment_equals_plain_dynamic_programming():
    r = random.Random(5)
    for _ in range(4000):
        k = r.choice((2, 3, 8, 30))
        a = [r.randrange(k) for _ in range(r.randrange(16))]
        b = [r.randrange(k) for _ in range(r.randrange(16))] if r.random() < 0.5 else a[:]
        for _ in range(r.randrange(4)):
            at = r.randrange(len(b) + 1)
            b[at : at + r.randrange(2)] = [r.randrange(k)] * r.randrange(3)
        true, limit = edits(a, b), r.randrange(18)
        assert banded_distance(a, b, limit) == (true if true <= limit else None)
        assert common_subsequence(a, b) == subsequence(a, b)
        longer = max(len(a), len(b), 1)
        got = similar(a, b, 0.8)
        assert (got is not None) == (true <= int(longer * 0.2 + 1e-9))
        assert got is None or got == pytest.approx(1 - true / longer)


def test_word_hashes_do_not_depend_on_grouping():
    texts = ["Some words, SOME", None, "", "été w2 日本", "!!", "x " * 10]
    together, offsets = w.hash_words(texts)
    assert np.diff(offsets).tolist() == [3, 0, 0, 3, 0, 10]
    alone = [w.hash_words([t])[0] for t in texts]
    assert (together == np.concatenate(alone)).all()
    assert together[0] != together[1] and together[0] == together[2]


def test_long_texts_are_cut_between_words():
    text = "alpha beta gamma " * (w.PIECE // 10)
    hashes, offsets = w.hash_words(["z", text, "z"])
    once = w.hash_words(["alpha beta gamma"])[0]
    assert offsets[-1] == len(hashes) == 2 + 3 * (w.PIECE // 10)
    assert (hashes[1:-1] == np.tile(once, w.PIECE // 10)).all()
    one_word = "y" * (w.PIECE + 7)
    assert w.hash_words([one_word])[0].tolist() == w.hash_words([f" {one_word} "])[0].tolist()


def test_shingles():
    h = w.hash_words(["a b c d e f a b c d e"])[0]
    s = w.combine(h, 5)
    assert len(s) == 7 and s[0] == s[6] and len(set(s.tolist())) == 6
    assert len(w.combine(h[:3], 5)) == 0
