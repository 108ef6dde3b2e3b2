from __future__ import annotations

from collections import defaultdict

import numpy as np

from tests.llm import rows
from tidewatch.llm import suffixes


def brute(texts, size):
    held = defaultdict(set)
    words = {}
    for n, (i, t) in enumerate(texts):
        words[n] = (t or "").encode().split()
        for s in range(len(words[n]) - size + 1):
            held[tuple(words[n][s : s + size])].add((i, t))
    out = set()
    for n, (i, _) in enumerate(texts):
        span = None
        for s in range(len(words[n]) - size + 1):
            if len(held[tuple(words[n][s : s + size])]) > 1:
                if span and s <= span[1]:
                    span = (span[0], s + size)
                else:
                    if span:
                        out.add((i, *span))
                    span = (s, s + size)
        if span:
            out.add((i, *span))
    return sorted(out, key=str)


def found(spark, texts, size):
    got = suffixes.repeated_passages(rows.docs(spark, texts), passage=size)
    return sorted(set(rows.pairs(got, "id", "start", "end")), key=str)


def test_odd_texts(spark):
    texts = rows.odd_texts()
    got = found(spark, texts, 50)
    assert got == brute(texts, 50)
    assert any(i == 11 and e - s >= 70 for i, s, e in got)


def test_shared_passages_edits_and_shifts(spark):
    base = [rows.prose(300, 50 + i).split() for i in range(6)]
    texts = []
    for n in range(60):
        words = list(base[n % 6])
        for at in range(n, 300, 47 + n):
            words[at] = f"edit{n}"
        start = (7 * n) % 120
        texts.append((n, " ".join(words[start : start + 60 + 3 * n])))
    texts += [(100, "a " * 200), (101, "a " * 49), (102, "a " * 120), (103, "b c " * 80)]
    for size in (28, 50):
        assert found(spark, texts, size) == brute(texts, size)


def test_repeats_inside_one_document_are_its_own(spark):
    block = rows.prose(60, 9)
    assert found(spark, [(1, block + " " + block), (2, rows.prose(80, 10))], 50) == []
    assert found(spark, [(1, block), (1, block)], 50) == []


def test_empty(spark):
    assert found(spark, [], 50) == []


def test_each_passage_has_one_anchor_inside():
    text = suffixes.Rolling(rows.prose(2000, 3).encode())
    at, lo, hi = suffixes.anchors(text)
    assert lo[0] == 0 and hi[-1] == text.n - 50 and np.array_equal(lo[1:], hi[:-1] + 1)
    assert (at >= hi).all() and (at + suffixes.PREFIX <= lo + 50).all()
    assert len(at) < text.n / 10
