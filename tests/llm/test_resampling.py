from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import rows
from tidewatch.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in found]


def brute(texts, target, percent=25, min_words=20, seed=7):
    """Rows (id, features, weight, score, rank) by the rule as it is written; no id comes last."""
    source = Counter(b for _, t in texts for b in features(t)[1])
    wanted = Counter(b for t in target for b in features(t)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((source[b] + 1) * (t + 10_000)))) for b in range(10_000)}
    scored = []
    for i, text in texts:
        n_words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    out = [(r[0], *r[2:], n + 1 if n < percent * len(able) // 100 else None) for n, r in enumerate(able)]
    return sorted(out + [(r[0], *r[2:], None) for r in scored if r[1] < min_words], key=str)


def got(spark, texts, target, **how):
    items = spark.createDataFrame([(n, t) for n, t in enumerate(target)], "item_id long, text string")
    return rows.pairs(resampling.drawn(rows.docs(spark, texts), items, **how), "id", "n_features", "weight", "score", "rank")


TARGET = [rows.prose(40, 500), None, "", rows.prose(60, 501).upper()]


@pytest.mark.parametrize("how", [{}, {"accuracy": 2}, {"percent": 100}, {"percent": 0}, {"min_words": 0, "seed": 3}])
def test_against_brute_force(spark, how):
    texts = [(i, rows.prose(10 + i % 60, 500 + i % 20)) for i in range(150)] + rows.odd_texts()
    expected = brute(texts, TARGET, **{k: v for k, v in how.items() if k != "accuracy"})
    assert got(spark, texts, TARGET, **how) == expected


def test_rows_of_one_id_and_one_score(spark):
    texts = [(5, rows.prose(30, 1))] * 60 + [(None, rows.prose(30, 1))] * 20 + [(i, rows.prose(30, 1)) for i in range(100, 140)]
    assert got(spark, texts, TARGET, percent=55) == brute(texts, TARGET, percent=55)


def test_empty_tables(spark):
    texts = [(i, rows.prose(25, i)) for i in range(12)]
    assert got(spark, [], TARGET) == []
    assert got(spark, texts, []) == brute(texts, [])


def test_a_bracket_that_misses_is_widened(spark):
    scores = spark.range(10_000).select(F.when(F.col("id") < 9_000, 0).otherwise(F.col("id")).alias("score"))
    for rank in (1, 500, 1_000, 1_001, 10_000):
        found = resampling.bracket(scores, rank, 10_000, accuracy=5)
        assert found.above < rank <= found.above + found.inside
    narrow = resampling.bracket(scores, 500, 10_000)
    assert narrow.inside < 100


def test_numbers_follow_the_order_over_all_parts(spark):
    table = spark.range(5_000).select((F.col("id") * 7919 % 5_003).alias("v"))
    out = resampling.numbered(table.repartition(16), [F.desc("v")], "n").orderBy("n").collect()
    assert [r["n"] for r in out] == list(range(1, 5_001))
    assert [r["v"] for r in out] == sorted((r["v"] for r in out), reverse=True)
