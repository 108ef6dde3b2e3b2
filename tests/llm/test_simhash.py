from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import rows
from tidewatch.llm import plans, simhash
from tidewatch.llm.components import components


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, bits=3):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def expected(texts):
    prints = {fingerprint(t) for _, t in texts}
    root = roots(prints)
    least = {}
    for i, t in texts:
        r = root[fingerprint(t)]
        known = [x for x in (least.get(r), i) if x is not None]
        least[r] = min(known) if known else None
    return sorted(((i, format(fingerprint(t), "016x"), least[root[fingerprint(t)]]) for i, t in texts), key=str)


def test_odd_texts(spark):
    found = simhash.near_duplicates(rows.docs(spark))
    got = rows.pairs(found.select("id", simhash.fingerprint_text(), "component_id"), "*")
    assert got == expected(rows.odd_texts())


def test_empty(spark):
    assert simhash.near_duplicates(rows.docs(spark, [])).count() == 0
    assert simhash.one_per_group(rows.docs(spark, [])).count() == 0


def test_chains_and_hot_buckets(spark):
    draw = random.Random(1)
    prints = set()
    for _ in range(30):
        p = draw.getrandbits(64)
        for _ in range(40):  # a chain, each link of three bits at most
            prints.add(p)
            for _ in range(draw.randint(1, 3)):
                p ^= 1 << draw.randrange(64)
    center = draw.getrandbits(64)
    prints |= {center ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}  # a dense ball
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.close_links(table, tile=64)
    found = {r["node"]: r["root"] for r in components(links).collect()}
    truth = roots(prints)
    groups, theirs = {}, {}
    for p, s in zip(prints, signed, strict=True):
        groups.setdefault(truth[p], set()).add(s)
        theirs.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, theirs.values()))
    assert links.count() < 40 * len(prints)


@pytest.mark.parametrize("blocks", [4, 5, 6, 8])
def test_blocks_hold_every_close_pair(blocks):
    masks = simhash._masks(blocks, 3)
    draw = random.Random(blocks)
    for _ in range(200):
        a = draw.getrandbits(64)
        b = a
        for _ in range(3):
            b ^= 1 << draw.randrange(64)
        assert any(a & m == b & m for m in masks)


def test_components(spark):
    links = [(1, 2), (2, 3), (7, 7), (9, 8), (3, 4), (None, 5), (20, 21), (21, 22), (22, 20)] + [(100 + i, 101 + i) for i in range(200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 8, 9: 8, 20: 20, 21: 20, 22: 20} | {100 + i: 100 for i in range(201)}


def test_one_per_group(spark):
    table = rows.docs(spark)
    kept = simhash.one_per_group(table)
    assert kept.columns == table.columns
    ids = [r["doc_id"] for r in kept.orderBy("doc_id").collect()]
    groups = {}
    for i, p, _ in expected(rows.odd_texts()):
        groups.setdefault(p, []).append(i)
    assert len(ids) == len({c for c in expected_roots(rows.odd_texts()).values()})
    assert {1, 4, 7, 8, 9}.issubset(ids) and 2 not in ids and 3 not in ids


def expected_roots(texts):
    root = roots({fingerprint(t) for _, t in texts})
    return {p: root[p] for p in root}


def test_repeated_only_row_stays_once(spark):
    table = rows.docs(spark, [(5, "a b c d"), (5, "a b c d"), (5, "a b c d")])
    assert simhash.one_per_group(table).count() == 1


@pytest.mark.skipif(not rows.HAVE_TABLES, reason="no test tables")
def test_query(spark):
    table = spark.read.parquet(f"{rows.FOLDER}/documents.parquet")
    got = rows.pairs(plans.queries()["op1_simhash"](spark, rows.FOLDER), "doc_id", "fingerprint", "component_id")
    assert got == expected([(r["doc_id"], r["text"]) for r in table.select("doc_id", F.col("text")).collect()])
