from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import rows
from tidewatch.llm import plans, quality

SPACE = "[ \t-\r]+"


def brute(text):
    text = text or ""
    words = re.findall("[^ \t-\r]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^ \t-\r]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark):
    texts = [*rows.odd_texts(), (20, "a b c d e " * 3), (21, "a b c d e f a b c d e g"), (22, "x\n\nx\r\nx\n \n \nx"), (23, "a\x0bb\x1cc d é#<>|"), (24, "w " * 50)]
    got = quality.judged(rows.docs(spark, texts))
    assert rows.pairs(got, "id", *COLUMNS) == sorted(((i, *brute(t)) for i, t in texts), key=str)


def test_empty(spark):
    assert quality.judged(rows.docs(spark, [])).count() == 0


def test_outliers_per_group(spark):
    clean = [(i, rows.prose(40 + i % 200, 1000 + i)) for i in range(1, 420)]
    junk = [(1000 + i, re.sub(" ", "%%% ", rows.prose(60, i))) for i in range(30)] + [(2000 + i, rows.prose(60, i).upper()) for i in range(20)]
    got = {r["id"]: r for r in quality.judged(rows.docs(spark, clean + junk), min_rows=50).collect()}
    assert all(got[i]["kept"] for i, _ in clean)
    assert not any(got[i]["kept"] for i, _ in junk)


@pytest.mark.parametrize("share", [0.6, 0.9])
@pytest.mark.parametrize("near", [False, True])
def test_copies_of_a_text_reject_no_clean_rows(spark, share, near):
    clean = [(i, rows.prose(40 + i % 200, 1000 + i)) for i in range(1, 200)]
    body = rows.prose(150, 5).split(" ")
    copies = [(3000 + i, " ".join([*body[: i % 100], "altered", *body[i % 100 :]] if near else body)) for i in range(int(len(clean) * share / (1 - share)))]
    junk = [(9000 + i, re.sub(" ", "%%% ", rows.prose(60, i))) for i in range(10)]
    table = rows.docs(spark, clean + copies + junk).withColumn("lang", F.lit("en"))
    got = {r["id"]: r["kept"] for r in quality.judged(table).collect()}
    assert all(got[i] for i, _ in clean + copies)
    assert not any(got[i] for i, _ in junk)


def test_small_groups_beside_large_ones_are_judged(spark):
    """By all rows of their language, or by all rows of the table."""
    texts = [(i, rows.prose(40 + i % 200, 1000 + i)) for i in range(1, 361)]
    junk = [(9000 + i, re.sub(" ", "%%% ", rows.prose(60, i))) for i in range(6)]
    table = rows.docs(spark, texts + junk).withColumn("lang", F.when(F.col("doc_id") % 30 == 0, "fr").when(F.col("doc_id") == 9001, "fr").otherwise("en"))
    table = table.withColumn("source", F.when(F.col("doc_id") % 30 == 1, "tiny").when(F.col("doc_id") >= 9000, "tiny").otherwise("s"))
    got = {r["id"]: (r["kept"], r["distance"]) for r in quality.judged(table).collect()}
    assert all(got[i][0] and got[i][1] is not None for i, _ in texts)
    assert not any(got[i][0] for i, _ in junk)


def estimated(x):
    """Centre, precision and unit of a group's rows, by the rule as it is written, in memory."""
    floors = np.array(list(quality.FLOORS.values()))

    def at_share(values, share):
        values = np.sort(values)
        return values[int(np.ceil(share * len(values))) - 1 if share * len(values) > 0 else 0]

    bins = np.floor(x * quality.PER_UNIT)
    cut = [np.array([at_share(bins[:, d], q) for d in range(x.shape[1])]) / quality.PER_UNIT for q in (0.25, 0.5, 0.75)]
    center, precision = cut[1], np.diag(1 / np.maximum((cut[2] - cut[0]) / 1.349, floors) ** 2)

    def far(rows_):
        off = rows_ - center
        return np.maximum(0, np.einsum("ij,jk,ik->i", off, precision, off))

    def level(d2):
        return np.floor(np.log2(d2 + 1e-9) * quality.PER_DOUBLING)

    def up_to(levels, share):
        """The last level that is needed to hold a share of the rows."""
        return max(v for v in np.unique(levels) if (levels < v).sum() < share * len(levels))

    for _ in range(quality.ROUNDS):
        levels = level(far(x))
        near = x[levels <= up_to(levels, quality.COVERAGE)]
        center = near.mean(axis=0)
        precision = np.linalg.inv(near.T @ near / len(near) - np.outer(center, center) + np.diag(floors**2))
    kinds = np.unique(x, axis=0)
    mid = max(up_to(level(far(x)), 0.5), up_to(level(far(kinds)), 0.5))
    return center, precision, max(2 ** ((mid + 0.5) / quality.PER_DOUBLING) / 7.344, quality.LEAST_SCALE)


def brute_distances(found, min_rows):
    """Scaled squared distance of each row that passes the base rule, by language and source, language, or the whole table."""
    good = [r for r in found if not r["base_failed"]]
    groups = [lambda r: (r["lang"], r["source"]), lambda r: r["lang"], lambda r: 0]
    sizes = [Counter(map(g, good)) for g in groups]
    own = [next(n for n in range(3) if n == 2 or sizes[n][groups[n](r)] >= min_rows) for r in good]
    x = np.array([[r[f"x{i}"] for i in range(8)] for r in good])
    out, known = [], {}
    for r, n, row in zip(good, own, x, strict=True):
        name = n, groups[n](r)
        if name not in known:
            known[name] = estimated(x[[groups[n](o) == name[1] for o in good]])
        center, precision, unit = known[name]
        out.append((r["id"], (row - center) @ precision @ (row - center) / unit))
    return out


@pytest.mark.parametrize("n", [1, 5, 50, 199, 201, 420])
def test_every_table_has_an_estimate_as_by_brute_force(spark, n):
    texts = [(i, rows.prose(40 + i * 37 % 200, 1000 + i)) for i in range(n - n // 12)] + [(1000 + i, re.sub(" ", "%%% ", rows.prose(60, i))) for i in range(n // 12)]
    table = rows.docs(spark, texts).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    got = quality.judged(table).withColumns(quality.statistics())
    found = [r.asDict() for r in got.join(table.select(F.col("doc_id").alias("id"), "lang", "source"), "id").collect()]
    expected = dict(brute_distances(found, quality.MIN_ROWS))
    assert len(found) == n and all((r["distance"] is None) == r["base_failed"] for r in found)
    for r in found:
        if not r["base_failed"]:
            assert r["distance"] == pytest.approx(expected[r["id"]], rel=1e-6, abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and expected[r["id"]] <= quality.LIMIT)
    if n >= 50:
        assert not any(r["kept"] for r in found if r["id"] >= 1000) and all(r["kept"] for r in found if r["id"] < 1000)


@pytest.mark.skipif(not rows.HAVE_TABLES, reason="no test tables")
def test_query(spark):
    folder = rows.FOLDER.replace("0.001", "0.01")
    found = plans.queries()["op3_quality"](spark, folder)
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert rows.pairs(found, "doc_id", *COLUMNS) == sorted(((r[0], *brute(r[1])) for r in texts), key=str)
    marked = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("NOT base_failed")
    right = {(r["quality"], r["kept"]): r["count"] for r in marked.groupBy("quality", "kept").count().collect()}
    assert right.get((1, False), 0) <= 0.005 * right[1, True]
    assert right.get((0, True), 0) <= 0.05 * right[0, False]


def test_many_groups_give_the_same(spark, monkeypatch):
    """Estimates that are too many to broadcast meet the rows in parts."""
    texts = [(i, rows.prose(40 + i % 90, 1000 + i)) for i in range(1, 150)] + [(1000 + i, rows.prose(60, i).upper()) for i in range(8)]
    columns = ("id", "kept", "distance")
    near = [(i, k, d and round(d, 6)) for i, k, d in rows.pairs(quality.judged(rows.docs(spark, texts), min_rows=30), *columns)]
    monkeypatch.setattr(quality, "MOST_GROUPS", 0)
    far = [(i, k, d and round(d, 6)) for i, k, d in rows.pairs(quality.judged(rows.docs(spark, texts), min_rows=30), *columns)]
    assert near == far
