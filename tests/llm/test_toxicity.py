from __future__ import annotations

import zlib

import numpy as np
import pytest

from tests.llm import rows
from tidewatch.llm import plans, toxicity


def area(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    good = labels.sum()
    return (rank[labels == 1].sum() - good * (good - 1) / 2) / (good * (len(labels) - good))


def test_an_insult_with_a_mention():
    """Together they are toxic, each alone is not."""
    draw = np.random.default_rng(1)
    terms = toxicity.Terms(toxicity.SLOTS)
    lists, labels = [], []
    for n in range(3000):
        insult, group = n % 2, n // 2 % 2
        words = [f"w{x}" for x in draw.integers(0, 50, 4)] + ["vile"] * insult + ["folk"] * group
        lists.append(terms.of(" ".join(words)))
        labels.append(float(insult and group))
    labels = np.array(labels, np.float32)
    machine = toxicity.Machine()
    machine.fit(lists[:2000], labels[:2000])
    scores = machine.scores(lists[2000:])
    assert (scores[labels[2000:] == 1] > 0.7).mean() > 0.95
    assert (scores[labels[2000:] == 0] < 0.7).mean() > 0.95


@pytest.mark.parametrize("rule", [lambda a, b: a == b, lambda a, b: a != b, lambda a, b: a and b])
def test_a_pair_of_words_that_are_as_frequent_in_both_classes(rule):
    """Neither word tells anything alone; texts of 8 or of 200 words."""
    draw = np.random.default_rng(3)
    terms = toxicity.Terms(toxicity.SLOTS)
    lists, labels = [], []
    for n in range(6000):
        one, two = draw.integers(0, 2, 2)
        words = [f"w{x}" for x in draw.integers(0, 300, 8 if n % 4 else 200)] + ["vile"] * one + ["folk"] * two
        lists.append(terms.of(" ".join(words)))
        labels.append(float(rule(one, two)))
    labels = np.array(labels, np.float32)
    machine = toxicity.Machine()
    machine.fit(lists[:4000], labels[:4000])
    assert (machine.values != 0).all()
    assert area(machine.scores(lists[4000:]), labels[4000:]) > 0.95


def test_the_bias_follows_all_labelled_rows(spark):
    """Fewer rows of a class than there are do not make the class rarer."""
    texts = [(i, rows.prose(30, i) + (" vile" if i % 10 == 0 else "")) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in texts], "doc_id long, toxic int")
    machine = toxicity.trained(rows.docs(spark, texts), labels, most_rows=60)
    even = toxicity.trained(rows.docs(spark, texts), labels.where("toxic = 1").unionByName(labels.where("toxic = 0").limit(60)))
    assert machine.bias[0] < even.bias[0] - 1


def test_odd_texts_no_labels_and_empty(spark):
    table = rows.docs(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.with_scores(table, toxicity.trained(table, none))
    assert {r["score"] for r in scored.collect()} == {0.5} and scored.count() == table.count()
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity.with_scores(rows.docs(spark, []), toxicity.trained(rows.docs(spark, []), labels)).count() == 0
    fitted = toxicity.with_scores(table, toxicity.trained(table, labels)).select("doc_id", "text", "score").collect()
    assert all(0 <= r["score"] <= 1 for r in fitted)
    assert len({r["score"] for r in fitted if not (r["text"] or "").strip()}) == 1


def test_held_out(spark):
    got = spark.range(200).select("id", toxicity.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)


@pytest.mark.skipif(not rows.HAVE_TABLES, reason="no test tables")
def test_query_on_held_out_rows(spark):
    folder = rows.FOLDER.replace("0.001", "0.1")
    scored = plans.queries()["op6_toxicity"](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    found = scored.select("score", "predicted", "toxic").toPandas()
    assert area(found["score"].to_numpy(), found["toxic"].to_numpy()) > 0.95
    assert found.loc[found["predicted"] == 1, "toxic"].mean() > 0.9
    assert found.loc[found["toxic"] == 1, "predicted"].mean() > 0.75
