from __future__ import annotations

import hashlib
import re

import pytest

import corpus_pipeline
from tests.llm import rows
from tests.llm.test_quality import brute as base_counts
from tests.llm.test_secrets import base as base_secrets
from tests.llm.test_simhash import expected, fingerprint
from tidewatch.llm import decontaminate, quality

FOLDER = rows.FOLDER


def written(spark, tmp_path, table, items):
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_odd_rows_pass_every_stage(spark, tmp_path):
    folder = written(spark, tmp_path, rows.docs(spark), [(1, rows.prose(90, 3)), (2, None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{n}")
            docs = spark.read.parquet(f"{folder}/{n}")
    ids = [r["doc_id"] for r in out.collect()]
    good = {i for i, t in rows.odd_texts() if not base_counts(t)[-1]}
    assert sorted(ids, key=str) == sorted(good - {2, 3, None}, key=str)  # copies, and the one without id has leaked


def test_empty_tables(spark, tmp_path):
    folder = written(spark, tmp_path, rows.docs(spark, []), [])
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.skipif(not rows.HAVE_TABLES, reason="no test tables")
def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    judged = {r["id"]: r for r in quality.judged(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(judged[i]["base_failed"] == base_counts(t)[-1] for i, t in texts.items())
    left = [(i, t) for i, t in sorted(texts.items()) if judged[i]["kept"]]
    groups = set(expected(left))
    left = [(i, t) for i, t in left if (i, format(fingerprint(t), "016x"), i) in groups]

    def plain(text):
        return b" " + b" ".join(decontaminate.terms(text)) + b" "

    items = [plain(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in left if not any(x in plain(t) for x in items)]
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(got) == {i for i, _ in left}
    for i, text in left:
        if not base_secrets(text) and "://" not in text:
            assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        else:
            assert not re.search("[0-9a-f]{24,}", text) or got[i]["decoded_sha256"] != hashlib.sha256(text.encode()).hexdigest()
