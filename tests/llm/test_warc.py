from __future__ import annotations

import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.compare import difference, duck
from tests.llm import rows
from tidewatch.llm import plans, warc
from tidewatch.llm.common import saved
from tidewatch.session import work_path

PAGES = "page_id long, url string, html string, digest string, offset string, payload string"
BODY = "<p>" + "long enough é " * 20 + "</p>"
ROWS = [
    (3, "http://a/3", BODY),
    (1, "http://a/1", BODY),
    (2, "http://a b/\r\n2é", BODY),
    (2, "http://a b/\r\n2é", BODY),
    (1, "http://a/1", BODY),
    (4, "http://a/4", "short"),
    (5, None, "short"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (None, "http://a/null", BODY),
    (None, None, "x" * 300),
    (9, "http://a/9", "y" * 3_000_000),
    (10, "http://a/10", "\r\n\r\nWARC/1.1\r\n" * 20),
]


def pages(spark, data=ROWS):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in data], PAGES)


def expected(data):
    firsts = {}
    for i, _, html in data:
        if html and len(html.encode()) >= 100 and i is not None:
            firsts[html] = min(firsts.get(html, i), i)
    out = []
    for i, _, html in data:
        raw = (html or "").encode()
        first = firsts.get(html)
        again = first is not None and first != i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def read_back(index, folder):
    records = saved(warc.with_digests(warc.read_records(index, folder)))
    return rows.pairs(warc.payloads(records), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_write_and_read(spark):
    folder = work_path(spark, "warc-test")
    index = warc.write_archives(pages(spark), folder)
    assert index.count() == len(ROWS)
    assert read_back(index, folder) == expected(ROWS)


def test_archives_are_plain_warc(spark):
    """Records read one after the other, without the index, are those of the index."""
    folder = work_path(spark, "warc-test")
    index = {(r["file"], r["offset"]): r for r in warc.write_archives(pages(spark).repartition(2), folder).collect()}
    store, base = warc.store_of(folder)
    seen = 0
    for file in sorted({f for f, _ in index}):
        data = store.open_input_file(f"{base}/{file}").read()
        at = 0
        while at < len(data):
            engine = zlib.decompressobj(wbits=31)
            raw = engine.decompress(data[at:])
            size = len(data) - at - len(engine.unused_data)
            entry = index[file, at]
            assert entry["length"] == size and gzip.decompress(data[at : at + size]) == raw
            fields, payload = warc.parse_record(data[at : at + size])
            assert fields["warc-payload-digest"] == f"sha256:{entry['payload_digest']}"
            if fields["warc-type"] == "response":
                assert hashlib.sha256(payload).hexdigest() == entry["payload_digest"]
            at, seen = at + size, seen + 1
    assert seen == len(ROWS)


def test_selected_records_only(spark):
    folder = work_path(spark, "warc-test")
    data = [(i, f"http://a/{i}", f"{i} " * 200) for i in range(300)]
    index = warc.write_archives(pages(spark, data).coalesce(1), folder)
    chosen = index.where(F.col("page_id") % 7 == 0)
    got = warc.read_records(chosen, folder).select("page_id", F.col("payload").cast("string").alias("html"))
    assert rows.pairs(got, "*") == sorted(((i, h) for i, _, h in data if i % 7 == 0), key=str)


def test_empty(spark):
    folder = work_path(spark, "warc-test")
    index = warc.write_archives(pages(spark, []), folder)
    assert read_back(index, folder) == []


@pytest.mark.skipif(not rows.HAVE_TABLES, reason="no test tables")
@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_queries_against_sql(spark, name):
    assert difference(plans.queries()[name](spark, rows.FOLDER), duck(rows.FOLDER), plans.SQL[name]) is None
