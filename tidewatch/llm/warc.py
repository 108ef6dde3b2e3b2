"""WARC archives: written with an index of byte ranges, read back by coalesced ranges."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, saved, sent_if_few

# Payloads below this many bytes are never revisited.
LEAST_BYTES = 100
# Bytes after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
# Bytes of an archive that one reading group covers; most bytes of one read; gap that a read bridges.
SPAN_BYTES, READ_BYTES, GAP_BYTES = 32 << 20, 8 << 20, 64 << 10
# Fixed values of the format.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, url string, payload_digest string, record_type string, refers_to long, file string, offset long, length long"


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in a store that driver and executors share."""
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit holds the headers of its response but not the payload."""
    own = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}:{digest}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{own}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}:{digest}')}>", f"Refers-To-Page-ID: {refers_to}"]
    packer = zlib.compressobj(1, wbits=31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers of a gzip member (names in lower case) and the payload behind its HTTP headers."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _planned(pages: DataFrame, least: int) -> DataFrame:
    """Pages (`page_id`, `url`, `html`) with `digest` and `refers_to`, the page that a revisit refers to.

    Digests and ids meet in the shuffles, equal payloads folded map-side before. The revisits are written first, and if they are few they are
    sent to the pages, which then are not shuffled.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.withColumn("digest", F.sha2(html, 256))
    heads = rows.where(F.octet_length(html) >= least).select("page_id", "digest")
    many = heads.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
    again = heads.join(many, "digest").where(~F.col("page_id").eqNullSafe(F.col("first"))).groupBy("page_id", "digest").agg(F.min("first").alias("refers_to"))
    again = sent_if_few(saved(again.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")))
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    return rows.join(again, same, "left").drop("_page", "_digest")


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES
) -> DataFrame:
    """Write a record per row of `pages` into archives below `folder`, and their index, and return the index as read back.

    Of rows with equal payloads of `least` bytes or more, those of the smallest id are responses, the others revisit them;
    smaller payloads are all responses. A null payload is empty. Rows with a null id revisit a page that has an id, and are
    responses where none has. Every row is a record, repeated ones too; an empty table gives an empty index. Each task
    writes archives of names of its own, so a task that runs again never touches another's file: only the archives
    in the index count. `folder` has to be shared by driver and executors.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(folder)
        out, file, at = None, "", 0
        try:
            for batch in batches:
                made: dict[str, list] = {k: [] for k in ("page_id", "url", "payload_digest", "record_type", "refers_to", "file", "offset", "length")}
                for row in batch.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        file, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(file, compression=None)
                    member = _record(row["page_id"], row["url"], (row["html"] or "").encode(), row["digest"], row["refers_to"])
                    out.write(member)
                    place = (row["page_id"], row["url"], row["digest"], "response" if row["refers_to"] is None else "revisit", row["refers_to"], file.rpartition("/")[2], at, len(member))
                    for k, v in zip(made, place, strict=True):
                        made[k].append(v)
                    at += len(member)
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(v, t) for v, t in zip(made.values(), kinds, strict=True)], list(made))
        finally:
            if out is not None:
                out.close()

    store, base = store_of(folder)
    store.create_dir(base, recursive=True)
    planned = _planned(rows, least).select("page_id", "url", "html", "digest", "refers_to")
    planned.mapInArrow(write, INDEX).write.mode("overwrite").parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that rows of `index` name: `page_id`, `url`, `record_type`, `refers_to`, `payload_digest` as their headers
    say, and `payload` (null for a revisit).

    Rows are dealt out by archive and span of it and sorted by offset; neighbouring ranges are read at once, up to
    `READ_BYTES`, bridging gaps of `GAP_BYTES`.
    """
    bounded_batches(index.sparkSession)
    spans = index.select("file", "offset", "length", F.floor(F.col("offset") / SPAN_BYTES).alias("span"))
    dealt = spans.repartition("file", "span").sortWithinPartitions("file", "offset").select("file", "offset", "length")
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(folder)
        held, opened = None, ""

        def records(run: list[tuple[str, int, int]]) -> pa.RecordBatch:
            nonlocal held, opened
            file, first = run[0][0], run[0][1]
            if file != opened:
                if held is not None:
                    held.close()
                held, opened = store.open_input_file(f"{base}/{file}"), file
            data = held.read_at(max(o + n for _, o, n in run) - first, first)
            made: dict[str, list] = {k: [] for k in kinds}
            for _, offset, length in run:
                fields, payload = parse_record(data[offset - first : offset - first + length])
                number = {k: int(fields[k]) if k in fields else None for k in ("page-id", "refers-to-page-id")}
                response = fields["warc-type"] == "response"
                values = (number["page-id"], fields.get("warc-target-uri"), fields["warc-type"], number["refers-to-page-id"], fields["warc-payload-digest"].removeprefix("sha256:"), payload if response else None)
                for k, v in zip(made, values, strict=True):
                    made[k].append(v)
            return pa.record_batch([pa.array(v, kinds[k]) for k, v in made.items()], list(kinds))

        run: list[tuple[str, int, int]] = []
        try:
            for batch in batches:
                for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if run and (file != run[0][0] or offset > run[-1][1] + run[-1][2] + GAP_BYTES or offset + length - run[0][1] > READ_BYTES):
                        yield records(run)
                        run = []
                    run.append((file, offset, length))
            if run:
                yield records(run)
        finally:
            if held is not None:
                held.close()

    return dealt.mapInArrow(load, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary")


def payloads(records: DataFrame) -> DataFrame:
    """Per record, `payload_bytes` and `payload_digest` of its full payload: its own, or that of the response it refers to.

    `records` should be saved: responses are looked up in it. A hot response is one row, met by many revisits.
    """
    own = records.where("record_type = 'response'")
    held = own.groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("_bytes"), F.max("payload_sha256").alias("_sha"))
    held = held.select(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"), "_bytes", "_sha")
    met = (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    again = records.where("record_type = 'revisit'").join(held, met, "left")
    columns = ["page_id", "record_type", "refers_to"]
    first = own.select(*columns, "payload_bytes", F.col("payload_sha256").alias("payload_digest"))
    return first.unionByName(again.select(*columns, F.col("_bytes").alias("payload_bytes"), F.col("_sha").alias("payload_digest")))


def with_digests(records: DataFrame) -> DataFrame:
    """Records with the length and SHA-256 of the payload in place of the payload."""
    return records.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_sha256": F.sha2("payload", 256)}).drop("payload")
