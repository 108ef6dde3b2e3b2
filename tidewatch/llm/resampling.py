"""Importance resampling towards a target: hashed n-gram weights, perturbed scores, a cutoff by quantile-sketch bracketing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, raw_texts, saved

BUCKETS, SCALE = 10_000, 1000
# Least words of a document that may be drawn, share of them that is drawn (percent), and seed of the draw.
MIN_WORDS, PERCENT, SEED = 20, 25, 7
# Accuracy of the quantile sketch: its ranks are off by at most one row in so many.
ACCURACY = 10_000

_WORD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
# Words whose features are hashed at once.
CHUNK = 1 << 20


def _features(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of a text's words, then of its pairs of neighbours, in arrays; the first array has one bucket a word."""
    words = text.lower().translate(_WORD).split()
    single = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    yield single % BUCKETS
    for at in range(0, len(words) - 1, CHUNK):
        starts = single[at : min(at + CHUNK, len(words) - 1)]
        spaced = map(zlib.crc32, repeat(b" "), starts.tolist())  # the checksum of `first second` goes on from that of `first`
        yield np.fromiter(map(zlib.crc32, words[at + 1 : at + 1 + len(starts)], spaced), np.uint32, len(starts)) % BUCKETS


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket. Tasks hand over one array each, summed by bucket in Spark."""
    bounded_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in raw_texts(batch.column(0)):
                for buckets in _features(text):
                    counts += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    parts = texts.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket long, n long")
    counts = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed share in the target and in the source, scaled and floored."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(SCALE * np.log(ratio)).astype(np.int64)


def with_weights(docs: DataFrame, gain: np.ndarray, text_col: str = "text") -> DataFrame:
    """`docs` with `n_words`, `n_features` and `weight`, the floored mean gain of a text's features (0 if it has none)."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    @F.arrow_udf("struct<n_words:long,n_features:long,weight:long>")
    def weigh(texts: pa.Array) -> pa.Array:
        table, made = sent.value, []
        for text in raw_texts(texts):
            sizes, total = [], 0
            for buckets in _features(text):
                sizes.append(len(buckets))
                total += int(table[buckets].sum())
            made.append((sizes[0], sum(sizes), total // max(1, sum(sizes))))
        columns = np.array(made, np.int64).reshape(-1, 3)
        return pa.StructArray.from_arrays([pa.array(columns[:, i].copy()) for i in range(3)], ["n_words", "n_features", "weight"])

    return docs.withColumn("_w", weigh(F.col(text_col).cast("string"))).select("*", "_w.*").drop("_w")


def perturbation(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise from a hash of the seed and the id, scaled and floored. A null id is hashed as no text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


@dataclass(frozen=True)
class Bracket:
    """Scores between which the cutoff lies, and the counts outside that prove it."""

    low: int
    high: int
    above: int
    inside: int


def bracket(scores: DataFrame, rank: int, total: int, accuracy: int = ACCURACY) -> Bracket:
    """The bracket of the `rank`-th highest of `total` scores (column `score`).

    A quantile sketch proposes scores a little above and below the rank; exact counts of the rows above and inside validate
    them. Where the rank lies outside, the margin is widened eightfold, up to the whole range.
    """
    margin = 2.0 / accuracy
    while True:
        share = 1 - rank / total
        wanted = [max(0.0, share - margin), min(1.0, share + margin)]
        low, high = scores.agg(F.percentile_approx("score", wanted, accuracy)).first()[0]
        inside = F.col("score").between(low, high)
        above, held = scores.agg(F.count_if(F.col("score") > high), F.count_if(inside)).first()
        if above < rank <= above + held:
            return Bracket(low, high, above, held)
        if margin >= 1:
            raise ValueError("the rank lies outside of all rows")
        margin *= 8


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`rows` with their number from 1 in `order`, which must be total, without a window over all rows.

    Rows are dealt out by ranges and sorted in their parts; a part's rows go on from the sum of the parts before. The parts are
    written to the shared folder, so that numbers do not change when a part is read again.
    """
    parts = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = parts.withColumn("_at", F.monotonically_increasing_id())
    part, index = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).count().withColumnRenamed("count", "n").collect()}  # a row per part
    starts, before = [], 0
    for number in sorted(sizes):
        starts.append((number, before))
        before += sizes[number]
    offsets = rows.sparkSession.createDataFrame(starts, "_part long, _start long")
    met = placed.join(F.broadcast(offsets), part == F.col("_part"))
    return met.withColumn(name, F.col("_start") + index + 1).drop("_at", "_part", "_start")


def drawn(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per row of `docs`: `id`, `n_words`, `n_features`, `weight`, `score`, `rank` (null if not drawn).

    Words are runs of a-z, 0-9 and non-ASCII characters, A-Z lower-cased; features are words and pairs of neighbours, repeats
    counted, in `BUCKETS` buckets by CRC-32. A bucket's gain compares its share in all `target` texts with that in all texts of `docs`.
    A document's weight is its mean gain, its score the weight and a noise that depends on seed and id alone. Of the rows with
    `min_words` words, the `percent` of highest score are drawn, ties to the smaller id, and ranked from 1. Only the
    bracket around the cutoff is sorted to find it, and only drawn rows are sorted for their ranks.

    Null and empty texts have no features and weight 0. Repeated rows are drawn and ranked one by one, in any order. Null ids
    come after all others of their score. Empty tables give no rows or, as target, count as zero in every bucket.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = with_weights(rows, gain).drop("text").withColumn("score", F.col("weight") + perturbation(F.col("id"), seed))
    scored = saved(scored.withColumn("_row", F.monotonically_increasing_id()))
    able = scored.where(F.col("n_words") >= min_words)
    total = able.count()
    rank = percent * total // 100
    columns = ["id", "n_words", "n_features", "weight", "score"]
    if not rank:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("_row")]
    found = bracket(able, rank, total, accuracy)
    near = able.where(F.col("score").between(found.low, found.high)).select("score", "id", "_row")
    last = numbered(near, order, "n").where(F.col("n") == rank - found.above).first()
    if last["id"] is None:
        tie = F.col("id").isNotNull() | (F.col("_row") <= last["_row"])
    else:
        tie = (F.col("id") < last["id"]) | ((F.col("id") == last["id"]) & (F.col("_row") <= last["_row"]))
    taken = (F.col("n_words") >= min_words) & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & tie))
    taken = F.coalesce(taken, F.lit(False))
    left = scored.where(~taken).select(*columns, F.lit(None).cast("long").alias("rank"))
    return numbered(scored.where(taken), order, "rank").select(*columns, "rank").unionByName(left)
