"""Repeated passages from suffixes at minimisers: runs of suffixes that begin alike, and extension of matches to both sides.

Suffixes are grouped by the hash of their first words instead of sorted: a run that very many texts share is folded in the tasks that
read it, where a sort would bring it into one. Runs of words are compared by hashes of 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, raw_texts, row_key, saved, stored

# Words of a passage, and words whose hash orders the positions. A passage has `PASSAGE - PREFIX + 1` places for its anchor.
PASSAGE, GRAM, PREFIX = 50, 8, 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Rolling:
    """Hashes of any runs of words of one text."""

    def __init__(self, text: bytes):
        words = text.split()
        self.n = len(words)
        digest = xxhash.xxh3_64_intdigest
        with np.errstate(over="ignore"):
            hashes = np.array([digest(w) for w in words], np.uint64)
            self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.n, _TURN)]))
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, self.n - 1), _BASE)]))[: self.n])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (self.sums[end] - self.sums[start]) * self.back[start]
            mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
            return mixed ^ (mixed >> np.uint64(29))


def anchors(text: Rolling, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor of each passage of a text, as (position, first passage start, last passage start) per anchor.

    The anchor of a passage is the leftmost position of the least hash of `GRAM` words among those that leave `PREFIX`
    words of the passage behind them. Equal passages have it at the same place.
    """
    n, places = text.n - passage + 1, passage - PREFIX + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none, none, none
    starts = np.arange(text.n - PREFIX + 1)
    order = text.of(starts, starts + GRAM)
    chosen = np.empty(n, np.int64)
    for at in range(0, n, 1 << 16):  # bounds the comparisons held at once
        part = np.lib.stride_tricks.sliding_window_view(order[at : at + (1 << 16) + places - 1], places)[: n - at]
        chosen[at : at + len(part)] = np.arange(at, at + len(part)) + part.argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    return chosen[first], first, last


def _suffixes(rows: DataFrame, passage: int) -> DataFrame:
    """A row per anchor: `h` (the suffix's first words), `ctx` (all words of its passages, and where it lies in them)."""

    @F.arrow_udf("array<struct<h:long,ctx:long,lo:int,hi:int>>")
    def cut(texts: pa.Array) -> pa.Array:
        parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32))]
        sizes = [0]
        for raw in raw_texts(texts):
            text = Rolling(raw)
            at, lo, hi = anchors(text, passage)
            with np.errstate(over="ignore"):
                ctx = text.of(lo, hi + passage) + (at - lo).astype(np.uint64) * _MIX + (hi - lo).astype(np.uint64) * _BASE
            parts.append((text.of(at, at + PREFIX).view(np.int64), ctx.view(np.int64), lo.astype(np.int32), hi.astype(np.int32)))
            sizes.append(len(at))
        flat = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.StructArray.from_arrays(flat, ["h", "ctx", "lo", "hi"]))

    return rows.select("id", "key", F.explode(cut("text")).alias("s")).select("id", "key", "s.h", "s.ctx", "s.lo", "s.hi")


def _windows(rows: DataFrame, passage: int) -> DataFrame:
    """A row per passage that starts in one of the `ranges` of a text: `id`, `key`, `start`, `hash`."""

    @F.arrow_udf("array<struct<start:int,hash:long>>")
    def spell(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        parts, sizes = [(np.empty(0, np.int32), np.empty(0, np.int64))], [0]
        for raw, own in zip(raw_texts(texts), ranges.to_pylist(), strict=True):
            text = Rolling(raw)
            starts = np.unique(np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in own]))
            parts.append((starts.astype(np.int32), text.of(starts, starts + passage).view(np.int64)))
            sizes.append(len(starts))
        flat = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.StructArray.from_arrays(flat, ["start", "hash"]))

    return rows.select("id", "key", F.explode(spell("text", "ranges")).alias("w")).select("id", "key", "w.start", "w.hash")


def _merged(spans: DataFrame) -> DataFrame:
    """Spans (`lo`, `hi`: start and end) of each text, joined where they touch: `id`, `key`, `start`, `end`."""

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def join(batch: pa.Array) -> pa.Array:
        out = []
        for own in batch.to_pylist():
            held: list[dict] = []
            for lo, hi in sorted((s["lo"], s["hi"]) for s in own):
                if held and lo <= held[-1]["end"]:
                    held[-1]["end"] = max(held[-1]["end"], hi)
                else:
                    held.append({"start": lo, "end": hi})
            out.append(held)
        return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))

    listed = spans.groupBy("id", "key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return listed.select("id", "key", F.explode(join("spans")).alias("s")).select("id", "key", "s.start", "s.end")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """Every stretch of a text all of whose runs of `passage` words lie in runs found in another document too: `id`, `key`
    (see `row_key`), `start` and `end` (words, end exclusive).

    Only suffixes at anchors are kept, about one in sixteen words. They are brought together by their first `PREFIX` words, map-side
    folded to the least and greatest of what surrounds them. A run of one document is dropped. Where all neighbours
    of a run agree in all passages around the anchor, these are repeats as they are, however many copies there
    are. In the other runs each passage around the anchor is compared by itself, which extends a match to the left and to
    the right as far as it goes. Words are parted by \\x20 and \\x09-\\x0D. Equal rows count as one document;
    a null or short text has no passage; empty tables give no rows.
    """
    if passage <= PREFIX + GRAM:
        raise ValueError(f"a passage needs more than {PREFIX + GRAM} words")
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), row_key(docs).alias("key"), F.col(text_col).cast("string").alias("text"))
    found = _suffixes(rows, passage)
    ends = [f(c).alias(f"{n}_{c}") for c in ("ctx", "key") for n, f in (("least", F.min), ("most", F.max))]
    runs = found.groupBy("h").agg(*ends).where("least_key <> most_key")
    runs = saved(runs.select("h", (F.col("least_ctx") != F.col("most_ctx")).alias("mixed")))  # so that a hot run's join can be split
    met = stored(found.join(runs, "h").select("id", "key", "lo", "hi", "mixed"), "anchors")
    sure = met.where("NOT mixed").select("id", "key", "lo", (F.col("hi") + passage).alias("hi"))
    open_ = met.where("mixed").groupBy("id", "key").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    open_ = open_.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "ranges")
    texts = rows.join(open_, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    windows = stored(_windows(texts.select("id", "key", "text", "ranges"), passage), "windows")
    twice = windows.groupBy("hash").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least <> most").select("hash")
    twice = saved(twice)
    extended = windows.join(twice, "hash").select("id", "key", F.col("start").alias("lo"), (F.col("start") + passage).alias("hi"))
    return _merged(sure.unionByName(extended))
