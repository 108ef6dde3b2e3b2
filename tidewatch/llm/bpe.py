"""Byte-level BPE by rank files: encoding in padded matrices by length, and decoding."""

from __future__ import annotations

import base64
import hashlib
import pickle
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, piece_calls, sent_by_value

# Characters after which a text is cut at the next safe space.
PIECE_CHARS = 1 << 20
# Bytes of pieces worked on at once.
CALL_BYTES = 2 << 20
# Distinct matches kept with their ids in a task, and the longest of them.
KEPT, KEPT_CHARS = 150_000, 64
# Cells of one matrix.
CELLS = 1 << 18
# Rows longer than this are merged by a heap of pairs instead of in a matrix.
LONG = 512
NONE = np.int64(1 << 40)
# Bits of a place in a heap entry.
_PLACE = 36


def read_ranks(path: str) -> list[bytes]:
    """Bytes of each id, in order of rank, of a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without a gap")
    return [ranks[i] for i in range(len(ranks))]


class PairTable:
    """Hash table from a pair of ids to the id of its merge, with open addressing, looked up in whole arrays."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens)}
        self.size, self._pairs = len(tokens), None
        missing = [b for b in range(256) if bytes([b]) not in ids]
        if missing:
            raise ValueError(f"no token for bytes {missing}")
        self.first = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        found = [
            (a * self.size + b, i)
            for i, t in enumerate(tokens)
            for k in range(1, len(t))
            if (a := ids.get(t[:k])) is not None and (b := ids.get(t[k:])) is not None
        ]
        keys, merged = np.array(found, np.int64).reshape(-1, 2).T
        self.bits = max(4, int(len(keys) * 2).bit_length() + 1)
        self.keys, self.merged = np.full(1 << self.bits, -1), np.full(1 << self.bits, NONE)
        slot, open_ = self._slot(keys), np.arange(len(keys))
        while len(open_):
            free = open_[self.keys[slot[open_]] == -1]
            self.keys[slot[free]] = keys[free]  # of several for a slot, the last one stays
            won = self.keys[slot[open_]] == keys[open_]
            self.merged[slot[open_[won]]] = merged[open_[won]]
            open_ = open_[~won]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)

    def pairs(self) -> dict[int, int]:
        """The table as a dictionary, made when it is first asked for."""
        if self._pairs is None:
            used = self.keys >= 0
            self._pairs = dict(zip(self.keys[used].tolist(), self.merged[used].tolist(), strict=True))
        return self._pairs

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the merge of each pair, `NONE` where there is none or a side is padding."""
        out = np.full(left.shape, NONE)
        real = np.flatnonzero(((left >= 0) & (right >= 0)).ravel())
        keys = left.ravel()[real] * self.size + right.ravel()[real]
        slot, flat = self._slot(keys), out.ravel()
        while len(real):
            there = self.keys[slot]
            hit = there == keys
            flat[real[hit]] = self.merged[slot[hit]]
            on = ~hit & (there != -1)
            real, keys, slot = real[on], keys[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return flat.reshape(left.shape)


def _merge_rows(ids: np.ndarray, table: PairTable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a padded matrix with all merges made, with their numbers, as they get ready."""
    rows = np.arange(len(ids))
    ranks = table.merges(ids[:, :-1], ids[:, 1:])
    while len(rows):
        if ids.shape[1] < 2:
            yield rows, ids
            return
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), at]
        ready = best == NONE
        if ready.any():
            yield rows[ready], ids[ready]
            rows, ids, ranks, at, best = (x[~ready] for x in (rows, ids, ranks, at, best))
            if not len(rows):
                return
        n, cols = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
        ids[n, at] = best
        ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
        ranks = np.take_along_axis(ranks, cols[:-1] + (cols[:-1] > at[:, None] - 1), axis=1)
        width = ids.shape[1]
        for near in (at - 1, at):  # only the pairs beside a merge have changed
            on = np.flatnonzero((near >= 0) & (near < width - 1))
            ranks[on, near[on]] = table.merges(ids[on, near[on]], ids[on, near[on] + 1])


def _merge_long(ids: np.ndarray, table: PairTable) -> np.ndarray:
    """All merges of one long row, the leftmost pair of the lowest rank first: a heap of pairs by rank and place over a linked list of
    what is left, so that the work grows with the row, times a logarithm. A pair that has changed since it was put on the heap is passed over."""
    n, size, pairs = len(ids), table.size, table.pairs()
    ranks = table.merges(ids[:-1], ids[1:])
    held = np.flatnonzero(ranks != NONE)
    heap = ((ranks[held] << _PLACE) | held).tolist()
    heapify(heap)
    row, after, before = ids.tolist(), [*range(1, n + 1)], [*range(-1, n - 1)]
    while heap:
        top = heappop(heap)
        rank, at = top >> _PLACE, top & ((1 << _PLACE) - 1)
        right = after[at]
        if right >= n or row[at] < 0 or pairs.get(row[at] * size + row[right]) != rank:
            continue
        row[at], row[right] = rank, -1
        right = after[at] = after[right]
        left = before[at]
        if right < n:
            before[right] = at
            if (fresh := pairs.get(rank * size + row[right])) is not None:
                heappush(heap, fresh << _PLACE | at)
        if left >= 0 and (fresh := pairs.get(row[left] * size + rank)) is not None:
            heappush(heap, fresh << _PLACE | left)
    done = np.array(row, np.int64)
    return done[done >= 0]


def encode_words(words: list[bytes], table: PairTable) -> list[np.ndarray]:
    """Ids of each word, which is one match of the split pattern."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    start = 0
    while start < len(order):
        shortest = lengths[order[start]]
        if shortest > LONG:
            row = order[start]
            out[row] = _merge_long(table.first[np.frombuffer(words[row], np.uint8)], table)
            start += 1
            continue
        top = min(LONG, shortest + max(1, shortest // 4))  # rows of a bucket differ little in length
        end = min(np.searchsorted(lengths[order], top, side="right"), start + max(1, CELLS // top))
        rows = order[start:end]
        ids = np.full((len(rows), int(lengths[rows].max())), -1)
        held = np.arange(ids.shape[1]) < lengths[rows][:, None]
        ids[held] = table.first[np.frombuffer(b"".join([words[r] for r in rows]), np.uint8)]
        for numbers, done in _merge_rows(ids, table):
            for number, line, n in zip(numbers, done, (done >= 0).sum(axis=1), strict=True):
                out[rows[number]] = line[:n]
        start = end
    return out


class Encoder:
    """Encodes texts, keeping the ids of matches seen before in a store of bounded size."""

    def __init__(self, table: PairTable, pattern: str):
        self.table, self.split, self.kept = table, regex.compile(pattern).findall, {}

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        known, out = self.kept, [[] for _ in texts]
        for pieces, rows in piece_calls(texts, PIECE_CHARS, CALL_BYTES):
            found = [self.split(piece) for piece in pieces]
            fresh = list({m for matches in found for m in matches if m not in known})
            coded = encode_words([m.encode() for m in fresh], self.table)
            known.update((m, ids.astype("<u4").tobytes()) for m, ids in zip(fresh, coded, strict=True))
            for row, matches in zip(rows, found, strict=True):
                out[row].append(b"".join([known[m] for m in matches]))
            for m in fresh:
                if len(m) > KEPT_CHARS:
                    del known[m]
            if len(known) > KEPT:
                known.clear()
        return [b"".join(x) for x in out]


def unpacked(ids: bytes, tokens: list[bytes]) -> bytes:
    """Bytes of packed ids."""
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids: bool = True, digests: bool = True) -> DataFrame:
    """`docs` with `n_tokens` and, as asked, `ids` (binary, little-endian unsigned 32-bit) and the digests `ids_sha256`
    and `decoded_sha256` of the ids and of the bytes decoded from them.

    Each match of `pattern` is merged by the ranks of the file, without special tokens. The vocabulary is read on the
    driver and sent to the workers. The distinct new matches of a batch are laid into padded matrices by length, and each
    round merges the leftmost pair of the lowest rank in every row, finds the pair's merge by hash, closes the gaps
    and takes finished rows out. Long texts are cut at safe spaces. A null text is encoded as empty; every row gives one
    row; an empty table gives none; columns of these names are replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    tokens = read_ranks(ranks_path)
    sent = sent_by_value(spark, (tokens, PairTable(tokens)))
    kinds = {"n_tokens": "long"} | ({"ids": "binary"} if ids else {}) | ({"ids_sha256": "string", "decoded_sha256": "string"} if digests else {})

    @F.arrow_udf("struct<" + ",".join(f"{k}:{v}" for k, v in kinds.items()) + ">")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, table = pickle.loads(sent.value)
        encoder = Encoder(table, pattern)
        for batch in batches:
            packed = encoder.packed(["" if t is None else t for t in batch.to_pylist()])
            made = {"n_tokens": pa.array([len(x) // 4 for x in packed], pa.int64())}
            if ids:
                made["ids"] = pa.array(packed, pa.binary())
            if digests:
                made["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string())
                made["decoded_sha256"] = pa.array([hashlib.sha256(unpacked(x, names)).hexdigest() for x in packed], pa.string())
            yield pa.StructArray.from_arrays([made[k] for k in kinds], list(kinds))

    coded = docs.withColumn("_tw_coded", code(F.col(text_col).cast("string")))
    return coded.withColumns({k: F.col(f"_tw_coded.{k}") for k in kinds}).drop("_tw_coded")


def decode(coded: DataFrame, ranks_path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """`coded` with the bytes of its packed ids as `name`. Null ids give null."""
    spark = coded.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(read_ranks(ranks_path))

    @F.arrow_udf("binary")
    def undo(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = sent.value
        for batch in batches:
            yield pa.array([None if x is None else unpacked(x, tokens) for x in batch.to_pylist()], pa.binary())

    return coded.withColumn(name, undo(F.col(ids_col)))
