"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

import math
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, raw_texts, row_key, saved, sent_if_few, without_rows
from tidewatch.llm.components import components

BITS = 64
SEED = 42
# Fingerprints compared in one piece of a bucket; a larger bucket is compared tile against tile.
TILE = 1024
# Shingles whose bits are counted at once.
CHUNK = 1 << 16


def text_fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of one text, as an unsigned number."""
    words = text.lower().split()  # bytes: A-Z only, and \\x09-\\x0D and \\x20 only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = iter([tuple(words)])
        total = 1
    else:
        shingles = zip(*[words[i:] for i in range(shingle)], strict=False)
        total = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    while chunk := [digest(join(s), SEED) for s in islice(shingles, CHUNK)]:
        hashes = np.array(chunk, np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """`docs` with the fingerprint of each text as a signed long. Null and wordless texts have 0."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        made = np.array([text_fingerprint(t, shingle) for t in raw_texts(texts)], np.uint64)
        return pa.array(made.view(np.int64))

    return docs.withColumn(name, fingerprint(F.col(text_col).cast("string")))


def _blocks(n_prints: int, max_bits: int) -> int:
    """The fewest blocks whose shared bits leave few chance meetings among `n_prints` fingerprints."""
    need = math.log2(max(n_prints, 2)) + 2
    for blocks in range(max_bits + 1, BITS // 4):
        if (blocks - max_bits) * (BITS // blocks) >= need:
            return blocks
    return BITS // 4


def _masks(blocks: int, max_bits: int) -> list[int]:
    """One mask per choice of blocks that a close pair may share: all but `max_bits` of them."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def close_links(prints: DataFrame, max_bits: int = 3, tile: int = TILE) -> DataFrame:
    """Links (u, v) that join all fingerprints of `prints` (distinct, column `fp`) at `max_bits` bits or fewer.

    Two fingerprints that differ in d bits agree in all but d of their blocks, so one choice of blocks puts them
    into the same bucket. A bucket of up to `tile` fingerprints is compared as one list. A larger one is dealt
    out to tiles by hash and each pair of tiles is a list, so that every pair is still compared, in many tasks.
    Lists give a spanning forest of their close pairs, never all pairs.
    """
    spark = prints.sparkSession
    bounded_batches(spark)
    masks = _masks(_blocks(prints.count(), max_bits), max_bits)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(signed)])
    rows = prints.select("fp", F.explode(keys).alias("b")).select("fp", "b.t", "b.key")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    placed = rows.join(sizes, ["t", "key"]).withColumn("parts", parts).withColumn("own", own)
    dealt = placed.select("t", "key", "own", "fp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    lists = dealt.groupBy("t", "key", low, high).agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    @F.arrow_udf("array<struct<u:long,v:long>>")
    def forest(batch: pa.Array) -> pa.Array:
        values = batch.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(batch.value_lengths().to_numpy(zero_copy_only=False))
        u, v, sizes = [], [], []
        for at, end in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
            own = np.sort(values[at:end])
            root = _roots(own, max_bits)
            linked = np.flatnonzero(root != np.arange(len(own)))
            u.append(own[linked])
            v.append(own[root[linked]])
            sizes.append(len(linked))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        flat = [pa.array(np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64)) for x in (u, v)]
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(flat, ["u", "v"]))

    return lists.select(F.explode(forest("fps")).alias("e")).select("e.u", "e.v")


def _roots(values: np.ndarray, max_bits: int) -> np.ndarray:
    """Index of the first value that each value reaches by steps of `max_bits` bits or fewer."""
    bits = values.view(np.uint64)
    root = np.full(len(bits), -1)
    for start in range(len(bits)):
        if root[start] >= 0:
            continue
        root[start] = start
        free = np.flatnonzero(root < 0)
        todo = [start]
        while todo and len(free):
            near = np.bitwise_count(bits[free] ^ bits[todo.pop()]) <= max_bits
            todo.extend(free[near].tolist())
            root[free[near]] = start
            free = free[~near]
    return root


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, tile: int = TILE
) -> DataFrame:
    """One row per row of `docs`: `id`, `key` (see `row_key`), `fp`, `root` (a fingerprint per group) and `component_id`.

    Rows whose fingerprints differ in `max_bits` bits or fewer are linked, and `component_id` is the smallest id
    that links reach. Equal fingerprints are folded before any pairing, so copies cost nothing. Null and wordless
    texts share fingerprint 0. Null ids keep their rows; a component of null ids only has a null id. Repeated rows
    come out as often as they come in. Empty tables give no rows.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(docs).alias("key"))
    marked = saved(fingerprints(keyed, shingle=shingle).select("id", "key", "fp"))
    distinct = saved(marked.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = components(close_links(distinct.select("fp"), max_bits, tile))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(classes, "fp").select("id", "key", "fp", "root", "component_id")


def fingerprint_text(column: str = "fp") -> F.Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """`docs` with one row of each near-duplicate group: that with the smallest id, then the smallest row key.

    Equal rows of one id are one row. Ids that are null come last.
    """
    found = saved(near_duplicates(docs, id_col, **how).groupBy("root", "id", "key").agg(F.count(F.lit(1)).alias("n")))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "n")).alias("w")
    chosen = found.groupBy("root").agg(first).select(F.col("root").alias("_root"), "w.id", "w.key", "w.n")
    chosen = saved(chosen.withColumnsRenamed({"id": "_id", "key": "_key", "n": "_n"}))
    same = (F.col("root") == F.col("_root")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    kept = without_rows(docs, found.join(chosen, same, "left_anti").select("id", "key"), id_col)
    again = chosen.where("_n > 1").select("_id", F.col("_key").alias("_tw_chosen"))
    if again.isEmpty():
        return kept
    equal = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_tw_key") == F.col("_tw_chosen"))
    keyed, again = kept.withColumn("_tw_key", row_key(kept)), sent_if_few(again)
    single = keyed.join(again, equal, "left_anti")
    return single.unionByName(keyed.join(again, equal, "left_semi").dropDuplicates([id_col, "_tw_key"])).drop("_tw_key")
