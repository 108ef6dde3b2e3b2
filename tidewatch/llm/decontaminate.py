"""Benchmark decontamination by latent semantic retrieval, longest common subsequence and answer checks."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, row_key, saved, sent_by_value

# Words of the benchmark that one search takes; a larger benchmark is searched in blocks.
BLOCK_WORDS = 64_000
# Items longer than this are searched for in parts.
PART_WORDS = 64
# Words of a passage, by the least words of the items that it is compared with; passages start every half of it.
PASSAGES = {8: 1, 16: 12, 32: 24}
# Passages that one row of the fit holds, and that are multiplied at once; terms whose sums travel as one row, and the most frequent
# ones, which are multiplied as a full matrix.
FIT_ROWS, FIT_AT_ONCE, FIT_TERMS, FIT_DENSE = 8192, 512, 4096, 384
# Weight of the benchmark's rows in the fit, rank of the randomised decomposition, and its oversampling.
ITEM_WEIGHT, RANK, EXTRA = 16.0, 96, 16
# Least cosine of a candidate; share of an item's words that must be found in order, without and with its answer.
COSINE, COPY, PARAPHRASE = 0.1, 0.8, 0.55
# Rarest words of an item that stand for its answer where none is given.
ANSWER_WORDS = 3
# Passages projected at once, and what 32-bit sums may be off by.
MOST_ROWS, ROUNDING = 512, 1e-4

_TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Lower-case words; ASCII characters other than letters and digits separate them."""
    return text.lower().encode().translate(_TABLE).split()


class Items:
    """One block of the benchmark: parts of items as term numbers, and the words themselves."""

    def __init__(self, rows: list[tuple[int, str, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.owner, self.ids, self.answers = [], [], []
        for number, (_, text, answer) in enumerate(rows):
            words = terms(text)
            pieces = -(-len(words) // PART_WORDS)
            for part in np.array_split(np.arange(len(words)), max(1, pieces)):
                if len(part):
                    self.owner.append(number)
                    self.ids.append(np.array([self.vocabulary.setdefault(words[i], len(self.vocabulary) + 1) for i in part]))
                    given = None if answer is None else [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in terms(answer)]
                    self.answers.append(given)
        self.size = len(self.vocabulary) + 1  # 0 stands for all other words
        width = np.array([max(w for w, least in PASSAGES.items() if len(x) >= least) for x in self.ids])
        self.scales = [(w, np.flatnonzero(width == w)) for w in PASSAGES if (width == w).any()]

    def numbers(self, text: str) -> np.ndarray:
        words = terms(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))


def term_weights(counts: np.ndarray, n_docs: int) -> np.ndarray:
    """Weight of each term, by the documents that hold it alone. 0, any word outside the benchmark, counts as the rarest."""
    weights = np.log((1 + n_docs) / (1 + counts)) + 0.01
    weights[0] = np.log(1 + n_docs) + 0.01
    return weights


class Space:
    """A latent space: the weight of each term, its axes, and the items in it."""

    def __init__(self, items: Items, weights: np.ndarray, axes: np.ndarray, counts: np.ndarray | None = None):
        pad = items.size  # stands behind the end of a text
        self.square = np.append(weights**2, 0.0)
        self.square[0] = 0.0
        self.other = float(weights[0] ** 2)
        self.counts = counts
        self.axes = np.vstack([axes * weights[:, None], np.zeros((1, axes.shape[1]))]).astype(np.float32)
        self.axes[0] = 0
        known = [np.unique(x) for x in items.ids]
        made = np.array([self.axes[x].sum(axis=0) for x in known], np.float32).reshape(len(known), -1)
        sizes = np.sqrt(np.array([self.square[x].sum() for x in known]))
        self.queries = (made / np.maximum(sizes, 1e-9)[:, None]).astype(np.float32)
        self.rest = np.sqrt(np.maximum(0.0, 1.0 - (self.queries.astype(np.float64) ** 2).sum(axis=1)))
        self.pad = pad
        for at, given in enumerate(items.answers):
            if given is None:
                items.answers[at] = known[at][np.argsort(-self.square[known[at]], kind="stable")][:ANSWER_WORDS].tolist()

    def candidates(
        self, texts: list[np.ndarray], width: int, chosen: np.ndarray, least: float, seeds: Seeds | None = None
    ) -> Iterator[tuple[int, int, int, float]]:
        """Passages and items that may have a cosine of `least` or more, as (text, start, item part, cosine).

        Passages are two neighbouring half blocks, each compared with the items whose seeds it holds, or without seeds with
        all. The cosine over benchmark terms is at most the product in the latent space plus that of the parts outside it, by
        their lengths, so a passage and an item below `least` by this bound are passed over without loss. The cosine given is the
        latent one, over the length of all the passage's words.
        """
        half = width // 2
        sizes = np.array([max(2, -(-len(x) // half)) for x in texts])
        first = np.concatenate([[0], np.cumsum(sizes)])
        blocks = np.full(first[-1] * half, self.pad, np.int32)
        for at, x in zip(first, texts, strict=False):
            blocks[at * half : at * half + len(x)] = x
        blocks = blocks.reshape(-1, half)
        if seeds is None:
            known = self.square[blocks].sum(axis=1)
            rows = np.flatnonzero(known[:-1] + known[1:])
            row, part = np.repeat(rows, len(chosen)), np.tile(chosen, len(rows))
        else:
            row, part = seeds.meetings(blocks)
        inner = ~np.isin(row, np.append(first[1:] - 1, -1))  # not those before the first text, across two, or past the last
        row, part = row[inner], part[inner]
        order = np.argsort(row, kind="stable")
        rows, starts = np.unique(row[order], return_index=True)
        starts = np.append(starts, len(order))
        owner = np.searchsorted(first, rows, side="right") - 1
        for at in range(0, len(rows), MOST_ROWS):
            own = rows[at : at + MOST_ROWS]
            ids = np.sort(np.hstack([blocks[own], blocks[own + 1]]), axis=1)
            counted = self.square[ids] > 0
            counted[:, 1:] &= ids[:, 1:] != ids[:, :-1]
            square = (self.square[ids] * counted).sum(axis=1)
            made = np.add.reduceat(self.axes[ids[counted]], np.concatenate([[0], np.cumsum(counted.sum(axis=1))[:-1]]), axis=0)
            outside = np.sqrt(np.maximum(0.0, square - (made.astype(np.float64) ** 2).sum(axis=1)))
            whole = np.sqrt(square + (ids == 0).sum(axis=1) * self.other)
            pairs = order[starts[at] : starts[at + len(own)]]
            mine, asked = np.searchsorted(own, row[pairs]), part[pairs]
            product = np.einsum("ij,ij->i", made[mine], self.queries[asked])
            bound = (product + outside[mine] * self.rest[asked]) / np.sqrt(square[mine])
            for hit in np.flatnonzero(bound >= least - ROUNDING).tolist():
                text = int(owner[at + mine[hit]])
                yield text, int(own[mine[hit]] - first[text]) * half, int(asked[hit]), float(product[hit] / whole[mine[hit]])


class Seeds:
    """The words by which a passage meets items: of each item so many of its rarest that every finding holds one of them.

    A share of `copy` of an item's words leaves out so few of them that one more of its rarest words are never all left out. A
    paraphrase holds all words of the answer, so also the rarest of these.
    """

    def __init__(self, items: Items, counts: np.ndarray, chosen: np.ndarray, copy: float):
        found: list[tuple[int, int]] = []
        for part in chosen.tolist():
            ids, answer = items.ids[part], items.answers[part]
            left_out = sum((len(ids) - m) / len(ids) >= copy for m in range(1, len(ids) + 1))
            words = set(ids[np.argsort(counts[ids], kind="stable")][: left_out + 1].tolist())
            if answer:
                words.add(min(answer, key=lambda w: (counts[w], w)))
            found.extend((word, part) for word in words)
        found.sort()
        pairs = np.array(found, np.int64).reshape(-1, 2)
        self.parts = pairs[:, 1]
        self.sizes = np.bincount(pairs[:, 0], minlength=items.size + 1)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def in_text(self, ids: np.ndarray) -> bool:
        return bool(self.sizes[ids].any())

    def meetings(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages (by their first half block) and item parts of which they hold a seed."""
        at = np.flatnonzero(self.sizes[blocks.ravel()])
        words = blocks.ravel()[at]
        many = self.sizes[words]
        block = np.repeat(at // blocks.shape[1], many)
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        part = self.parts[np.repeat(self.starts[words], many) + within]
        pairs = np.unique(np.column_stack([np.concatenate([block - 1, block]), np.concatenate([part, part])]), axis=0)
        return pairs[:, 0], pairs[:, 1]


def common_words(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence, a machine word of the item at a time."""
    masks: dict[int, int] = {}
    for at, x in enumerate(item.tolist()):
        masks[x] = masks.get(x, 0) | 1 << at
    full = (1 << len(item)) - 1
    row = full
    for x in region.tolist():
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def _checked(texts: list[np.ndarray], items: Items, space: Space, seeds: list[Seeds], least: float, copy: float, paraphrase: float) -> list[list[dict]]:
    """The best verified finding of each item in each text. Regions hold every stretch of an item's reach that meets the passage."""
    best: list[dict[int, dict]] = [{} for _ in texts]
    for (width, chosen), own in zip(items.scales, seeds, strict=True):
        met = [n for n, ids in enumerate(texts) if own.in_text(ids)]
        if not met:
            continue
        for at, start, part, cosine in space.candidates([texts[n] for n in met], width, chosen, least, own):
            item, ids, reach = items.ids[part], texts[met[at]], len(items.ids[part]) + len(items.ids[part]) // 2
            low, high = max(0, start - reach), min(len(ids), start + width + reach)
            there = set(ids[low:high].tolist())
            if sum(w in there for w in item.tolist()) < paraphrase * len(item) or common_words(item, ids[low:high]) < paraphrase * len(item):
                continue
            answer, owner = set(items.answers[part] or ()), items.owner[part]
            for begin in range(low, max(low + 1, high - len(item) + 1), max(1, len(item) // 8)):
                stretch = ids[begin : begin + reach]
                share = common_words(item, stretch) / len(item)
                if share < paraphrase or share <= best[met[at]].get(owner, {"lcs": 0.0})["lcs"]:
                    continue
                if share >= copy or (answer and answer <= set(stretch.tolist())):
                    best[met[at]][owner] = {"item": owner, "cosine": cosine, "lcs": share, "start": begin, "end": min(len(ids), begin + reach)}
    return [[found[k] for k in sorted(found)] for found in best]


def _passages(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct benchmark terms of each passage (a row of term numbers), one passage after the other, and how many each has."""
    ids = np.sort(ids, axis=1)
    known = ids > 0
    known[:, 1:] &= ids[:, 1:] != ids[:, :-1]
    sizes = known.sum(axis=1)
    return ids[known], sizes[sizes > 0]


def _packed(passages: np.ndarray, size: int) -> Iterator[tuple[bytes, bytes]]:
    """Passages as rows of the fit: terms, of which there are `size`, and how many each passage has."""
    kind = np.min_scalar_type(size).newbyteorder("<")
    for at in range(0, len(passages), FIT_ROWS):
        terms_, sizes = _passages(passages[at : at + FIT_ROWS])
        if len(sizes):
            yield terms_.astype(kind).tobytes(), sizes.astype("<i4").tobytes()


def _read(docs: DataFrame, items: Items) -> DataFrame:
    """One pass over all texts: documents per term (`term`, `n`), and all their passages for the fit (`ids`, `sizes`)."""
    width = max(PASSAGES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(items.size, np.int64)
        names = ["term", "n", "ids", "sizes"]
        for batch in batches:
            parts = []
            for text in batch.column(0).to_pylist():
                ids = items.numbers(text or "")
                counts[np.unique(ids)] += 1
                parts += [ids, np.zeros(-len(ids) % width, np.int32)]
            for ids, sizes in _packed(np.concatenate(parts).reshape(-1, width) if parts else np.zeros((0, width), np.int32), items.size):
                columns = [pa.array([None], pa.int32()), pa.array([None], pa.int64()), pa.array([ids], pa.binary()), pa.array([sizes], pa.binary())]
                yield pa.record_batch(columns, names)
        none = pa.nulls(items.size, pa.binary())
        yield pa.record_batch([pa.array(range(items.size), pa.int32()), pa.array(counts), none, none], names)

    return docs.select("text").mapInArrow(read, "term int, n long, ids binary, sizes binary")


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray, source: np.ndarray) -> None:
    """Add `source[rows]` to `out[at]`, `at` being sorted: the first of each place at once, then the second, and so on."""
    begins = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    many = np.diff(np.append(begins, len(at)))
    while len(begins):
        out[at[begins]] += source[rows[begins]]
        more = many > 1
        begins, many = begins[more] + 1, many[more] - 1


def _summed(parts: DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Sums of the arrays `part` of each number `at`, added up in Spark, so that what comes back does not grow with the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held[at] = held.get(at, 0) + np.frombuffer(part, np.float32).astype(np.float64)
        for at, total in held.items():
            yield pa.record_batch([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["at", "part"])

    for row in parts.repartition("at").mapInArrow(add, "at int, part binary").toLocalIterator():
        yield row["at"], np.frombuffer(row["part"], np.float64)


def _axes(rows: DataFrame, idf: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the weighted passages (`weight, ids, sizes`, see `_packed`) by a randomised range finder, a power
    step and Nyström's formula, which needs no third pass.

    Every product with the matrix is a Spark job: tasks hold rows and return a sum of bounded size.
    """
    width, size = min(len(idf), rank + EXTRA), len(idf)
    kind, context = np.min_scalar_type(size).newbyteorder("<"), rows.sparkSession.sparkContext
    often = np.argsort(idf, kind="stable")[:FIT_DENSE]
    often = often[often > 0]

    def product(right: np.ndarray) -> np.ndarray:
        sent = context.broadcast((right * idf[:, None]).astype(np.float32))

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            side = sent.value
            slot = np.full(size, -1)
            slot[often] = np.arange(len(often))
            out, dense = np.zeros((size, width)), np.zeros((len(often), width))
            for batch in batches:
                for weight, packed, counted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    terms_, sizes = np.frombuffer(packed, kind), np.frombuffer(counted, "<i4")
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    for at in range(0, len(sizes), FIT_AT_ONCE):
                        many = sizes[at : at + FIT_AT_ONCE]
                        own, row = terms_[ends[at] : ends[at + len(many)]], np.repeat(np.arange(len(many)), many)
                        place = slot[own]
                        full = np.zeros((len(many), len(often)), np.float32)
                        full[row[place >= 0], place[place >= 0]] = 1
                        made, own, row = full @ side[often], own[place < 0], row[place < 0]
                        _add_rows(made, row, own, side)
                        made *= weight * weight
                        dense += full.T @ made
                        order = np.argsort(own, kind="stable")
                        _add_rows(out, own[order], row[order], made)
            out[often] += dense
            out *= idf[:, None]
            for at in range(0, len(out), FIT_TERMS):
                part = out[at : at + FIT_TERMS].astype(np.float32).tobytes()
                yield pa.record_batch([pa.array([at], pa.int32()), pa.array([part], pa.binary())], ["at", "part"])

        total = np.zeros((size, width))
        for at, part in _summed(rows.mapInArrow(multiply, "at int, part binary")):
            total[at : at + FIT_TERMS] = part.reshape(-1, width)
        sent.destroy()
        return total

    basis = np.linalg.qr(product(np.random.default_rng(11).standard_normal((size, width))))[0]
    made = product(basis)
    values, vectors = np.linalg.eigh(basis.T @ made)
    sure = values > values.max() * 1e-6  # 32-bit sums tell no less
    root = made @ (vectors[:, sure] / np.sqrt(values[sure]))
    return np.linalg.svd(root, full_matrices=False)[0][:, :rank]


def fitted(docs: DataFrame, items: Items, rank: int = RANK) -> Space:
    """The latent space of a block: term weights over all documents of `docs` (`text`), axes of all their passages and the items."""
    spark = docs.sparkSession
    n_docs = docs.count()
    seen = saved(_read(docs, items))
    counts = np.zeros(items.size)
    for row in seen.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["term"]] = row["n"]
    idf = term_weights(counts, n_docs)
    padded = np.zeros((len(items.ids), PART_WORDS), np.int64)
    for row, ids in zip(padded, items.ids, strict=True):
        row[: len(ids)] = ids
    kind = "weight float, ids binary, sizes binary"
    asked = spark.createDataFrame([(ITEM_WEIGHT, *row) for row in _packed(padded, items.size)], kind)
    rows = seen.where("term IS NULL").select(F.lit(1.0).cast("float").alias("weight"), "ids", "sizes").unionByName(asked)
    return Space(items, idf, _axes(rows, idf, min(len(idf), rank)), counts)


def _search(spark: SparkSession, items: Items, space: Space, limits: tuple[float, float, float]):
    """The Arrow function that lists the verified findings of each text."""
    seeds = [Seeds(items, space.counts, chosen, limits[1]) for _, chosen in items.scales]
    sent, held = sent_by_value(spark, (items, space, seeds)), []
    fields = [("item", pa.int32()), ("cosine", pa.float64()), ("lcs", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]

    @F.arrow_udf("array<struct<item:int,cosine:double,lcs:double,start:int,end:int>>")
    def search(texts: pa.Array) -> pa.Array:
        if not held:  # once in a task
            held.extend(pickle.loads(sent.value))
        own, known, asked = held
        numbers = [own.numbers(t or "") for t in texts.to_pylist()]
        return pa.array(_checked(numbers, own, known, asked, *limits), pa.list_(pa.struct(fields)))

    return search


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    cosine: float = COSINE,
    copy: float = COPY,
    paraphrase: float = PARAPHRASE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of `docs` and benchmark item found in it: `id`, `key` (see `row_key`), `item_id`, `cosine`, `lcs`
    (share of the item's words found in order), `start` and `end` (words).

    Passages are TF-IDF vectors over the benchmark's terms, with document counts over all texts. A randomised decomposition,
    fitted on all items and all passages of all texts (`PASSAGES`' longest, one after the other), gives the latent space in which the passages of every text are compared with the items of which they hold a word that no finding can do
    without (see `Seeds`). Candidates that may have a cosine of `cosine` or more are verified:
    `copy` of the item's words in order, or `paraphrase` of them and every word of its answer. Without an answer
    column the rarest words stand for it. An item over `PART_WORDS` words is found by any of its parts. The benchmark is
    read in blocks of about `block_words` words, so what is sent to the workers is bounded. Null or wordless texts and items match
    nothing; repeated rows each give their rows; empty tables give none.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), row_key(docs).alias("key"), F.col(text_col).cast("string").alias("text"))
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    asked = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"), answer.alias("answer"))
    asked = asked.where("text IS NOT NULL").distinct()
    words = asked.agg(F.sum(F.size(F.split("text", "[^\\p{L}\\p{N}]+"))).alias("n")).first()["n"] or 0
    blocks = int(words // block_words + 1)
    placed = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = spark.createDataFrame([], "id long, key long, item_id long, cosine double, lcs double, start int, end int")
    for block in range(blocks):
        listed = [(r["item_id"], r["text"], r["answer"]) for r in placed.where(F.col("block") == block).orderBy("item_id", "text", "answer").collect()]
        items = Items(listed)
        if not items.ids:
            continue
        search = _search(spark, items, fitted(rows, items), (cosine, copy, paraphrase))
        numbers = F.array(*[F.lit(n).cast("long") for n, _, _ in listed])
        hits = rows.select("id", "key", F.explode(search("text")).alias("h"))
        found = found.unionByName(hits.select("id", "key", numbers[F.col("h.item")].alias("item_id"), "h.cosine", "h.lcs", "h.start", "h.end"))
    return found
