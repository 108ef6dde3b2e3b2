"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, saved, sent_by_value

# Slots of hashed terms, factors of a term, and beginnings of a word that are terms beside the word.
SLOTS, FACTORS, HEADS = 1 << 18, 4, (3, 4, 5, 6, 7)
# Labelled texts of each class that the model is fitted on at most: those of the smallest hashes.
MOST_ROWS = 12_000
EPOCHS, BATCH, RATE, SHRINK, SURE = 5, 128, 0.1, 1e-3, 3.0
# Value of a term that the classes do not tell apart.
LEAST_VALUE = 0.05
# Words whose terms are kept in a task.
KEPT_WORDS = 400_000

_WORD = re.compile(r"[^\W_]+")


class Terms:
    """Slots of the distinct terms of texts: words in lower case, and the beginnings of longer ones."""

    def __init__(self, slots: int):
        self.slots, self.known = slots, {}
        self.table = np.empty((1 << 12, len(HEADS) + 1), np.int32)

    def _add(self, word: str) -> int:
        at = len(self.known)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        parts = [word, *("^" + word[:n] if len(word) > n else word for n in HEADS)]
        self.table[at] = [xxhash.xxh3_64_intdigest(p) % self.slots for p in parts]
        self.known[word] = at
        return at

    def of(self, text: str) -> np.ndarray:
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        get, add = self.known.get, self._add
        rows = [at if (at := get(w)) is not None else add(w) for w in set(_WORD.findall(text.lower()))]
        return np.unique(self.table[rows]) if rows else np.empty(0, np.int32)


class Machine:
    """A factorization machine over the distinct terms of a text, each of which has a value.

    A text's margin is the bias, the sum of its terms' weights times values, and the products of all pairs of its terms by their factors and
    values. In the products the values of a text are brought to unit length, so that long texts have no more pairs than short ones.
    """

    def __init__(self, slots: int = SLOTS, factors: int = FACTORS):
        self.bias = np.zeros(1, np.float32)
        self.values = np.full(slots, LEAST_VALUE, np.float32)
        self.weights = np.zeros(slots, np.float32)
        self.factors = np.zeros((slots, factors), np.float32)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.bias, self.values, self.weights, self.factors

    def _parts(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Margins, the sum of the valued factors of each text, and the squared length of its values."""
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        held = sizes > 0
        z, pair = np.full(len(sizes), self.bias[0], np.float32), np.zeros((len(sizes), self.factors.shape[1]), np.float32)
        length = np.ones(len(sizes), np.float32)
        if held.any():
            value = self.values[ids]
            own = self.factors[ids] * value[:, None]
            pair[held] = np.add.reduceat(own, starts[held], axis=0)
            length[held] = np.add.reduceat(value**2, starts[held])
            squares = np.add.reduceat(np.einsum("ij,ij->i", own, own), starts[held])
            z[held] += np.add.reduceat(self.weights[ids] * value, starts[held])
            z[held] += 0.5 * ((pair[held] ** 2).sum(axis=1) - squares) / length[held]
        return z, pair, length

    @staticmethod
    def joined(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The terms of texts, end to end, and how many each has."""
        return np.concatenate([*lists, np.empty(0, np.int32)]).astype(np.int64), np.array([len(x) for x in lists], np.int64)

    def scores(self, lists: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._parts(*self.joined(lists))[0].astype(np.float64), -60, 60)))

    def fit(self, lists: list[np.ndarray], labels: np.ndarray, odds: float | None = None) -> None:
        """Values from the counts of each class, then steps of AdaGrad in an order that depends on nothing but the rows.

        A term's value is the log of the ratio of its rates in the two classes, drawn towards 0 by `SURE` standard errors, but no less
        than `LEAST_VALUE`. So no term is left out: one that is as frequent in both classes starts with the weight 0, and its pairs with others
        are learnt like all. `odds` of the classes among all labelled rows correct the bias where the rows given are fewer of one class.
        """
        every, n = np.concatenate(lists), len(self.values)
        toxic = np.repeat(labels, [len(x) for x in lists]) > 0
        counts = [np.bincount(every[at], minlength=n) + 1.0 for at in (toxic, ~toxic)]
        rates = [c / (k + 2.0) for c, k in zip(counts, (labels.sum(), (1 - labels).sum()), strict=True)]
        ratio = np.log(rates[0] / rates[1])
        error = np.sqrt(1 / counts[0] + 1 / counts[1])
        clear = np.maximum(0, np.abs(ratio) - SURE * error)
        self.values[:] = np.where(clear > LEAST_VALUE, np.sign(ratio) * clear, LEAST_VALUE)
        self.weights[:] = np.where(clear > LEAST_VALUE, 0.5, 0.0)
        self.factors[:] = np.random.default_rng(5).normal(0, 0.05, self.factors.shape)
        given = np.log(max(labels.mean(), 1e-3) / max(1 - labels.mean(), 1e-3))
        self.bias[0] = given
        held = [np.full_like(x, 1e-4) for x in (self.bias, self.weights, self.factors)]
        for epoch in range(EPOCHS):
            order = np.random.default_rng(epoch).permutation(len(lists))
            for at in range(0, len(order), BATCH):
                own = order[at : at + BATCH]
                ids, sizes = self.joined([lists[i] for i in own])
                z, pair, length = self._parts(ids, sizes)
                wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[own]).astype(np.float32)
                slots, place = np.unique(ids, return_inverse=True)
                value = self.values[ids]
                each = np.repeat(wrong, sizes) * value
                grad_w = np.bincount(place, each, len(slots)) + SHRINK * self.weights[slots]
                push = (each / np.repeat(length, sizes))[:, None] * (np.repeat(pair, sizes, axis=0) - self.factors[ids] * value[:, None])
                grad_v = np.stack([np.bincount(place, push[:, f], len(slots)) for f in range(push.shape[1])], axis=1) + SHRINK * self.factors[slots]
                for param, past, where, grad in (
                    (self.bias, held[0], slice(None), np.array([wrong.sum()])),
                    (self.weights, held[1], slots, grad_w),
                    (self.factors, held[2], slots, grad_v),
                ):
                    past[where] += (grad**2).astype(np.float32)
                    param[where] -= (RATE * grad / np.sqrt(past[where])).astype(np.float32)
        if odds is not None:
            self.bias[0] += np.log(odds) - given


def held_out(id_col: str = "doc_id"):
    """Rows that no model is fitted on: CRC-32 of the id as text, modulo 3, is 1. False for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = MOST_ROWS) -> Machine:
    """A machine fitted on labelled rows that are not held out, `most_rows` of each class at most, with the bias of the odds among all of them.

    The chosen ids are few by that bound and go to all tasks; the texts stay where they are and become slots there.
    Only those of the chosen rows meet in the one task that fits. Without labelled rows of both classes all scores are 0.5.
    """
    bounded_batches(docs.sparkSession)
    known = labels.where(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    n_all, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    odds = n_toxic / (n_all - n_toxic) if 0 < n_toxic < n_all else None
    order = (F.xxhash64("id"), F.col("id"))
    chosen = saved(known.where("y = 1").orderBy(*order).limit(most_rows).unionByName(known.where("y = 0").orderBy(*order).limit(most_rows)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id")

    @F.arrow_udf("array<int>")
    def slots(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms = Terms(SLOTS)
        for batch in batches:
            yield pa.array([terms.of(t or "") for t in batch.to_pylist()], pa.list_(pa.int32()))

    rows = saved(texts.select("id", "y", slots("text").alias("slots")))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, marks = [], []
        for batch in batches:
            lists += [x.values.to_numpy() for x in batch.column(1)]
            marks += batch.column(0).to_pylist()
        machine = Machine()
        if 0 < sum(marks) < len(marks):
            machine.fit(lists, np.array(marks, np.float32), odds)
        yield pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in machine.arrays()], list("buwv"))

    fitted = rows.orderBy("id").select("y", "slots").coalesce(1).mapInArrow(learn, "b binary, u binary, w binary, v binary").first()
    machine = Machine()
    if fitted is not None:
        machine.bias, machine.values, machine.weights = (np.frombuffer(fitted[k], np.float32) for k in "buw")
        machine.factors = np.frombuffer(fitted["v"], np.float32).reshape(SLOTS, FACTORS)
    return machine


def with_scores(docs: DataFrame, machine: Machine, text_col: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the toxicity of each whole text, from 0 to 1. Null and empty texts get the score of no terms; every row
    gives one row, an empty table none."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = sent_by_value(spark, machine)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms, model = Terms(SLOTS), pickle.loads(sent.value)
        for batch in batches:
            yield pa.array(model.scores([terms.of(t or "") for t in batch.to_pylist()]))

    return docs.withColumn(name, score(F.col(text_col).cast("string")))
