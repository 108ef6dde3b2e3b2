from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import rows
from tidewatch.llm import decontaminate, plans

BENCH = "item_id long, text string, answer string, id string"


def bench(spark, items):
    return spark.createDataFrame([(i, t, a, "clash") for i, t, a in items], BENCH)


def found(spark, texts, items, **how):
    got = decontaminate.leaks(rows.docs(spark, texts), bench(spark, items), **how)
    return {(r["id"], r["item_id"]) for r in got.collect()}


def corpus():
    items = [(n, rows.prose(15 + 2 * n, 500 + n), None) for n in range(20)]
    clean = [(n, rows.prose(100 + n, 900 + n)) for n in range(150)]
    return items, clean


def test_copies_edits_and_clean_texts(spark):
    items, clean = corpus()
    draw = random.Random(2)
    texts, truth = list(clean), set()
    for n, (item, text, _) in enumerate(items):
        words = text.split()
        edited = list(words)
        for at in draw.sample(range(len(words)), len(words) // 10):
            edited[at] = "changed"
        for kind, form in enumerate((text, text.upper(), " ".join(edited), " %%% ".join(words), text.replace("\n", " "))):
            texts.append((1000 + 10 * n + kind, rows.prose(draw.randint(0, 90), n) + " " + form + " " + rows.prose(70, 40 + n)))
            truth.add((1000 + 10 * n + kind, item))
    assert found(spark, texts, items) == truth


def test_leak_in_most_documents(spark):
    items, clean = corpus()
    texts = [(i, t + " " + items[3][1] if i % 3 else t) for i, t in clean]
    assert found(spark, texts, items) == {(i, 3) for i, _ in clean if i % 3}


def test_answers_decide_paraphrases(spark):
    words = [f"term{n}" for n in range(30)]
    half = " ".join(w if n % 3 else f"other{n}" for n, w in enumerate(words))
    texts = [(1, half + " the reply is fortytwo indeed"), (2, half + " the reply is missing"), *corpus()[1]]
    item = [(7, " ".join(words), "fortytwo")]
    assert found(spark, texts, item, answer_col="answer") == {(1, 7)}


def test_paraphrases_that_keep_frequent_words_and_the_answer(spark):
    """All that brute force finds by the longest common subsequence and the answer; other content words are replaced."""
    draw = random.Random(12)
    common = [f"often{n}" for n in range(60)]
    texts = [(n, " ".join([*draw.sample(common, 20), *rows.prose(60, 900 + n).split()])) for n in range(400)]
    items, truth = [], set()
    for n in range(20):
        words = [f"rare{n}x{k}" if k % 11 < 5 else draw.choice(common) for k in range(44)]
        answer = f"rare{n}x22 rare{n}x23"
        items.append((n, " ".join(words), answer))
        changed = [w if w in common or w in answer.split() else f"new{draw.randrange(10_000)}" for w in words]
        assert sum(a == b for a, b in zip(words, changed, strict=True)) >= decontaminate.PARAPHRASE * len(words)
        texts.append((2000 + n, rows.prose(50, n) + " " + " ".join(changed) + " " + rows.prose(50, n + 70)))
    block = decontaminate.Items(items)
    for doc, text in texts:
        ids = block.numbers(text)
        for item, own, answer in zip(range(20), block.ids, block.answers, strict=True):
            if set(answer) <= set(ids.tolist()) and decontaminate.common_words(own, ids) >= decontaminate.PARAPHRASE * len(own):
                truth.add((doc, item))
    assert len(truth) == 20 and found(spark, texts, items, answer_col="answer") == truth


def test_blocks_give_the_same(spark):
    items, clean = corpus()
    texts = [*clean, *((2000 + i, rows.prose(50, i) + " " + t) for i, t, _ in items)]
    assert found(spark, texts, items, block_words=200) == found(spark, texts, items) == {(2000 + i, i) for i, _, _ in items}


def test_odd_rows(spark):
    items = [(1, None, None), (2, "", None), (3, "  ", None), (4, rows.prose(120, 1), None), (4, rows.prose(120, 1), None), (None, rows.prose(90, 3), None)]
    got = found(spark, rows.odd_texts(), items)
    assert {(1, 4), (2, 4), (None, 4), (None, None)} <= got and {i for i, _ in got} == {1, 2, 3, None}
    assert found(spark, [], items) == set() and found(spark, rows.odd_texts(), []) == set()


def test_common_words():
    draw = random.Random(6)
    for _ in range(100):
        a, b = ([draw.randrange(6) for _ in range(draw.randint(1, 20))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_words(np.array(a), np.array(b)) == table[-1, -1]


def test_recall_of_the_latent_search_against_brute_force(spark):
    """Passages that full TF-IDF vectors rate `COSINE` or more are found in the latent space, 9 of 10 at least."""
    items, clean = corpus()
    texts = [*clean, *((2000 + i, rows.prose(50, i) + " " + t) for i, t, _ in items)]
    table = rows.docs(spark, texts).selectExpr("text")
    block = decontaminate.Items([(i, t, a) for i, t, a in items])
    space = decontaminate.fitted(table, block)
    numbers = [block.numbers(t) for _, t in texts]
    hit = total = 0
    for width, chosen in block.scales:
        near = {(t, s, p) for t, s, p, _ in space.candidates(numbers, width, chosen, decontaminate.COSINE)}
        weights = np.sqrt(space.square)
        for at, ids in enumerate(numbers):
            for start in range(0, max(1, len(ids) - width // 2), width // 2):
                window = ids[start : start + width]
                own = np.unique(window[window > 0])
                size = np.sqrt((weights[own] ** 2).sum() + (window == 0).sum() * space.other)
                for part in chosen:
                    asked = np.unique(block.ids[part])
                    both = np.intersect1d(own, asked)
                    cosine = (weights[both] ** 2).sum() / max(size, 1e-9) / np.sqrt((weights[asked] ** 2).sum())
                    if cosine >= decontaminate.COSINE * 1.05:
                        total += 1
                        hit += (at, start, int(part)) in near
    assert total > 30 and hit >= 0.9 * total


@pytest.mark.skipif(not rows.HAVE_TABLES, reason="no test tables")
def test_query_finds_all_copies(spark):
    folder = rows.FOLDER.replace("0.001", "0.01")

    def plain(text):
        return b" " + b" ".join(decontaminate.terms(text)) + b" "

    items = [(r["item_id"], plain(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    truth = {(r["doc_id"], i) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() for i, t in items if t in plain(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in plans.queries()["op10_decontaminate"](spark, folder).collect()}
    assert truth and truth <= got and len(got - truth) <= 0.02 * len(truth) + 1


@pytest.mark.parametrize("given", [False, True])
def test_seeds_lose_no_finding(spark, given):
    """Every stretch of a text that keeps enough of an item is found, whatever words were taken from it, and nothing else is."""
    draw = random.Random(21)
    items = [(n, rows.prose(8 + 6 * n, 700 + n), " ".join(draw.sample(rows.WORDS, 2)) if given else None) for n in range(16)]
    texts = [(n, rows.prose(80, 300 + n)) for n in range(100)]
    for n in range(200):
        _, text, answer = items[n % 16]
        keep = draw.uniform(0.5, 1.0)
        words = [w for w in text.split() if draw.random() < keep]
        words += [answer] if answer and draw.random() < 0.7 else []
        texts.append((1000 + n, f"{rows.prose(draw.randint(0, 40), n)} {' '.join(words)} {rows.prose(40, 60 + n)}"))
    block = decontaminate.Items(items)
    table = rows.docs(spark, texts).selectExpr("text")
    decontaminate.fitted(table, block)

    def holds(ids, own, answer, slack):
        reach = len(own) + len(own) // 2
        for at in range(max(1, len(ids) - len(own) + 1)):
            share = decontaminate.common_words(own, ids[at : at + reach]) / len(own)
            answered = bool(answer) and set(answer) <= set(ids[at : at + reach].tolist())
            if share >= decontaminate.COPY + slack or (share >= decontaminate.PARAPHRASE + slack and answered):
                return True
        return False

    sure, possible = set(), set()
    for doc, text in texts:
        ids = block.numbers(text)
        for item, own, answer in zip(block.owner, block.ids, block.answers, strict=True):
            if len(set(ids.tolist()) & set(own.tolist())) >= 0.3 * len(set(own.tolist())):
                if holds(ids, own, answer, 0.13):
                    sure.add((doc, item))
                if holds(ids, own, answer, 0.0):
                    possible.add((doc, item))
    got = found(spark, texts, items, answer_col="answer")
    assert len(sure) > 40 and sure <= got <= possible and len(got) > 0.9 * len(possible)


def test_equal_weights_at_every_size():
    """Weights depend on the counts alone, without steps."""
    counts = np.arange(0, 1000.0)
    weights = decontaminate.term_weights(counts, 1000)[1:]
    assert (np.diff(weights) < 0).all() and np.abs(np.diff(weights)).max() <= np.log(3 / 2) + 1e-9


def test_fit_takes_all_passages(spark):
    """The axes hold as much of all passages as the best ones do: those of the texts' subjects, which lie across the items."""
    draw = random.Random(31)
    words = [f"word{n}" for n in range(120)]
    block = decontaminate.Items([(n, " ".join(words[10 * n : 10 * n + 10]), None) for n in range(12)])
    texts = [(n, " ".join(" ".join(draw.choices(words[n % 4 :: 4], k=32)) for _ in range(40))) for n in range(60)]
    space = decontaminate.fitted(rows.docs(spark, texts).selectExpr("text"), block, 4)
    weights, matrix = np.sqrt(space.square[1:-1]), []
    for weight, ids in [*((1.0, block.numbers(t)) for _, t in texts), *((decontaminate.ITEM_WEIGHT, x) for x in block.ids)]:
        for at in range(0, len(ids), 32):
            matrix.append(np.zeros(block.size - 1))
            matrix[-1][ids[at : at + 32] - 1] = weight
    matrix = np.array(matrix) * weights
    axes = space.axes[1:-1] / weights[:, None]
    assert np.allclose(axes.T @ axes, np.eye(4), atol=1e-3)
    best = np.linalg.svd(matrix, compute_uv=False)[:4] ** 2
    assert ((matrix @ axes) ** 2).sum() > 0.99 * best.sum()
