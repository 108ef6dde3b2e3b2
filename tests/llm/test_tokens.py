from __future__ import annotations

import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tests.llm import rows
from tidewatch.llm import bpe, plans, token_counts
from tidewatch.llm.common import safe_pieces

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def table():
    return bpe.PairTable(bpe.read_ranks(RANKS))


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


ODD = [t or "" for _, t in rows.odd_texts()] + [
    " a", "a ", "  a  b", "▁▁a ▁b", "<s> </s> <unk> a", "don't  we'll\n\n\nI'm", "1234567 89", " x　y", "a\tb\r\nc", "日本語 テキスト"]


def test_counts_as_the_library(spark):
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    table = rows.docs(spark, list(enumerate(ODD)))
    for limit in (7, 50, token_counts.PIECE_CHARS):
        got = token_counts.count_tokens(table, PIECES, piece_chars=limit).orderBy("doc_id").collect()
        assert [r["n_tokens"] for r in got] == [len(processor.encode(t)) for t in ODD]
        assert [r["n_bytes"] for r in got] == [len(t.encode()) for t in ODD]
        assert [r["over_limit"] for r in got] == [len(processor.encode(t)) > 4096 for t in ODD]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_of_tokenizer_files(spark, name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    got = token_counts.count_tokens(rows.docs(spark, list(enumerate(ODD))), public_tokenizers.path(name), piece_chars=9).orderBy("doc_id")
    assert [r["n_tokens"] for r in got.collect()] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in ODD]


def test_pieces_make_the_text():
    for text in ODD:
        assert "".join(safe_pieces(text, 5)) == text
    assert all(len(p) < 80 for p in safe_pieces(rows.prose(500, 1), 20))


def test_null_empty_and_clashing(spark):
    got = token_counts.count_tokens(rows.docs(spark, [(1, None), (1, None), (2, "")]), PIECES)
    assert rows.pairs(got, "doc_id", "n_bytes", "n_tokens", "over_limit", "key") == [(1, 0, 0, False, "clash")] * 2 + [(2, 0, 0, False, "clash")]
    assert token_counts.count_tokens(rows.docs(spark, []), PIECES).count() == 0


def test_encodes_as_the_library(spark, reference):
    table = rows.docs(spark, list(enumerate(ODD)))
    got = bpe.encode(table, RANKS, public_tokenizers.PATTERN).orderBy("doc_id")
    back = bpe.decode(got, RANKS).collect()
    ids = [reference.encode_ordinary(t) for t in ODD]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in back] == ids
    assert [bytes(r["decoded"]).decode() for r in back] == ODD
    assert [(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in back] == [(len(i), digest(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in zip(ids, ODD, strict=True)]


def test_null_text_and_no_rows(spark):
    got = bpe.encode(rows.docs(spark, [(1, None), (1, None)]), RANKS, public_tokenizers.PATTERN)
    assert rows.pairs(got, "doc_id", "n_tokens", "ids_sha256") == [(1, 0, digest([]))] * 2
    assert bpe.encode(rows.docs(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_random_matches_and_long_runs(table, reference):
    draw = random.Random(4)
    words = [bytes(draw.choice(b"aabetions \xc3\xa9") for _ in range(draw.randint(1, 40))) for _ in range(2000)]
    words += [b"a" * 700, b"ab" * 900, b"the" * 400, bytes(draw.choice(b"ab") for _ in range(3000)), bytes(draw.choice(b"etaoin") for _ in range(2000))]
    got = bpe.encode_words(words, table)
    for word, ids in zip(words, got, strict=True):
        assert ids.tolist() == reference._core_bpe.encode_single_piece(word), word[:40]


def test_a_megabyte_without_a_break(table, reference):
    draw = random.Random(9)
    for word in (bytes(draw.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(1 << 20)), b"ab" * (1 << 18), "é".encode() * 100_000):
        began = time.perf_counter()
        (ids,) = bpe.encode_words([word], table)
        assert time.perf_counter() - began < 30
        assert ids.tolist() == reference._core_bpe.encode_single_piece(word)


def test_pair_table_finds_all_pairs(table):
    tokens = bpe.read_ranks(RANKS)
    ids = {t: i for i, t in enumerate(tokens)}
    draw = random.Random(5)
    for _ in range(300):
        a, b = draw.randrange(2000), draw.randrange(2000)
        want = ids.get(tokens[a] + tokens[b], bpe.NONE)
        assert table.merges(np.array([a]), np.array([b]))[0] == want


@pytest.mark.skipif(not rows.HAVE_TABLES, reason="no test tables")
def test_queries(spark, reference):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{rows.FOLDER}/documents.parquet").collect()}
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = {r["doc_id"]: r for r in plans.queries()["op2_token_counts"](spark, rows.FOLDER).collect()}
    codes = {r["doc_id"]: r for r in plans.queries()["op9_byte_bpe"](spark, rows.FOLDER).collect()}
    assert set(counts) == set(codes) == set(texts)
    for i, text in texts.items():
        ids = reference.encode_ordinary(text)
        assert counts[i]["n_tokens"] == len(processor.encode(text))
        assert (codes[i]["n_tokens"], codes[i]["ids_sha256"], codes[i]["decoded_sha256"]) == (len(ids), digest(ids), hashlib.sha256(text.encode()).hexdigest())
