"""Token counts: whole texts through a public tokenizer, lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, piece_calls

# Characters after which a text is cut at the next safe space, and bytes encoded in one call.
PIECE_CHARS = 1 << 15
CALL_BYTES = 1 << 20


def _sentencepiece(model: bytes):
    """Encoder of a SentencePiece model, and whether a cut drops its space, as each piece gets one in front.

    Cuts are safe if no piece of the vocabulary runs over a space and a cut text gives the same ids.
    """
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    parts = processor.encode(["ab 1", "cd, ef"])
    safe = all("▁" not in p.strip("▁") and (p.startswith("▁") or not p.endswith("▁")) for p in pieces) and (
        parts[0] + parts[1] == processor.encode("ab 1 cd, ef")
    )
    return lambda texts: map(len, processor.encode(texts, num_threads=1)), safe, True


def _tokenizers(model: bytes):
    """Encoder of a tokenizer file. Its splitters never join the characters on both sides of a cut; the space stays."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(model.decode())
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)], True, False


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text", limit: int = 4096, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """`docs` with `n_bytes`, `n_tokens` and `over_limit`, as the library of `model_path` (.model or .json) counts.

    No begin, end or added tokens; special strings are treated as the library does by default; nothing is cut
    off. The tokenizer file is read on the driver (its size is that of a vocabulary) and sent to the workers. A
    batch is cut into pieces at safe spaces and packed into calls of equal bytes, so one long text neither
    fills a call nor holds up short ones; only lengths come back. A null text counts as empty. Every row gives one
    row, repeated ones too; an empty table gives none; columns of the three names are replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    load = _sentencepiece if model_path.endswith(".model") else _tokenizers

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode, safe, drop_space = load(model.value)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.to_pylist()]
            counts = [0] * len(texts)
            for pieces, rows in piece_calls(texts, piece_chars if safe else None, CALL_BYTES, drop_space):
                for row, n in zip(rows, encode(pieces), strict=True):
                    counts[row] += n
            yield pa.array(counts, pa.int64())

    text = F.col(text_col).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return docs.withColumns({"n_bytes": size, "n_tokens": lengths(text)}).withColumn("over_limit", F.col("n_tokens") > limit)
