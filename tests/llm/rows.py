"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import os
import random

FOLDER = "/root/testdata/sf0.001"
HAVE_TABLES = os.path.isdir(FOLDER)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, fp double, spans string, n_tokens string, kept int, h int"

_draw = random.Random(3)
WORDS = ["".join(_draw.choice("abcdeghilmnoprstuvé") for _ in range(_draw.randint(2, 9))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    lines = []
    while n > 0:
        k = min(n, draw.randint(6, 14))
        lines.append(" ".join(draw.choice(WORDS) for _ in range(k)).capitalize() + ".")
        n -= k
    return "\n".join(lines)


def odd_texts() -> list[tuple[int | None, str | None]]:
    body = prose(120, 1)
    return [
        (1, body),
        (2, body),
        (2, body),
        (3, body.encode().upper().decode()),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (7, "one two"),
        (8, prose(20_000, 2)),
        (9, "x" * 60_000),
        (None, body),
        (None, prose(90, 3)),
        (11, prose(30, 4) + "\n" + prose(70, 5) + "\n" + prose(30, 6)),
        (12, prose(25, 7) + "\n" + prose(70, 5) + "\n" + prose(25, 8)),
        (13, "İstanbul ǅ ﬁ 👩‍👩‍👧 é \x00   token: \"Abc123==\" ##"),
    ]


def docs(spark, texts=None):
    texts = odd_texts() if texts is None else texts
    rows = [(i, t, None if (i or 0) % 5 == 4 else "en", "s" if i != 7 else None, len(t or ""), "clash", "clash", 0.5, "clash", "clash", 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
