"""Boolean trigram queries of regular expressions, as data for Spark expressions."""

from __future__ import annotations

import re
from itertools import product
from re import _constants as kind
from re import _parser as parser

# Texts that an expression may be spelled out into before the walk gives up on exact texts.
MOST_TEXTS = 16
# A query is a tuple of choices; a choice is a set of trigrams that must all be there. No choice set: any text.
ANY = (frozenset(),)


def _spelled(item: tuple) -> list[str] | None:
    """All texts that one parsed item stands for, in lower case, or None if these are many or endless."""
    op, value = item
    if op is kind.LITERAL:
        return [chr(value).lower()]
    if op is kind.IN:
        out: set[str] = set()
        for inner, x in value:
            if inner is kind.LITERAL:
                out.add(chr(x).lower())
            elif inner is kind.RANGE and x[1] - x[0] < MOST_TEXTS:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return sorted(out) if len(out) <= MOST_TEXTS else None
    if op is kind.SUBPATTERN:
        return _texts(value[-1])
    if op is kind.BRANCH:
        parts = [_texts(p) for p in value[1]]
        return None if None in parts else sorted({t for p in parts for t in p})
    if op is kind.MAX_REPEAT and value[1] != kind.MAXREPEAT and value[1] <= 4:
        one = _texts(value[2])
        if one is None:
            return None
        out = {"".join(p) for n in range(value[0], value[1] + 1) for p in product(one, repeat=n)}
        return sorted(out) if len(out) <= MOST_TEXTS else None
    return [""] if op is kind.AT else None


def _texts(items) -> list[str] | None:
    out = [""]
    for item in items:
        more = _spelled(item)
        if more is None or len(out) * len(more) > MOST_TEXTS:
            return None
        out = [a + b for a in out for b in more]
    return out


def _least(choices: set[frozenset[str]]) -> tuple[frozenset[str], ...]:
    """Choices without those that ask for more than another does."""
    return tuple(sorted((c for c in choices if not any(o < c for o in choices)), key=sorted))


def _both(a: tuple, b: tuple) -> tuple:
    return _least({x | y for x in a for y in b})


def _query(items) -> tuple:
    found, run = ANY, [""]

    def close(texts: list[str]) -> tuple:
        return _least({frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in texts})

    for item in items:
        more = _spelled(item)
        if more is not None and len(run) * len(more) <= MOST_TEXTS:
            run = [a + b for a in run for b in more]
            continue
        found, run = _both(found, close(run)), [""]
        if more is not None:
            run = list(more)
            continue
        op, value = item
        if op is kind.SUBPATTERN:
            found = _both(found, _query(value[-1]))
        elif op is kind.BRANCH:
            found = _both(found, _least({c for p in value[1] for c in _query(p)}))
        elif op is kind.MAX_REPEAT and value[0] >= 1:
            found = _both(found, _query(value[2]))
    return _both(found, close(run))


def trigram_query(pattern: str) -> tuple[frozenset[str], ...]:
    """Choices of lower-case trigrams, one of which every match contains in full; `ANY` where none is mandatory.

    Literal runs, small character sets, branches and short repeats are spelled out, whatever the case; all else
    only ends a run.
    """
    found = _query(parser.parse(pattern, re.ASCII))
    return ANY if frozenset() in found else found
