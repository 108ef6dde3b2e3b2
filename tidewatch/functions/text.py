"""Text rules: globs, templates, masks, identifiers and document fields."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"

# The parts of an appraisal letter. The salutation follows a name at the start of a line; the place and the
# kind of property stand between three marks; the other parts, from the last on, are a mark and what follows it. `(?U)`
# lets `\w` match Chinese letters and `\d` the digits of any script.
SALUTATION = "（先生/女士）:"
LETTER_NAME = r"(?U)(\w+)（先生/女士）:"
LETTER_PLACE = ("对位于", "的", "价值作初步估价")
LETTER_PARTS = {
    "_g6": ("单价：", r"(?U)([\d|,]+)元"),
    "_g5": ("在价值时点", r"(?U)(\d+年\d+月\d+日)的抵押评估价值为"),
    "_g4": ("建筑面积", r"(?U)(\d+\.\d+)平方米"),
}
# The marks that every letter has, and the whole pattern for texts that have each mark once, so that the runs of any text between its
# parts are the same whether they are as long or as short as can be; short ones are found in one pass.
LETTER_MARKS = (SALUTATION, LETTER_PLACE[0], LETTER_PLACE[2], *[mark for mark, _ in LETTER_PARTS.values()])
LETTER = (
    r"(?sU)\A.+?\n" + LETTER_NAME.removeprefix("(?U)") + r".+?" + r"(\w+)".join(LETTER_PLACE)
    + "".join(".+?" + mark + rest.removeprefix("(?U)") for mark, rest in reversed(LETTER_PARTS.values())) + r".*\z"
)


def glob_regex(pattern: str) -> str:
    """Java regular expression for one shell glob, without anchors."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 2 + (pattern[i + 1 : i + 2] == "!")) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close]
            negate = body.startswith("!")
            body = re.sub(r"([\\\[\]^&])", r"\\\1", body[negate:])
            out.append(f"[{'^' if negate else ''}{body}]")
            i = close
        else:
            out.append(re.sub(r"([^\w\s])", r"\\\1", ch, flags=re.ASCII) if ch.isascii() else ch)
        i += 1
    return "".join(out)


def glob_match(c: Column, patterns: Iterable[str]) -> Column:
    """True where the text matches any of the globs; null text counts as empty."""
    union = "|".join(glob_regex(p) for p in patterns)
    return F.coalesce(c, F.lit("")).rlike(rf"(?s)\A(?:{union})\z")


def fill_template(template: Column, day: Column, start: Column, limit: Column, path: Column) -> Column:
    """A request address from its template; the four tokens are filled in this order."""
    url = F.replace(template, F.lit("dstr"), day)
    url = F.replace(url, F.lit("dstart"), start.cast("string"))
    url = F.replace(url, F.lit("dlimit"), limit.cast("string"))
    return F.replace(url, F.lit("purl"), path)


def hide_secrets(c: Column) -> Column:
    """JSON text with the values of `auth` and `password` masked, with or without a blank after the colon."""
    return F.regexp_replace(c, r'("(?:auth|password)":\s*)".*?"', '$1"***"')


def packed_uuid(c: Column) -> Column:
    """The `uuid=` part of a `key=value,key=value` text; null if missing or empty."""
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda p: p.startswith("uuid="))
    return F.nullif(F.array_join(F.transform(parts, lambda p: F.substring(p, 6, 2**31 - 1)), ""), F.lit(""))


def is_uuid(c: Column) -> Column:
    """Lower-case hexadecimal 8-4-4-4-12; null is not one."""
    return F.coalesce(c.rlike(UUID), F.lit(False))


def is_blank(c: Column) -> Column:
    """Null, empty, or only white space of any script."""
    return ~F.coalesce(c, F.lit("")).rlike(r"(?U)\S")


def head_through(c: Column, mark: str) -> Column:
    """Text up to and including the first `mark`; empty if there is none."""
    return F.substring(c, F.lit(1), F.instr(c, mark))


def tail_after(c: Column, mark: str) -> Column:
    """Text after the first `mark`; the whole text if there is none."""
    return F.substring(c, F.instr(c, mark) + 1, F.length(c))


def python_text(c: Column) -> Column:
    """Text form in which a missing value reads `None`."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def flat_base64(c: Column) -> Column:
    """Base64 without line breaks."""
    return F.replace(F.replace(F.base64(c), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(""))


def option_list(c: Column) -> Column:
    """Blank-separated words as a list of value and label pairs."""
    words = F.filter(F.split(c, " "), lambda w: ~w.isin("", "（", "）"))
    bare = F.transform(words, lambda w: F.replace(w, F.lit("）"), F.lit("")))
    pairs = F.transform(bare, lambda w: F.format_string("('%s','%s')", w, w))
    return F.concat(F.lit("["), F.array_join(pairs, ","), F.lit("]"))
