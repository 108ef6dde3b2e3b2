"""Secret scans by a trigram inverted index, in DataFrame expressions only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import row_key, saved, sent_if_few
from tidewatch.llm.trigrams import ANY, trigram_query


class Rule(NamedTuple):
    """A kind of secret: its pattern, the group that must reach `least` characters (shorter matches drop), the
    pattern by which such matches are struck out, if it is another, and whether it is struck out before the other rules."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    strike: str = ""
    first: bool = False


# The base rules, then rules for tokens of public services.
_NAME = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
_GIVEN = _NAME + "[\"']? *[:=] *[\"']?"
BASE = (
    Rule("assign", _GIVEN + "([A-Za-z0-9+/_.=-]+)", 2, 6, _GIVEN + "([A-Za-z0-9+/_.=-]{6,})"),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
# A private key reaches to the next END line of one, before any other BEGIN or END. Without that, over its header lines and
# base64 runs, and a last short line of base64. Line ends may be spelled out as in JSON. Loops are possessive: none backtracks.
_BEGIN = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"
_TO_END = r"(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----"
_GAP = r"(?:[\s>#*\"',+]|\\[nrt])"
_HEADERS = rf"(?:{_GAP}*+(?:Proc-Type|DEK-Info|Comment|Version): ?[A-Za-z0-9,. -]*+)*+"
_SHORT = r"[ \t\r]*+(?:\n|\\n)[ \t>#*]*+[A-Za-z0-9+/]{1,76}+={0,2}+(?=[ \t\r]*+(?:[\n\\\"']|$))"
_RUNS = rf"(?:(?:{_GAP}++[A-Za-z0-9+/=]{{20,}}+)++(?:{_SHORT})?+)?+"
MORE = (
    Rule("private_key", f"{_BEGIN}(?:{_TO_END}|{_HEADERS}{_RUNS})", first=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[A-Za-z0-9._~-]{1,64}:[A-Za-z0-9._~!$&*+=-]{1,64}@"),
)
RULES = BASE + MORE
# Characters of a long text that are searched for trigrams at once.
_STRETCH = 1 << 20


def trigrams_of(rules: tuple[Rule, ...]) -> list[str]:
    """All trigrams that the queries of the rules ask for."""
    return sorted({t for r in rules for c in trigram_query(r.pattern) for t in c})


def walk_pattern(trigrams: list[str]) -> str:
    """A pattern that stops before every one of the trigrams, overlapping ones too, and holds it in its only group: by first
    characters, so that most places of a text are passed at their first one."""

    def said(text: str) -> str:
        return "".join(c if c.isalnum() else "\\" + c for c in text)

    heads = sorted({t[0] for t in trigrams})
    return "(?=(" + "|".join(said(h) + "(?:" + "|".join(said(t[1:]) for t in trigrams if t[0] == h) + ")" for h in heads) + "))"


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index: a row `trigram`, `id`, `key` for each trigram of the rules that a text holds, in either case.

    A text is walked once for all trigrams, a long one in stretches of `_STRETCH` characters that overlap, so that what is
    found is folded before it is gathered.
    """
    pattern = F.lit(walk_pattern(trigrams_of(rules)))
    low = F.lower(F.col("text"))

    def held(text: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(text, pattern, F.lit(1)))

    starts = F.sequence(F.lit(0), F.floor(F.length("text") / _STRETCH).cast("int"))
    long = F.array_distinct(F.flatten(F.transform(starts, lambda i: held(F.substring(low, i * _STRETCH + 1, F.lit(_STRETCH + 2))))))
    rows = docs.select(F.col(id_col).alias("id"), row_key(docs).alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.select(F.explode(F.when(F.length("text") <= _STRETCH, held(low)).otherwise(long)).alias("trigram"), "id", "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`id`, `key` and `rules`: the kinds whose trigram query the postings of a text meet. Rules without one are not here.

    Postings are intersected per text: the trigrams of a choice are counted over the distinct ones found, in one
    bounded map-side set of known trigrams.
    """
    found = index.groupBy("id", "key").agg(F.collect_set("trigram").alias("found"))

    def met(rule: Rule) -> Column:
        choices = [F.size(F.array_except(F.array(*[F.lit(t) for t in sorted(c)]), F.col("found"))) == 0 for c in trigram_query(rule.pattern)]
        return F.when(sum(c.cast("int") for c in choices) > 0, F.lit(rule.kind))

    asked = [met(r) for r in rules if trigram_query(r.pattern) != ANY]
    return found.select("id", "key", F.array_compact(F.array(*asked)).alias("rules")).where(F.size("rules") > 0)


_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
# Matches walked in one list; a text with more is walked list by list.
_LIST = 256


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of the leftmost non-overlapping matches, in code points: the pieces between them and they themselves give
    the places. Lists of `_LIST` matches are walked one after the other, so that the work grows with the matches."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    own = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    parts = F.zip_with(F.zip_with(gaps, lengths, lambda g, n: F.struct(g.alias("gap"), n.alias("len"))), own, lambda p, o: F.struct(p["gap"].alias("gap"), p["len"].alias("len"), o.alias("own")))
    parts = F.filter(parts, lambda m: m["len"].isNotNull())  # the text behind the last match
    count = F.size(lengths)
    lists = F.transform(F.sequence(F.lit(0), F.floor((count - 1) / _LIST).cast("int")), lambda i: F.slice(parts, i * _LIST + 1, F.lit(_LIST)))

    def walk(seen: Column, m: Column) -> Column:
        start, end = seen["at"] + m["gap"], seen["at"] + m["gap"] + m["len"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        held = F.when(m["own"] >= rule.least, F.array(span)).otherwise(F.array().cast(_SPAN))
        return F.struct(end.alias("at"), F.concat(seen["spans"], held).alias("spans"))

    def walk_list(seen: Column, some: Column) -> Column:
        inner = F.aggregate(some, F.struct(seen["at"].alias("at"), F.array().cast(_SPAN).alias("spans")), walk)
        return F.struct(inner["at"].alias("at"), F.concat(seen["lists"], F.array(inner["spans"])).alias("lists"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("lists"))
    return F.flatten(F.aggregate(lists, begin, walk_list)["lists"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", name: str = "spans") -> DataFrame:
    """`docs` with `spans` (or `name`): start, rank of the rule, end (exclusive) and kind of every secret, by start and rule.

    Rules with mandatory trigrams are verified only in texts that the intersected postings name; the others
    scan every text. The named texts are written first, and sent to all tasks if they are few, so that no text is shuffled. Null and empty texts have no spans. Every row gives one row; repeated rows and null ids keep
    theirs; an empty table gives none. A column of that name is replaced.
    """
    found = saved(candidates(postings(docs, rules, id_col, text_col), rules))
    found = sent_if_few(found).select(F.col("id").alias("_tw_id"), F.col("key").alias("_tw_found"), F.col("rules").alias("_tw_rules"))
    same = F.col(id_col).eqNullSafe(F.col("_tw_id")) & (F.col("_tw_key") == F.col("_tw_found"))
    rows = docs.withColumn("_tw_key", row_key(docs)).join(found, same, "left")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    none = F.array().cast(_SPAN)
    spans = []
    for rank, rule in enumerate(rules):
        named = F.lit(True) if trigram_query(rule.pattern) == ANY else F.array_contains("_tw_rules", rule.kind)
        spans.append(F.when(named & text.rlike(rule.pattern), _matches(text, rule, rank)).otherwise(none))
    return rows.withColumn(name, F.array_sort(F.concat(*spans))).drop("_tw_key", "_tw_id", "_tw_found", "_tw_rules")


def spans_text(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """`kind:start:end` of the spans, of the given kinds only, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def struck_out(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every secret replaced by `[its kind]`, rule after rule, in texts that `scan` finds one in. Other texts stay.

    Rules marked `first` come before the others, which else would strike a part of a key and hide the rest from its own rule."""
    text = F.col(text_col)
    clean = text
    for rule in sorted(rules, key=lambda r: not r.first):
        clean = F.regexp_replace(clean, F.lit(rule.strike or rule.pattern), F.lit(f"[{rule.kind}]"))
    scanned = scan(docs, rules, id_col, text_col, "_tw_spans")
    return scanned.withColumn(text_col, F.when(F.size("_tw_spans") > 0, clean).otherwise(text)).drop("_tw_spans")
