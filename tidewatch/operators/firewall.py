"""Firewall policy lines to a flat table of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.joins import small_or_hashed
from tidewatch.operators.ordered import CHUNK, chunk_carry, chunk_of
from tidewatch.session import checkpointed

# Columns of the flat table, in order, and their headers in a written sheet.
POLICY_COLUMNS = (
    "interzone_source",
    "interzone_dest",
    "ruleid",
    "comment",
    "commentuser",
    "source_ip",
    "dest_ip",
    "service",
    "rule_state",
    "policy",
)
POLICY_HEADERS = {"rule_state": "rule启用状态", "policy": "策略"}
# Lines that a task sorts and groups.
TASK_LINES = 500_000
# Chunks counted to be at most so many may be broadcast with their marks, which are eight numbers each; else all lines are shuffled.
BROADCAST_CHUNKS = 500_000
# States that stay in force for later rules.
_CARRIED = ("_zone", "_rule")
_HEAD = tuple(c for c in POLICY_COLUMNS if c not in ("source_ip", "dest_ip", "service"))


def line_fields(line: Column) -> Column:
    """Fields of a line between single blanks; two blanks in a row give an empty field."""
    return F.split(F.btrim(line, F.lit(" \t\r\n\f\x0b")), " ")


def _field(i: int) -> Column:
    return F.get("_f", F.lit(i))


def _noted() -> dict[str, Column]:
    """What a line sets: zones, rule id and policy, comment, user."""
    is_rule, is_comment = _field(0) == "rule", _field(0) == "comment"
    at, width = F.col("line_no"), F.size("_f")
    return {
        "_zone": F.when(_field(0) == "interzone", F.struct(_field(2).alias("src"), _field(4).alias("dst"))),
        "_rule": F.when(is_rule & (width == 3), F.struct(at.alias("at"), _field(1).alias("id"), _field(2).alias("act"))),
        "_comment": F.when(is_comment, F.struct(at.alias("at"), _field(1).alias("text"))),
        "_user": F.when(is_comment & (width > 3), F.struct(at.alias("at"), _field(3).alias("text"))),
    }


def _end() -> Column:
    """Number of a line that ends a rule."""
    return F.when((_field(0) == "rule") & (F.size("_f") != 3), F.col("line_no"))


_LISTS = {"_src": "source-ip", "_dst": "destination-ip", "_svc": "service"}
_KINDS = (*_LISTS, "_zone", "_rule", "_comment", "_end")


def _lists() -> list[Column]:
    return [F.collect_list(F.when(_field(0) == w, _field(1))).alias(n) for n, w in _LISTS.items()]


def _head(rule_state: Column) -> Column:
    """Closing state of a rule from the state in force at its end line. Zones and policy carry over
    from earlier rules; id, comment and user count only if set after `_start`."""

    def inside(state: str, part: str) -> Column:
        return F.coalesce(F.when(F.col(f"{state}.at") > F.col("_start"), F.col(f"{state}.{part}")), F.lit(""))

    def carried(part: str) -> Column:
        return F.coalesce(F.col(part), F.lit(""))

    return F.struct(
        carried("_zone.src").alias("interzone_source"),
        carried("_zone.dst").alias("interzone_dest"),
        inside("_rule", "id").alias("ruleid"),
        inside("_comment", "text").alias("comment"),
        inside("_user", "text").alias("commentuser"),
        rule_state.alias("rule_state"),
        carried("_rule.act").alias("policy"),
    )


def _split(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_f", line_fields(F.col("line"))).drop("line")


def _marks(lines: DataFrame) -> DataFrame:
    """Per chunk the number of lines, the first and last end line, and the last line that notes each state, as numbers only, which
    are added up without sorting the lines."""
    at = [F.max(F.when(e.isNotNull(), F.col("line_no"))).alias(f"_at{n}") for n, e in _noted().items()]
    ends = [F.min(_end()).alias("_first_end"), F.max(_end()).alias("_last_end"), F.count(F.lit(1)).alias("_n")]
    return _split(lines).groupBy("file", "_chunk").agg(*ends, *at)


def _edges(lines: DataFrame, marks: DataFrame) -> DataFrame:
    """The few lines of each chunk that others need: up to its first end line, from its last, and those that note a state last."""
    at = F.col("line_no")
    kept = (at <= F.coalesce("_first_end", F.lit(2**62))) | (at >= F.col("_last_end"))
    for n in _noted():
        kept = kept | (at == F.col(f"_at{n}"))
    marks = marks.drop("_n")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_CHUNKS else marks.hint("shuffle_hash")
    return lines.join(marks, ["file", "_chunk"]).filter(kept).select(*lines.columns)


def _parts() -> dict[str, Column]:
    """Kind of a line, which is the name of its list or state, by number, and the one or two fields that count. Other lines have no kind."""
    word, width = _field(0), F.size("_f")
    ruled = F.when(width == 3, _KINDS.index("_rule")).otherwise(_KINDS.index("_end"))
    kinds = [F.when(word == "rule", ruled), F.when(word == "interzone", _KINDS.index("_zone")), F.when(word == "comment", _KINDS.index("_comment"))]
    listed = [F.when((word == w) & _field(1).isNotNull(), _KINDS.index(n)) for n, w in _LISTS.items()]
    zone = word == "interzone"
    return {
        "_kind": F.coalesce(*kinds, *listed).cast("byte"),
        "_a": F.when(zone, _field(2)).otherwise(_field(1)),
        "_b": F.when(zone, _field(4)).when(word == "comment", _field(3)).when(word == "rule", _field(2)),
    }


def _whole_rules(lines: DataFrame, carry: DataFrame, n_lines: int) -> DataFrame:
    """Rules that lie inside one chunk, with their lists; grouping needs no further shuffle.

    The lines are shuffled and sorted as they are, and cut into fields only then. A line is told the end line before it, which names its
    rule, and is grouped at once; grouping sorts what it takes in, so a row holds the parts of one line and no states. Zones and
    policy are carried from rule to rule within a chunk, and into it by the carried rows. Lines are short and pack well, so tasks are
    cut by their number: by packed bytes, a task would have to sort more than its memory holds.
    """
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, -(-n_lines // TASK_LINES))
    place = ["_chunk", "file"]  # numbers come first in what is sorted, as they settle most comparisons
    dealt = lines.repartition(tasks, "file", "_chunk").sortWithinPartitions(*place, "line_no")
    ahead = Window.partitionBy(*place).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*place).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("_kind") == F.lit(_KINDS.index(kind)).cast("byte"), value)

    def latest(kind: str, **fields: str) -> Column:
        return F.max(of(kind, F.struct("line_no", *[F.col(c).alias(n) for n, c in fields.items()])))

    parts = _split(dealt).select(*place, "line_no", *[e.alias(n) for n, e in _parts().items()])
    started = parts.withColumn("_start", F.max(of("_end", F.col("line_no"))).over(ahead)).where("_kind IS NOT NULL")
    ended = F.struct("line_no", F.col("_a").alias("v"))
    user = of("_comment", F.when(F.col("_b").isNotNull(), F.struct("line_no", F.col("_b").alias("text"))))
    pieces = started.groupBy("_start", *place).agg(
        *[F.collect_list(of(n, F.col("_a"))).alias(n) for n in _LISTS],
        latest("_zone", src="_a", dst="_b").alias("_zone"),
        latest("_rule", id="_a", act="_b").alias("_rule"),
        latest("_comment", text="_a").alias("_comment"),
        F.max(user).alias("_user"),
        F.max(of("_end", F.when(F.col("line_no") > F.col("_start"), ended))).alias("_closed"),
        F.max(of("_end", F.when(F.col("line_no") == F.col("_start"), ended))).alias("_again"),
    )
    pieces = pieces.withColumns({f"_was{n}": F.last(n, True).over(earlier) for n in _CARRIED}).where("_closed IS NOT NULL OR _again IS NOT NULL")
    met = pieces.join(carry.select(*place, *[F.col(f"_c_{n}") for n in _CARRIED]).hint("shuffle_hash"), place)

    def filled(name: str, otherwise: str, **fields: str) -> Column:
        found = F.col(name)
        return F.when(found.isNull(), F.col(otherwise)).otherwise(F.struct(*[found[c].alias(n) for n, c in fields.items()]))

    zone, rule, text = {"src": "src", "dst": "dst"}, {"at": "line_no", "id": "id", "act": "act"}, {"at": "line_no", "text": "text"}
    met = met.withColumns({"_was_zone": filled("_was_zone", "_c__zone", **zone), "_was_rule": filled("_was_rule", "_c__rule", **rule)})
    met = met.withColumns({"_zone": filled("_zone", "_was_zone", **zone), "_rule": filled("_rule", "_was_rule", **rule)})
    met = met.withColumns({n: F.struct(*[F.col(n)[c].alias(f) for f, c in text.items()]) for n in ("_comment", "_user")})
    # An end line whose number comes twice ends an empty rule the second time; its rows count with the rule after.
    none = [F.lit("").alias(c) for c in ("ruleid", "comment", "commentuser")]
    zones = [F.coalesce(F.col("_was_zone")[f], F.lit("")).alias(c) for f, c in (("src", "interzone_source"), ("dst", "interzone_dest"))]
    policy = F.coalesce(F.col("_was_rule.act"), F.lit("")).alias("policy")
    again = F.when(F.col("_again").isNotNull(), F.struct(*zones, *none, F.col("_again.v").alias("rule_state"), policy))
    head = F.when(F.col("_closed").isNotNull(), _head(F.col("_closed.v")))
    return met.select("file", *_LISTS, F.greatest(head, again).alias("_head"))


def _cut_pieces(lines: DataFrame, carry: DataFrame) -> DataFrame:
    """Pieces of rules that cross a chunk border: the lines of each chunk up to its first end line, and
    those after its last. The former continue the rule that began after the last end line before."""
    before = F.col("line_no") <= F.coalesce("_first_end", F.lit(2**62))
    after = F.col("line_no") > F.col("_last_end")
    met = lines.join(small_or_hashed(carry), ["file", "_chunk"]).filter(before | after)
    lines = (
        _split(met)
        .withColumn("_start", F.when(after, F.col("_last_end")).otherwise(F.coalesce("_c__start", F.lit(-1))))
    )
    noted = _noted()
    latest = [F.max(F.when(e.isNotNull(), F.struct("line_no", e.alias("v")))).alias(f"_n{n}") for n, e in noted.items()]
    kept = [F.first(f"_c_{n}").alias(f"_c_{n}") for n in noted]
    closing = F.max(F.when(_end().isNotNull(), F.struct("line_no", _field(1).alias("v")))).alias("_closed")
    pieces = lines.groupBy("file", "_chunk", "_start").agg(*_lists(), *latest, *kept, closing)
    pieces = pieces.withColumns({n: F.coalesce(F.col(f"_n{n}")["v"], F.col(f"_c_{n}")) for n in noted})
    head = F.when(F.col("_closed").isNotNull(), _head(F.col("_closed")["v"]))
    return pieces.select("file", "_start", "_src", "_dst", "_svc", head.alias("_head"))


def _products(rows: DataFrame) -> DataFrame:
    return (
        rows.select("file", *[F.col(f"_head.{c}") for c in _HEAD], *_LISTS)
        .withColumn("source_ip", F.explode("_src"))
        .withColumn("dest_ip", F.explode("_dst"))
        .withColumn("service", F.explode("_svc"))
        .select("file", *POLICY_COLUMNS)
    )


def policy_table(lines: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per source, destination and service of each rule, from `file, line_no, line`.

    A `rule` line of three fields sets id and policy, any other `rule` line ends the rule. Zones and
    policy stay in force for later rules; comment, user, id and lists do not. A rule with an empty
    list gives no row, nor does an unfinished one at the end.

    The state at the start of each chunk of lines is found once and kept. Rules inside one chunk are
    expanded where they are, so no list is longer than a chunk. Rules that cross a border leave at most
    two pieces per chunk; these few are written to the shared folder and joined.
    """
    lines = lines.select("file", "line_no", "line", chunk_of("line_no", size).alias("_chunk"))
    marks = checkpointed(_marks(lines))
    n_lines = marks.agg(F.sum("_n")).first()[0] or 0
    edges = checkpointed(_edges(lines, marks))
    ends = [F.min(_end()).alias("_first_end"), F.max(_end()).alias("_last_end")]
    carry = checkpointed(chunk_carry(_split(edges), ["file"], "line_no", {**_noted(), "_start": _end()}, ends, size))
    cut = checkpointed(_cut_pieces(edges, carry))
    rule = ["file", "_start"]
    joined = cut.filter(F.col("_head").isNotNull()).select(*rule, "_head")
    for part in ("_src", "_dst", "_svc"):
        joined = joined.join(cut.filter(F.size(part) > 0).select(*rule, part), rule)
    return _products(_whole_rules(lines, carry, n_lines)).unionByName(_products(joined))
