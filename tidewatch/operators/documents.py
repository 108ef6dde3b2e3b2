"""Fields of appraisal documents from paragraphs, a table grid and images."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numbers import ascii_digits
from tidewatch.functions.text import LETTER, LETTER_MARKS, LETTER_NAME, LETTER_PARTS, LETTER_PLACE, flat_base64, head_through, is_blank, tail_after
from tidewatch.functions.times import parse_cn_date
from tidewatch.operators.ordered import concat_ordered

# Cell (row, column) of the first table per field; the cell that is split after a
# mark into two fields; image fields by position, the empty one unused.
CELLS = {
    (1, 5): "x_wykg_slss",
    (1, 7): "x_wykg_syzk",
    (2, 2): "x_wykg_hx",
    (3, 2): "x_wykg_cx",
    (3, 5): "x_wykg_hjjg",
    (3, 7): "x_wykg_bxll",
    (4, 2): "x_wykg_ll",
    (4, 5): "x_wykg_tfcg",
    (5, 2): "x_wykg_zxqk",
    (6, 2): "x_zzjl_bh",
    (6, 7): "x_zzjl_qsly",
    (7, 2): "x_zzjl_tdcrjqk",
    (8, 2): "x_ptss_desc",
}
SPLIT_CELL, SPLIT_MARK, SPLIT_FIELDS = (1, 2), "构", ("x_wykg_jg", "x_wykg_zcs")
IMAGE_FIELDS = (
    "x_img_loc_s_150_150",
    "x_img_wg",
    "x_img_xqhj",
    "x_img_mph",
    "x_img_slzk_1",
    "x_img_slzk_2",
    "x_img_slzk_3",
    "x_img_slzk_4",
    "",
    "x_img_yt",
    "x_img_ytjg",
)
# Most bytes of a letter that is matched by the pattern as it is.
LETTER_BYTES = 4096


def document_text(paras: DataFrame) -> DataFrame:
    """Text of each document: its paragraphs that are not blank, each ending in a newline."""
    joined = concat_ordered(paras, ["doc_id"], "pos", "text", "text", keep=~is_blank(F.col("text")))
    return joined.withColumn("text", F.concat("text", F.lit("\n")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _but(text: Column, n: Column) -> Column:
    """Text without its last `n` characters."""
    return _let(text, lambda t: F.substring(t, F.lit(1), F.greatest(F.length(t) - n, F.lit(0))))


def _before_last(text: Column, mark: Column) -> Column:
    """Text before the last `mark`, which must be there."""
    return _let(text, lambda t: _but(t, F.length(F.call_function("substring_index", t, mark, F.lit(-1))) + F.length(mark)))


def _last_part(text: Column, mark: str, rest: str, least: int = 0) -> Column:
    """`group`, what the last `mark` that `rest` follows at once is followed by, and `before`, the text before that mark less
    one character. `least` characters have to come before the mark. The text is cut at the mark, so each piece is read once."""

    def taken(pieces: Column) -> Column:
        fits = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: (i > 0) & F.get(pieces, i).rlike("^" + rest))
        if least:
            fits = F.filter(fits, lambda i: (i > 1) | (F.length(F.get(pieces, F.lit(0))) >= least))
        return _let(
            F.array_max(fits),
            lambda at: F.struct(
                F.regexp_extract(F.get(pieces, at), "^" + rest, 1).alias("group"),
                _but(F.array_join(F.slice(pieces, F.lit(1), at), mark), F.lit(1)).alias("before"),
            ),
        )

    return _let(F.split(text, mark, -1), taken)


def _last_place(text: Column) -> Column:
    """`place`, `kind` and `before` of the last run of word characters that has both between their marks."""
    begin, middle, end = (F.lit(m) for m in LETTER_PLACE)
    one = F.lit(1)

    def parts(run: Column) -> Column:
        """Null unless the run has the marks in order, with a character or more between."""

        def of_middle(upto: Column, named: Column) -> Column:
            head = _let(_but(named, one), lambda h: F.when(h.contains(begin), _before_last(h, begin)))
            return _let(
                head,
                lambda h: F.when(
                    h.isNotNull(),
                    F.struct(
                        F.substring(named, F.length(h) + F.length(begin) + 1, F.length(named)).alias("place"),
                        F.substring(upto, F.length(named) + F.length(middle) + 1, F.length(upto)).alias("kind"),
                        h.alias("head"),
                        run.alias("run"),
                    ),
                ),
            )

        def of_end(upto: Column) -> Column:
            named = _let(_but(upto, one), lambda u: F.when(u.contains(middle), _before_last(u, middle)))
            return _let(named, lambda n: F.when(n.isNotNull(), of_middle(upto, n)))

        return _let(_before_last(run, end), of_end)

    def taken(whole: Column) -> Column:
        runs = F.filter(F.split(whole, r"(?U)\W+"), lambda r: r.contains(begin) & r.contains(middle) & r.contains(end))
        found = F.filter(F.transform(runs, parts), lambda p: p.isNotNull())
        return _let(
            F.get(found, F.size(found) - 1),
            lambda p: F.struct(p["place"].alias("place"), p["kind"].alias("kind"), _but(F.concat(_before_last(whole, p["run"]), p["head"]), one).alias("before")),
        )

    return _let(text, taken)


def _parts_from_end(text: Column) -> Column:
    """The six groups of the letter pattern as an array, null if it does not match.

    The parts of the pattern are joined by runs of any text, each as long as can be. So every part lies at its last
    place that leaves room for those behind it, and is found from the end of the text on, at a cost that grows with the text's
    length. A text without the salutation or another of the marks is not searched at all.
    """

    def from_end(left: Column, names: list[str], groups: list[Column]) -> Column:
        if names:
            mark, rest = LETTER_PARTS[names[0]]
            return _let(_last_part(left, mark, rest), lambda p: from_end(p["before"], names[1:], [p["group"], *groups]))
        return _let(_last_place(left), lambda p: salutation(p["before"], [p["place"], p["kind"], *groups]))

    def salutation(left: Column, groups: list[Column]) -> Column:
        return _let(_last_part(left, "\n", LETTER_NAME, least=1), lambda p: F.when(p["group"].isNotNull(), F.array(p["group"], *groups)))

    return from_end(F.when(reduce(and_, [text.contains(m) for m in LETTER_MARKS]), text), list(LETTER_PARTS), [])


def _parts_by_pattern(text: Column) -> Column:
    """The same groups by the pattern as one expression, for texts that have each mark once at most and not the character 0."""
    groups = "".join(f"\0${n}" for n in range(1, 7))
    pieces = F.split(F.regexp_replace(text, LETTER, groups), "\0")
    return _let(pieces, lambda p: F.when(F.size(p) == 7, F.slice(p, 2, 6)))


def _letter_parts(text: Column) -> Column:
    """The six groups of the letter pattern as an array, null if it does not match.

    Most letters are short and have each mark once. There the pattern has nowhere to go back to, and is matched as it is;
    without one of the marks it cannot match. In all other texts its parts are searched from the end, as it may go back too often.
    """
    size = F.octet_length(text)
    upto_second = [F.call_function("substring_index", text, F.lit(m), F.lit(2)) for m in LETTER_MARKS]
    plain = (size <= LETTER_BYTES) & ~text.contains("\0") & reduce(and_, [F.octet_length(t) == size for t in upto_second])
    return F.when(plain, _parts_by_pattern(text)).otherwise(_parts_from_end(text))


def _area(parts: Column) -> Column:
    return ascii_digits(parts[3]).try_cast("double")


def appraisal_fields(docs: DataFrame) -> DataFrame:
    """The six fields of documents that match the letter pattern and whose area is a number in any script's digits.

    The groups pass through `explode` of none or one array, so that filter and projection share them.
    """
    found = F.filter(F.array(_letter_parts(F.col("text"))), lambda p: p.isNotNull() & _area(p).isNotNull())
    part = [F.col("_p")[i] for i in range(6)]
    return docs.select("doc_id", F.explode(found).alias("_p")).select(
        "doc_id",
        part[1].alias("x_name"),
        part[0].alias("x_zzjl_qsr"),
        part[2].alias("x_md"),
        _area(F.col("_p")).alias("x_jzmj"),
        parse_cn_date(ascii_digits(part[4])).alias("x_cp_date"),
        F.replace(part[5], F.lit(","), F.lit("")).alias("x_cp_dj"),
    )


def appraisal_rejects(docs: DataFrame) -> DataFrame:
    """Documents that do not match, or whose area is not a number."""
    return docs.filter(_let(_letter_parts(F.col("text")), lambda p: p.isNull() | _area(p).isNull()))


def table_fields(cells: DataFrame) -> DataFrame:
    """One row per document with the fields of its first table; a missing cell is null."""

    def cell(r: int, c: int):
        return F.max(F.when((F.col("r") == r) & (F.col("c") == c), F.col("text")))

    wide = (
        cells.filter(F.col("table_no") == 0)
        .groupBy("doc_id")
        .agg(cell(*SPLIT_CELL).alias("_split"), *[cell(*at).alias(name) for at, name in CELLS.items()])
    )
    head, tail = SPLIT_FIELDS
    return wide.withColumns(
        {head: head_through(F.col("_split"), SPLIT_MARK), tail: tail_after(F.col("_split"), SPLIT_MARK)}
    ).drop("_split")


def _image_slots(images: DataFrame) -> DataFrame:
    slots = [F.max(F.when(F.col("pos") == i, F.col("content"))).alias(name) for i, name in enumerate(IMAGE_FIELDS) if name]
    return images.filter(F.col("pos") < len(IMAGE_FIELDS)).groupBy("doc_id").agg(*slots)


def image_fields(images: DataFrame) -> DataFrame:
    """One row per document with its images as base64 by position; position 8 is dropped.

    Of several images at a position the greatest by bytes counts. They are encoded after grouping, as base64 is a third longer.
    """
    return _image_slots(images).withColumns({name: flat_base64(F.col(name)) for name in IMAGE_FIELDS if name})


def image_rejects(images: DataFrame) -> DataFrame:
    """Images past the last slot."""
    return images.filter(F.col("pos") >= len(IMAGE_FIELDS))


def document_records(paras: DataFrame, cells: DataFrame, images: DataFrame) -> DataFrame:
    """Records of all matching documents: text fields, table fields and images."""
    fields = appraisal_fields(document_text(paras))
    joined = fields.join(table_fields(cells), "doc_id", "left").join(_image_slots(images), "doc_id", "left")
    return joined.withColumns({name: flat_base64(F.col(name)) for name in IMAGE_FIELDS if name})
