"""Quality rules: base counts, then robust outliers by minimum covariance determinant per language and source."""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, raw_texts, row_key, saved

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits", "n_echoes")

# Rows that a group needs for an estimate of its own; rows of smaller groups are judged by that of a wider one.
MIN_ROWS = 200
# Share of the rows that the covariance of least determinant is sought over, and rounds towards it.
COVERAGE = 0.75
ROUNDS = 5
# Squared distance, in units in which its median is that of a normal sample, beyond which a document is rejected.
# Clean text is not normal: the limit lies far beyond its usual quantiles, and only gross outliers go.
LIMIT = 200.0
# Least unit of the squared distance. Clean groups have one of 0.08 to 0.1 (0.1 GB check tables); copies alone would have none.
LEAST_SCALE = 0.1
# Least deviation of each transformed statistic. Most texts have no digits and repeat nothing, so the nearest rows
# show no spread there; lists of numbers, addresses and some repeated lines are still ordinary text.
FLOORS = {"x0": 0.04, "x1": 0.045, "x2": 0.03, "x3": 0.04, "x4": 0.25, "x5": 0.25, "x6": 0.25, "x7": 0.1}
# Bins: per doubling of a squared distance, and per unit of a statistic.
PER_DOUBLING, PER_UNIT = 8, 1000

# Groups whose estimates (about 600 bytes each) may be broadcast, and parts of a group otherwise.
MOST_GROUPS, SALTS = 20_000, 32

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in SYMBOLS)
_SPACE = b" \t\n\v\f\r"
_TAILS = bytes(range(128, 192))


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of `WINDOW` words found twice or more, by numbers that stand exactly for the windows."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    size, key, range_ = len(seen), ids[:n], len(seen)
    if size == len(words):
        return 0
    for k in range(1, WINDOW):
        if range_ * size >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            range_ = int(key.max()) + 1
        key = key * size + ids[k : n + k]
        range_ *= size
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    found = np.isin(key, twice)
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k : n + k] |= found
    return int(covered.sum())


def text_counts(text: bytes) -> tuple[int, ...]:
    """The counts named in `COUNTS` of one whole text."""

    def count(kind: bytes) -> int:
        return len(text) - len(text.translate(None, kind))

    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    return (
        len(words),
        len(text) - count(_TAILS) - count(_SPACE),
        count(SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        count(_UPPER),
        count(_MARKS),
        count(_DIGITS),
        sum(map(eq, words, words[1:])),
    )


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with a column per name in `COUNTS`. A null text has no words."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("struct<" + ",".join(f"{c}:long" for c in COUNTS) + ">")
    def measure(texts: pa.Array) -> pa.Array:
        made = np.array([text_counts(t) for t in raw_texts(texts)], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(made[:, i]) for i in range(len(COUNTS))], list(COUNTS))

    counted = docs.withColumn("_counts", measure(F.col(text_col).cast("string")))
    return counted.withColumns({c: F.col(f"_counts.{c}") for c in COUNTS}).drop("_counts")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """Transformed statistics. Rates are held back in short texts, so that few words do not make an outlier."""
    words, chars = F.col("n_words") + 30, F.col("word_chars") + 150

    def rate(of: str, by: Column) -> Column:
        return F.sqrt(F.col(of) / by)

    return {
        "x0": F.log((F.col("word_chars") + 150) / words),
        "x1": rate("n_symbols", chars),
        "x2": rate("n_upper", chars),
        "x3": rate("n_marks", chars),
        "x4": rate("n_digits", chars),
        "x5": rate("n_dup_lines", F.col("n_lines") + 3),
        "x6": rate("n_repeat_words", words),
        "x7": rate("n_echoes", words),
    }


def _grouped(rows: DataFrame, by: list[str], min_rows: int) -> DataFrame:
    """`rows` with `grp`, the group whose estimate judges them, and `feeds`, the groups whose estimates they enter.

    A row is judged by its group of all columns of `by`, or of fewer where that has less than `min_rows` rows, and last by all rows,
    however few these are. It enters each of these groups that judges some row.
    """
    used = range(len(by), -1, -1)
    name = {
        n: F.concat_ws("\x1f", F.lit(str(n)), *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in by[:n]])
        for n in used
    }
    groups = saved(rows.groupBy(name[len(by)].alias("_whole"), *by).agg(F.count(F.lit(1)).alias("_n")))
    out = groups
    for n in used:
        big = groups.groupBy(name[n].alias("_name")).agg(F.sum("_n").alias("_all")).where(F.col("_all") >= (min_rows if n else 1))
        out = out.join(big.select(F.col("_name").alias(f"_big{n}")), name[n] == F.col(f"_big{n}"), "left")
    out = saved(out.withColumn("grp", F.coalesce(*[F.col(f"_big{n}") for n in used])))
    judges = out.where("grp IS NOT NULL").select(F.col("grp").alias("_judge")).distinct()
    for n in used:
        out = out.join(judges.select(F.col("_judge").alias(f"_feed{n}")), F.col(f"_big{n}") == F.col(f"_feed{n}"), "left")
    known = out.select("_whole", "grp", F.array_compact(F.array(*[F.col(f"_feed{n}") for n in used])).alias("feeds"))
    return rows.join(known, name[len(by)] == F.col("_whole"), "left").drop("_whole")


def _start(rows: DataFrame, names: list[str]) -> DataFrame:
    """Median and quartile range of each statistic and group, from counts by fine bins: `grp`, `center`, `precision`."""
    parts = F.array(*[F.struct(F.lit(i).alias("d"), F.floor(F.col(x) * PER_UNIT).alias("bin")) for i, x in enumerate(names)])
    bins = saved(rows.select("grp", F.explode(parts).alias("p")).groupBy("grp", "p.d", "p.bin").agg(F.count(F.lit(1)).alias("n")))
    line = W.partitionBy("grp", "d").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("grp", "d")
    ranked = bins.withColumn("upto", F.sum("n").over(line)).withColumn("all", F.sum("n").over(whole))
    cut = [F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bin"))) / PER_UNIT for q in (0.25, 0.5, 0.75)]
    per = ranked.groupBy("grp", "d").agg(cut[1].alias("mid"), ((cut[2] - cut[0]) / 1.349).alias("dev"))
    floors = F.array(*[F.lit(FLOORS[x]) for x in names])
    sure = F.greatest(F.col("dev"), floors[F.col("d")])
    wide = per.groupBy("grp").pivot("d", list(range(len(names)))).agg(F.max("mid").alias("mid"), F.max(1 / (sure * sure)).alias("w"))
    k = range(len(names))
    precision = [F.col(f"{i}_w") if i == j else F.lit(0.0) for i in k for j in k]
    return wide.select("grp", F.array(*[F.col(f"{i}_mid") for i in k]).alias("center"), F.array(*precision).alias("precision"))


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance from `center` by `precision`."""
    off = [F.col(x) - F.col("center")[i] for i, x in enumerate(names)]
    p = len(names)
    terms = [off[i] * off[j] * F.col("precision")[i * p + j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)]
    return sum(terms[1:], terms[0])


def _binned(rows: DataFrame, params: DataFrame, names: list[str]) -> DataFrame:
    """Rows with their distance and its bin on a doubling scale.

    The estimates of up to `MOST_GROUPS` groups go to all tasks, and no row is shuffled for them. Those of more groups are
    repeated under `SALTS` numbers, so that the rows of a hot group meet them in as many tasks.
    """
    known = params.select(F.col("grp").alias("_grp"), "center", "precision")
    met = F.col("grp") == F.col("_grp")
    if known.limit(MOST_GROUPS + 1).count() <= MOST_GROUPS:
        far = rows.join(F.broadcast(known), met)
    else:
        known = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        far = rows.join(known, met & (F.pmod("key", F.lit(SALTS)) == F.col("_part"))).drop("_part")
    far = far.withColumn("d2", F.greatest(_distance(names), F.lit(0.0)))
    level = F.floor(F.log2(F.col("d2") + 1e-9) * PER_DOUBLING)
    return far.withColumn("bin", level).drop("_grp")


def _cut(bins: DataFrame, share: float) -> DataFrame:
    """Rows of `bins` (grp, bin, n, ...) up to the first bin that holds `share` of a group's rows."""
    line = W.partitionBy("grp").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    before = F.sum("n").over(line) - F.col("n")
    return bins.withColumn("_before", before).withColumn("_all", F.sum("n").over(W.partitionBy("grp"))).where(F.col("_before") < share * F.col("_all"))


def _step(rows: DataFrame, params: DataFrame, names: list[str]) -> DataFrame:
    """Mean and covariance of the nearest `COVERAGE` of each group.

    Sums are made per group and distance bin, map-side first, so a step is one pass. They are saved before groups are gathered:
    else the windows below would have Spark shuffle what each task has summed by group alone.
    """
    p, floors = len(names), np.array([FLOORS[x] for x in names])
    sums = {f"s{i}": F.sum(F.col(x)) for i, x in enumerate(names)}
    sums |= {f"q{i}_{j}": F.sum(F.col(names[i]) * F.col(names[j])) for i in range(p) for j in range(i, p)}
    bins = saved(_binned(rows, params, names).groupBy("grp", "bin").agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in sums.items()]))
    total = _cut(bins, COVERAGE).groupBy("grp").agg(F.sum("n").cast("double").alias("n"), *[F.sum(k).alias(k) for k in sums])

    @F.arrow_udf("struct<center:array<double>,precision:array<double>>")
    def estimate(batch: pa.Array) -> pa.Array:
        made = []
        for values in batch.to_pylist():
            n, first, second = values[0], np.array(values[1 : p + 1]), np.zeros((p, p))
            second[np.triu_indices(p)] = values[p + 1 :]
            mean = first / n
            cov = (second + np.triu(second, 1).T) / n - np.outer(mean, mean)
            made.append({"center": mean.tolist(), "precision": np.linalg.inv(cov + np.diag(floors**2)).ravel().tolist()})
        return pa.array(made, pa.struct([("center", pa.list_(pa.float64())), ("precision", pa.list_(pa.float64()))]))

    return total.select("grp", estimate(F.array("n", *sums)).alias("e")).select("grp", "e.center", "e.precision")


def _middle(far: DataFrame, names: list[str]) -> DataFrame:
    """The bin of each group's median distance, `mid`: over all rows or over those of distinct statistics, the greater one."""
    kinds = far.groupBy("grp", "bin", F.xxhash64(*names).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    bins = saved(kinds.groupBy("grp", "bin").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")))
    halves = [_cut(bins.select("grp", "bin", F.col(c).alias("n")), 0.5).select("grp", "bin") for c in ("n", "kinds")]
    return halves[0].unionByName(halves[1]).groupBy("grp").agg(F.max("bin").alias("mid"))


# Median of the chi-square distribution with as many degrees of freedom as there are statistics.
_CHI2_MEDIAN = 7.344


def judged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    by: tuple[str, ...] = ("lang", "source"),
    min_rows: int = MIN_ROWS,
    limit: float = LIMIT,
) -> DataFrame:
    """One row per row of `docs`: `id`, `key` (see `row_key`), `COUNTS`, `base_failed`, `distance` (squared, scaled) and `kept`.

    The base rule fails texts of under ten words or with over 20 % of words in repeated windows. Of the others, the
    statistics of each language and source give a robust centre and covariance: from medians and quartile ranges,
    `ROUNDS` steps each take the nearest three quarters of the rows and their mean and covariance, which
    never raises the determinant. Distances are divided by their median over the rows or, if greater, over the rows of distinct
    statistics, so that copies of one text do not shrink the unit. A document further than `limit` is rejected. Rows of groups of fewer
    than `min_rows` rows are judged by the estimate over all rows of their language, and failing that over all rows of the table,
    however few: `FLOORS` keep every estimate regular.
    A null language or source is a value of its own. All rows enter every estimate. Null and empty texts have no
    words and fail. Repeated rows count as often as they come; an empty table gives none.
    """
    names, parts = list(statistics()), [f"g{i}" for i in range(len(by))]
    groups = [F.col(c).alias(g) for c, g in zip(by, parts, strict=True)]
    keyed = docs.select(F.col(id_col).alias("id"), *groups, F.col(text_col).alias("text"), row_key(docs).alias("key"))
    counted = saved(with_counts(keyed).drop("text").withColumn("base_failed", base_failed()))
    good = counted.where("NOT base_failed").withColumns(statistics())
    rows = saved(_grouped(good.select(*parts, "key", *names), parts, min_rows).select("grp", "feeds", "key", *names))
    fed = rows.select(F.explode("feeds").alias("grp"), "key", *names)
    params = saved(_start(fed, names))
    for _ in range(ROUNDS):
        params = saved(_step(fed, params, names))
    far = _binned(rows.where("grp IS NOT NULL"), params, names).select("grp", "key", "d2", "bin")
    middle = saved(_middle(_binned(fed, params, names), names))
    scale = F.greatest(F.pow(F.lit(2.0), (F.col("mid") + 0.5) / PER_DOUBLING) / _CHI2_MEDIAN, F.lit(LEAST_SCALE))
    scaled = far.join(middle, "grp").select("key", (F.col("d2") / scale).alias("distance"))
    scaled = scaled.groupBy("key").agg(F.max("distance").alias("distance"))  # equal rows lie in one group at one distance
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return counted.join(scaled, "key", "left").withColumn("kept", kept).drop(*parts)
