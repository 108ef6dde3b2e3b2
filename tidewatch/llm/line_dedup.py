"""Line deduplication by levelled sorted runs of line hashes, each batch anti-joined with the runs of those before."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, raw_texts, stored
from tidewatch.session import work_path

# Code points that a line's key needs to count, and documents that a repeated key is found in.
MIN_CHARS, MIN_DOCS = 40, 5
# Batches of a whole table, by falling id, and runs of one level that are compacted into one of the next.
BATCHES, FAN = 6, 3
# A key is hot if it makes up one in so many of a batch's lines, so a batch has at most as many hot keys.
HOT_SHARE = 1000

_SPACE = b" \t\n\v\f\r"
_TAILS = bytes(range(128, 192))
_HASHES = "array<struct<a:long,b:long>>"
_RUN = "a long, b long, n long, holder long, hot boolean"


def line_key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z lower-cased."""
    return line.strip(_SPACE).lower()


def line_mark(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the line's key, or none if the key has fewer than `min_chars` code points."""
    key = line_key(line)
    if len(key) < min_chars or len(key.translate(None, _TAILS)) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def with_marks(docs: DataFrame, min_chars: int) -> DataFrame:
    """`id` and `text` with `marks`, the hashes of a text's distinct line keys of `min_chars` code points or more."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(_HASHES)
    def marks(texts: pa.Array) -> pa.Array:
        found, sizes = [], []
        for text in raw_texts(texts):
            own = {line_mark(line, min_chars) for line in text.split(b"\n")} - {None}
            found.extend(own)
            sizes.append(len(own))
        pairs = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
        flat = pa.StructArray.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)

    return docs.withColumn("marks", marks("text"))


class LineRuns:
    """Line hashes seen so far, as sorted runs in levels.

    A run is a table of `a`, `b` (hash), `n` (documents), `holder` (largest id among them) and `hot`, bucketed and sorted by hash, so
    runs meet each other and a batch's lines bucket by bucket without being shuffled again. A new batch makes a run of level 0; when a
    level has `fan` runs they are merged into one of the next, so few runs are read however many batches came. Batches have to come
    by falling id: the first run that holds a key then holds its largest id.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fan: int = FAN):
        self.spark, self.min_docs, self.fan = spark, min_docs, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, DataFrame]]] = []

    def _written(self, run: DataFrame) -> tuple[str, DataFrame]:
        """`run` as a bucketed table of the shared folder: its path, and the table. Its name in the catalog goes at once."""
        name, path = f"tidewatch_run_{uuid.uuid4().hex}", work_path(self.spark, "line-run")
        writer = run.write.format("parquet").option("path", path).bucketBy(self.buckets, "a", "b").sortBy("a", "b")
        writer.saveAsTable(name)
        table = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return path, table

    def _merged(self, paths: list[str]) -> DataFrame:
        """Runs merged by key. All files are read in one scan, as a union of bucketed tables would pass for one bucketed table."""
        together = self.spark.read.schema(_RUN).parquet(*paths)
        return together.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("holder").alias("holder"), F.max("hot").alias("hot"))

    def add(self, lines: DataFrame) -> None:
        """Take a batch: `id`, `a`, `b`, one row per document and key.

        Keys that the runs already hold in `min_docs` documents are left out, as neither their holder nor the verdict can change.
        Hot keys stay in, to be told apart later.
        """
        total = lines.count()
        if not total:
            return
        own = lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("holder"))
        own = own.withColumn("hot", F.col("n") * HOT_SHARE >= F.lit(total))
        runs = [table for level in self.levels for _, table in level]
        if runs:
            before = F.lit(0)
            for number, run in enumerate(runs):
                own = own.join(run.select("a", "b", F.col("n").alias(f"n{number}")), ["a", "b"], "left")
                before = before + F.coalesce(f"n{number}", F.lit(0))
            own = own.where((before < self.min_docs) | F.col("hot")).select("a", "b", "n", "holder", "hot")
        self._place(0, self._written(own))

    def _place(self, level: int, run: tuple[str, DataFrame]) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan:
            merged = self._written(self._merged([path for path, _ in self.levels[level]]))
            self.levels[level] = []
            self._place(level + 1, merged)

    def repeated(self) -> DataFrame | None:
        """Keys found in `min_docs` documents or more: `a`, `b`, `n` (at least that many), `holder`, `hot`."""
        paths = [path for level in self.levels for path, _ in level]
        return self._merged(paths).where(F.col("n") >= self.min_docs) if paths else None


def _batch(bounds: list[int]) -> Column:
    """Number of a row's batch by falling id; rows without an id come last."""
    return sum([F.when(F.col("id").isNull() | (F.col("id") < b), 1).otherwise(0) for b in bounds], F.lit(0)).cast("int")


def _dropped_marks(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """`id` and `drops`, the hashes that a document loses. Hot keys are few and go to all tasks; the others are joined by hash."""
    hot = F.broadcast(repeated.where("hot").select("a", "b", "holder"))
    cold = repeated.where("NOT hot").select("a", "b", "holder")
    met = lines.join(hot, ["a", "b"]).unionByName(lines.join(hot, ["a", "b"], "left_anti").join(cold, ["a", "b"]))
    lost = met.where("id < holder OR (id IS NULL AND holder IS NOT NULL)")
    return lost.groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias("drops"))


def _edited(min_chars: int):
    """The Arrow function that takes a document's dropped lines out of its text; `kept` is null where the text is unchanged."""

    @F.arrow_udf("struct<n_lines:long,n_dropped:long,kept:string>")
    def edit(texts: pa.Array, drops: pa.Array) -> pa.Array:
        n_lines, n_dropped, kept = [], [], []
        for text, lost in zip(raw_texts(texts), drops, strict=True):
            if not lost.is_valid:
                n_lines.append(text.count(b"\n") + 1)
                n_dropped.append(0)
                kept.append(None)
                continue
            pairs = lost.values.flatten()
            gone = np.column_stack([p.to_numpy(zero_copy_only=False) for p in pairs]).astype("<i8").tobytes()
            marks = {gone[i : i + 16] for i in range(0, len(gone), 16)}
            lines = text.split(b"\n")
            left = [line for line in lines if line_mark(line, min_chars) not in marks]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
            kept.append(b"\n".join(left).decode())
        return pa.StructArray.from_arrays([pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], ["n_lines", "n_dropped", "kept"])

    return edit


def without_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fan: int = FAN,
) -> DataFrame:
    """One row per row of `docs`: `id`, `n_lines`, `n_dropped` and `kept`, the text without lines that other documents hold.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of `min_chars` code points or more found in `min_docs`
    documents or more stay only in the largest id that holds them, there as often as they come. The table is taken in batches by
    falling id, and each batch's keys become a sorted run (see `LineRuns`); a feed that grows can call `LineRuns.add` itself.

    Documents are told apart by id: rows of one id are one document and all its rows lose or keep a line together; rows
    without an id are one document that comes after all others. Null and empty texts are one empty line; a text that loses all
    lines is empty. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    cuts = rows.agg(F.percentile_approx("id", [i / batches for i in range(batches - 1, 0, -1)], 1000)).first()[0] or []
    marked = with_marks(rows, min_chars).select("id", F.explode("marks").alias("m")).select("id", "m.a", "m.b")
    if not rows.groupBy("id").count().where("count > 1").isEmpty():
        marked = marked.dropDuplicates()
    path = work_path(spark, "line-marks")
    marked.withColumn("batch", _batch(sorted(set(cuts)))).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("id long, a long, b long, batch int").parquet(path)
    runs = LineRuns(spark, min_docs, fan)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch).select("id", "a", "b"))
    repeated = runs.repeated()
    edit = _edited(min_chars)
    if repeated is None:
        edited = rows.withColumn("e", edit("text", F.lit(None).cast(_HASHES)))
    else:
        drops = stored(_dropped_marks(lines.select("id", "a", "b"), stored(repeated, "line-repeated")), "line-drops")
        drops = drops.withColumnRenamed("id", "_id").hint("merge")  # it grows with the texts, so the plan is the same at every size
        edited = rows.join(drops, F.col("id").eqNullSafe(F.col("_id")), "left").withColumn("e", edit("text", "drops"))
    kept = F.coalesce("e.kept", "text", F.lit("")).alias("kept")
    return edited.select("id", "e.n_lines", "e.n_dropped", kept)
