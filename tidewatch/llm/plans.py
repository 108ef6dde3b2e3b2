"""The registered queries of the operators for training data, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, collocations, decontaminate, licenses, line_dedup, quality, resampling, secret_scan, simhash, suffixes, token_counts, toxicity, warc
from tidewatch.llm.common import saved
from tidewatch.plans.local import ensure_shared_folder
from tidewatch.session import work_path

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_shared_folder(spark)
        return fn(spark, folder.rstrip("/"))

    _QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_text("fp").alias("fingerprint"), "component_id")


@_query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@_query
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN, ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(_table(spark, folder, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select(F.col("id").alias("doc_id"), *counts, "base_failed", "kept", "distance")


@_query
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, folder, "documents").select("doc_id", "text"))
    spans, base = F.col("spans"), tuple(r.kind for r in secret_scan.BASE)
    return found.select(
        "doc_id",
        *[secret_scan.count_of(spans, kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.spans_text(spans, base), 256).alias("base_sha256"),
        secret_scan.spans_text(spans).alias("spans"),
    )


@_query
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", F.round("lcs", 6).alias("lcs"), F.round("cosine", 4).alias("cosine"))


SQL["op4_warc"] = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
         f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM p)
    SELECT page_id, n AS payload_bytes, d AS payload_digest,
           CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""


@_query
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = work_path(spark, "warc")
    index = warc.write_archives(_table(spark, folder, "pages"), archives)
    records = saved(warc.with_digests(warc.read_records(index, archives)))
    return warc.payloads(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op5_suffix_dedup"] = """
    WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
         g AS (SELECT doc_id, unnest(generate_series(0, len(ws) - 50)) AS s,
                      unnest(list_transform(generate_series(1, len(ws) - 49), lambda i: md5(array_to_string(ws[i:i + 49], ' ')))) AS h
               FROM w WHERE len(ws) >= 50),
         r AS (SELECT doc_id, s FROM g WHERE h IN (SELECT h FROM g GROUP BY h HAVING min(doc_id) <> max(doc_id))),
         i AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS fresh FROM r),
         n AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM i)
    SELECT doc_id, min(s)::INT AS start_word, (max(s) + 50)::INT AS end_word FROM n GROUP BY doc_id, k
"""


@_query
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.repeated_passages(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"))


@_query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    machine = toxicity.trained(docs, _table(spark, folder, "labels"))
    scored = toxicity.with_scores(docs, machine)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def _template_rows() -> str:
    return ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(licenses.TEMPLATES))


_PATH = """concat_ws('/', source, CASE WHEN doc_id % 100 <> 0 THEN lang END, CASE WHEN doc_id % 100 <> 0 THEN (doc_id // 1000)::VARCHAR END,
                     CASE WHEN doc_id % 10 = 0 THEN 'LICENSE-' || doc_id ELSE 'doc-' || doc_id || '.txt' END)"""
SQL["op7_licenses"] = f"""
    WITH t AS (SELECT * FROM (VALUES {_template_rows()}) AS v(template, licence, said)),
         tp AS (SELECT template, licence, len(ws) AS size, unnest(ws) AS term, generate_subscripts(ws, 1) - 1 AS place FROM (
                  SELECT template, licence, regexp_extract_all(lower(said), '[\\p{{L}}\\p{{N}}]+(?:\\.[0-9]+)*') AS ws FROM t)),
         tw AS (SELECT template, licence, term, count(*) AS tf FROM tp GROUP BY ALL),
         w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+(?:\\.[0-9]+)*') AS ws FROM documents),
         df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(ws) AS term FROM w) WHERE term IN (SELECT term FROM tw) GROUP BY 1),
         total AS (SELECT count(*) + {len(licenses.TEMPLATES)} AS total FROM documents),
         idf AS MATERIALIZED (SELECT term, ln((1 + total) / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT DISTINCT term FROM tw) LEFT JOIN df USING (term), total),
         b2 AS (SELECT template, term, (tf * idf) * (tf * idf) AS b FROM tw JOIN idf USING (term)),
         cum AS (SELECT *, sum(b) OVER (PARTITION BY template) AS whole,
                        coalesce(sum(b) OVER (PARTITION BY template ORDER BY round(b, 9) DESC, term ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b2),
         seed AS (SELECT template, term FROM cum WHERE whole - before >= {licenses.LEAST_COSINE**2!r} * whole),
         p AS (SELECT doc_id, unnest(ws) AS term, generate_subscripts(ws, 1) - 1 AS pos FROM w),
         s AS (SELECT DISTINCT doc_id, tp.template, tp.size, pos - place AS st FROM p JOIN tp USING (term) JOIN seed ON seed.template = tp.template AND seed.term = tp.term),
         v AS MATERIALIZED (SELECT doc_id, template, greatest(st, 0) AS start, ws[greatest(st, 0) + 1:st + size] AS words FROM s JOIN w USING (doc_id)),
         kw AS (SELECT template, words, term, count(*) AS tf FROM (SELECT template, words, unnest(words) AS term FROM (SELECT DISTINCT template, words FROM v)) GROUP BY ALL),
         own AS (SELECT kw.*, kw.tf * coalesce(idf, ln(1 + total) + 1) AS a FROM kw LEFT JOIN idf USING (term), total),
         tn AS (SELECT template, sqrt(sum(b)) AS l FROM b2 GROUP BY 1),
         cos AS (SELECT own.template, words, round(sum(a * sqrt(b) / l) / sqrt(sum(a * a)), 6) AS cosine
                 FROM own JOIN tn USING (template) LEFT JOIN b2 ON b2.template = own.template AND b2.term = own.term GROUP BY 1, 2),
         best AS (SELECT doc_id, start, licence, cosine FROM v JOIN cos USING (template, words) JOIN t USING (template) WHERE cosine >= {licenses.LEAST_COSINE}),
         f AS (SELECT doc_id, {_PATH} AS path, b.licence, b.cosine FROM documents LEFT JOIN (
                 SELECT doc_id, licence, cosine FROM best
                 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, start, licence) = 1) b USING (doc_id)),
         g AS (SELECT regexp_replace(path, '/[^/]*$', '') AS folder, licence, cosine FROM f WHERE licence IS NOT NULL AND contains(path, '/LICENSE-')
               QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/[^/]*$', '') ORDER BY cosine DESC, licence) = 1),
         a AS (SELECT doc_id, g.licence, g.cosine FROM f JOIN g ON f.licence IS NULL AND starts_with(f.path, g.folder || '/')
               QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(g.folder) DESC) = 1)
    SELECT doc_id, f.path, coalesce(f.licence, a.licence) AS licence, round(coalesce(f.cosine, a.cosine), 4) AS cosine,
           CASE WHEN f.licence IS NOT NULL THEN 'stated' WHEN a.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS how
    FROM f LEFT JOIN a USING (doc_id)
"""


@_query
def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: every tenth is a licence file of its directory, every hundredth one of its source."""
    deep = F.when(F.col("doc_id") % 100 != 0, F.concat_ws("/", "lang", F.expr("CAST(doc_id div 1000 AS STRING)")))
    name = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")))
    files = _table(spark, folder, "documents").select("doc_id", "text", F.concat_ws("/", "source", deep, name).alias("path"))
    found = licenses.licences(files)
    return found.select(F.col("id").alias("doc_id"), "path", "licence", F.round("cosine", 4).alias("cosine"), "how")


SQL["op13_line_dedup"] = """
    WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
         l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM t),
         k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
         r AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
         d AS (SELECT k.*, r.holder IS NOT NULL AND doc_id < r.holder AS gone FROM k LEFT JOIN r USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM d GROUP BY doc_id
"""


@_query
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.without_repeated_lines(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


# Unsigned CRC-32 of a text `f` in SQL: a table from the reversed polynomial 3988292384, then a step per byte.
_CRC_TABLE = """(SELECT list(list_reduce(list_prepend(i::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) r(i))"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen(f)), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT)),
                 lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])))"""


def _features_sql(table: str, key: str) -> str:
    return f"""SELECT {key}, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM
                 (SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM {table})"""


SQL["op12_resampling"] = f"""
    WITH df AS MATERIALIZED ({_features_sql("documents", "doc_id")}),
         bf AS MATERIALIZED ({_features_sql("benchmark", "item_id")}),
         fs AS (SELECT f, {_CRC} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf), {_CRC_TABLE}),
         s AS (SELECT bucket, count(*) AS s FROM df JOIN fs USING (f) GROUP BY 1),
         t AS (SELECT bucket, count(*) AS t FROM bf JOIN fs USING (f) GROUP BY 1),
         g AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000))
                                              / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bf) + 10000))))::BIGINT AS gain
               FROM s FULL JOIN t USING (bucket)),
         w AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS total FROM df JOIN fs USING (f) JOIN g USING (bucket) GROUP BY 1),
         d AS (SELECT doc_id, coalesce(n_features, 0) AS n_features,
                      coalesce(total // n_features - CASE WHEN total % n_features < 0 THEN 1 ELSE 0 END, 0) AS weight,
                      ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h
               FROM documents LEFT JOIN w USING (doc_id)),
         z AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d),
         k AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS n, count(*) OVER () AS total FROM z WHERE n_features >= 39)
    SELECT z.doc_id, z.n_features, z.weight, z.score, CASE WHEN k.n <= 25 * k.total // 100 THEN k.n END AS rank FROM z LEFT JOIN k USING (doc_id)
"""


@_query
def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resampling.drawn(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


SQL["op11_collocations"] = """
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
         w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') AS ws FROM p),
         o AS (SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w UNION ALL
               SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w UNION ALL
               SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
         f AS MATERIALIZED (SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM o GROUP BY ALL),
         c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
         u AS MATERIALIZED (SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS first, array_to_string(ws[cut + 1:], ' ') AS rest
               FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
         s AS (SELECT u.lang, u.phrase, a, cut, l.n AS l, r.n AS r, (1000000 * a * a) // (l.n * r.n) AS score
               FROM u JOIN f l ON l.lang = u.lang AND l.phrase = u.first JOIN f r ON r.lang = u.lang AND r.phrase = u.rest),
         b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
         g AS (SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase, a FROM c WHERE k = 3),
         kept AS (SELECT b.* FROM b LEFT JOIN (SELECT lang, phrase, max(a) AS held FROM g GROUP BY ALL) h USING (lang, phrase)
                  WHERE held IS NULL OR 100 * held < 50 * a),
         t AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank, phrase,
           a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept JOIN t USING (lang) QUALIFY rank <= 2000
"""


@_query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))
