"""Request logs. Events stand for requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.rpc import request_json, severity
from tidewatch.functions.text import flat_base64
from tidewatch.functions.times import age_text, epoch_millis, epoch_text
from tidewatch.operators.rpclog import read_answers, recent_requests
from tidewatch.plans.registry import Tables, query


def request_log(t: Tables) -> DataFrame:
    """One request per event; its type decides the answer."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    params = F.struct(F.concat(F.lit("u"), "user_id").alias("user"), F.concat(F.lit("s3cret"), k).alias("password"))
    auth = F.when(kind != "signup", F.md5(F.col("user_id").cast("string")))
    request = request_json(F.concat(kind, F.lit(".get")), params, auth, F.col("event_id"))
    failed = F.struct(
        F.struct(F.lit(-32602).alias("code"), F.lit("Invalid params.").alias("message"), F.concat(F.lit("k "), k).alias("data")).alias("error")
    )
    good = F.to_json(F.struct(F.struct(F.col("user_id").alias("id")).alias("result")))
    response = (
        F.when(kind == "error", F.to_json(failed))
        .when(kind == "view", good)
        .when(kind == "click", '{"id": 1}')
        .when(kind == "signup", "")
        .otherwise(F.substring(good, F.lit(1), F.length(good) - 1))
    )
    return t.events.select("event_id", request.alias("request"), response.alias("response"))


@query(
    "rpc_answers",
    """
    SELECT event_id,
           '{"jsonrpc":"2.0","method":"' || event_type || '.get","params":{"user":"u' || user_id || '","password":"***"},"auth":'
           || CASE event_type WHEN 'signup' THEN 'null' ELSE '"***"' END || ',"id":' || event_id || '}' AS request,
           CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'ok' WHEN 'click' THEN 'missing' WHEN 'signup' THEN 'empty'
                ELSE 'broken' END AS outcome,
           CASE event_type WHEN 'view' THEN '{"id":' || user_id || '}' END AS result,
           CASE event_type WHEN 'error' THEN 'Invalid params. k ' || (props::JSON ->> '$.k') || ' [-32602]' END AS error
    FROM events
    """,
)
def rpc_answers(t: Tables) -> DataFrame:
    return read_answers(request_log(t)).drop("response")


@query(
    "recent_requests",
    """
    SELECT event_type AS server, event_id, age FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS age FROM events) WHERE age <= 10
    """,
)
def recent(t: Tables) -> DataFrame:
    out = recent_requests(t.events, "event_type", "ts", "event_id")
    return out.select(F.col("event_type").alias("server"), "event_id", "age")


@query(
    "severity_age",
    """
    WITH e AS (SELECT *, (props::JSON ->> '$.k')::BIGINT % 8 - 1 AS prio,
                      floor((epoch_us(TIMESTAMP '2024-01-15 12:00:00') - epoch_us(ts)) / 1000000)::BIGINT AS s FROM events),
    p AS (SELECT *, floor(s / 86400)::BIGINT AS d, s - floor(s / 86400)::BIGINT * 86400 AS r FROM e)
    SELECT event_id, CASE prio WHEN 0 THEN 'not_classified' WHEN 1 THEN 'information' WHEN 2 THEN 'warning' WHEN 3 THEN 'average'
             WHEN 4 THEN 'high' WHEN 5 THEN 'disaster' ELSE 'unknown' END AS severity,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown, epoch_us(ts) // 1000 AS millis,
           CASE WHEN d <> 0 THEN d || 'd ' || (r // 3600) || 'h ' || (r % 3600 // 60) || 'm'
                ELSE (r // 3600) || 'h ' || (r % 3600 // 60) || 'm ' || (r % 60) || 's' END AS age,
           md5(user_id::VARCHAR) AS digest, to_base64(encode('user' || user_id || ':' || props || props || props || props || props)) AS basic
    FROM p
    """,
)
def severity_age(t: Tables) -> DataFrame:
    prio = F.pmod(F.get_json_object("props", "$.k").cast("bigint"), F.lit(8)) - 1
    login = F.concat(F.lit("user"), "user_id", F.lit(":"), F.repeat("props", 5))
    return t.events.select(
        "event_id",
        severity(prio).alias("severity"),
        epoch_text(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("shown"),
        epoch_millis(F.col("ts")).alias("millis"),
        age_text(F.col("ts"), F.lit("2024-01-15 12:00:00")).alias("age"),
        F.md5(F.col("user_id").cast("string")).alias("digest"),
        flat_base64(F.encode(login, "UTF-8")).alias("basic"),
    )
