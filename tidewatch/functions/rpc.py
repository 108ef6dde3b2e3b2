"""JSON-RPC envelopes and severity labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.text import hide_secrets, python_text

# Severity names by number.
SEVERITIES = ("not_classified", "information", "warning", "average", "high", "disaster")


def severity(prio: Column) -> Column:
    """Severity name of 0 to 5, else `unknown`."""
    names = F.array(*[F.lit(s) for s in SEVERITIES])
    number = prio.try_cast("int")
    return F.coalesce(F.when(number >= 0, F.get(names, number)), F.lit("unknown"))


def request_json(method: Column, params: Column, auth: Column, number: Column) -> Column:
    """A request envelope. `params` is a struct or map; a null `auth` is written as null."""
    body = F.struct(
        F.lit("2.0").alias("jsonrpc"),
        method.alias("method"),
        params.alias("params"),
        auth.alias("auth"),
        number.alias("id"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def outcome(response: Column) -> Column:
    """`error`, `ok`, `missing` (no result), `empty` or `broken` (not JSON) for an answer text."""
    keys = F.json_object_keys(response)
    is_error = F.get_json_object(response, "$.error").startswith("{")
    return (
        F.when(F.length(response) == 0, "empty")
        .when(keys.isNull(), "broken")
        .when(is_error, "error")
        .when(F.array_contains(keys, "result"), "ok")
        .otherwise("missing")
    )


def error_text(response: Column) -> Column:
    """Message, data and code of an error answer, secrets masked; missing parts get defaults."""
    part = F.from_json(
        F.get_json_object(response, "$.error"), "struct<message string, data string, code bigint>"
    )
    text = F.format_string(
        "%s %s [%s]",
        F.coalesce(part["message"], F.lit("")),
        python_text(part["data"]),
        F.coalesce(part["code"], F.lit(-1)).cast("string"),
    )
    return F.when(outcome(response) == "error", hide_secrets(text))
