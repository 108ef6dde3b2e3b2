"""Request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.rpc import error_text, outcome
from tidewatch.functions.text import hide_secrets

# Length of the request history.
HISTORY = 10


def recent_requests(log: DataFrame, key: str, order: str, tie: str, n: int = HISTORY) -> DataFrame:
    """The latest n requests per server, newest last as in a bounded queue (`age` 1 is the newest)."""
    newest = Window.partitionBy(key).orderBy(F.col(order).desc(), F.col(tie).desc())
    ranked = log.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n)
    return ranked.withColumn("age", F.col("_rn").cast("bigint")).drop("_rn")


def read_answers(log: DataFrame, request: str = "request", response: str = "response") -> DataFrame:
    """Adds masked request text, outcome, result text and error text."""
    answer = F.col(response)
    return log.withColumns(
        {
            request: hide_secrets(F.col(request)),
            "outcome": outcome(answer),
            "result": F.when(outcome(answer) == "ok", F.get_json_object(answer, "$.result")),
            "error": error_text(answer),
        }
    )
