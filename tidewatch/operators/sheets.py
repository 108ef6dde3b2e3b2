"""Sheets that end at their first blank key cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_until_blank(sheet: DataFrame, key: str, order: str = "row_idx") -> DataFrame:
    """Rows before the first one whose key is null or empty; later rows are ignored even if filled.

    The end row is a scalar subquery, so no window over the whole sheet is needed.
    """
    blank = F.col(key).isNull() | (F.col(key) == "")
    end = sheet.filter(blank).agg(F.min(order)).scalar()
    return sheet.filter(end.isNull() | (F.col(order) < end))
