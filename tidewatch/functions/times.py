"""Time parsing, epochs and labels. The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_COMPACT = r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])$"


def parse_local(c: Column, offset_hours: int = 8) -> Column:
    """UTC time of a local wall time whose format follows from the length of the text.

    More than 11 characters: date and time; 9 to 11: date with dashes; up to 8: compact date. Null if
    unreadable. A pattern fixes the form and a plain cast reads it, which is cheaper than a formatter
    and does not depend on the session's time zone.
    """

    def read(form: str, text: Column) -> Column:
        return F.when(c.rlike(form), text.try_cast("timestamp_ntz"))

    local = (
        F.when(
            F.length(c) > 11,
            F.coalesce(
                read(f"^{_DAY} {_CLOCK}$", c), read(rf"^{_DAY}\s+{_CLOCK}$", F.regexp_replace(c, r"\s+", " "))
            ),
        )
        .when(F.length(c) > 8, read(f"^{_DAY}$", c))
        .otherwise(read(_COMPACT, F.regexp_replace(c, _COMPACT, "$1-$2-$3")))
    )
    return local_to_utc(local, offset_hours)


def local_to_utc(ts: Column, offset_hours: int = 8) -> Column:
    """A local wall time moved to UTC."""
    return ts - F.expr(f"interval {offset_hours} hours")


def epoch_seconds(ts: Column, offset_hours: int = 0) -> Column:
    """Epoch seconds of a wall time in the given zone."""
    return F.unix_seconds(ts.cast("timestamp")) - offset_hours * 3600


def epoch_millis(ts: Column, offset_hours: int = 0) -> Column:
    return F.unix_millis(ts.cast("timestamp")) - offset_hours * 3_600_000


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy.MM")


def day_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def epoch_text(seconds: Column, offset_hours: int = 0, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text of an epoch second as wall time of the given zone."""
    whole = seconds.cast("bigint") + offset_hours * 3600
    return F.date_format(F.timestamp_seconds(whole), fmt)


def age_text(ts: Column, as_of: Column) -> Column:
    """`Nd Nh Nm` for spans of a day or more (either way), else `Nh Nm Ns`.

    Days are rounded down, so a time in the future gives -1 days and a positive rest. The span is
    taken in microseconds before rounding, as a fraction of a second can change the day.
    """
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    total = F.floor(micros / F.lit(1_000_000)).cast("bigint")
    days = F.floor(total / 86400)
    rest = F.pmod(total, F.lit(86400))
    hours, minutes = F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60)
    return F.when(days != 0, F.format_string("%dd %dh %dm", days, hours, minutes)).otherwise(
        F.format_string("%dh %dm %ds", hours, minutes, F.pmod(rest, F.lit(60)))
    )


def parse_cn_date(c: Column) -> Column:
    """ISO date text of a date written with the year, month and day characters."""
    return F.date_format(F.try_to_timestamp(c, F.lit("yyyy年M月d日")), "yyyy-MM-dd")
