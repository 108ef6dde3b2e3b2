"""Numbers in text, and numbers as text."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit labels, smallest first, padded to one width.
BYTE_UNITS = ("B/s  ", "KiB/s", "MiB/s", "GiB/s", "TiB/s")
BIT_UNITS = ("bps  ", "Kbps ", "Mbps ", "Gbps ", "Tbps ")


def comma_int(c: Column) -> Column:
    """Integer from text such as `1,024`; null if it is not one."""
    return F.trim(F.replace(c, F.lit(","), F.lit(""))).try_cast("bigint")


@cache
def _digits() -> tuple[str, str]:
    """All decimal digits of all scripts, and their ASCII forms."""
    found = [(chr(c), d) for c in range(128, sys.maxunicode + 1) if (d := unicodedata.decimal(chr(c), None)) is not None]
    return "".join(c for c, _ in found), "".join(str(d) for _, d in found)


def ascii_digits(c: Column) -> Column:
    """Text with the decimal digits of any script, such as full-width ones, in ASCII."""
    return F.translate(c, *_digits())


def round_tenths(x: Column) -> Column:
    """`x` rounded to one decimal by its exact binary value, ties to even.

    Java formatting rounds the shortest decimal form half up, which differs from C formatting for
    values such as 2.25. `x * 10` is `x * 8 + x * 2` with both parts exact, so `err` is the exact
    rounding error of the product and tells on which side of a tie the true value lies.
    """
    product = x * 10
    err = x * 2 - (product - x * 8)
    base = F.floor(product).cast("double")
    part = product - base
    odd = F.pmod(base, F.lit(2.0)) == 1
    up = (part > 0.5) | ((part == 0.5) & ((err > 0) | ((err == 0) & odd)))
    return (base + F.when(up, 1.0).otherwise(0.0)) / 10


def humanize(value: Column, multiplier: int, units: tuple[str, ...]) -> Column:
    """`value * multiplier` scaled by 1024 until it is below 1024, with its unit.

    A value too large for the largest unit is divided once more and keeps that unit's label.
    """
    x = value.cast("double") * multiplier
    scaled, unit = x, F.lit(units[0])
    for step in range(1, len(units) + 1):
        over = x >= float(1024**step)
        scaled = F.when(over, x / float(1024**step)).otherwise(scaled)
        unit = F.when(over, F.lit(units[min(step, len(units) - 1)])).otherwise(unit)
    return F.format_string("%6.1f %s", round_tenths(scaled), unit)


def humanize_bytes(value: Column) -> Column:
    """Rate text. The factor 8 together with byte labels is the documented behaviour."""
    return humanize(value, 8, BYTE_UNITS)


def humanize_bits(value: Column) -> Column:
    return humanize(value, 1, BIT_UNITS)


def humanize_percent(value: Column) -> Column:
    """Whole percent of a fraction, cut towards zero and padded to the width of the rate texts."""
    return F.format_string("%6d %%    ", (value.cast("double") * 100).cast("bigint"))
