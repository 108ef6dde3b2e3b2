"""Network addresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Fixed value: what an IPv4 address is mapped behind, as hex digits.
MAPPED = "00000000000000000000ffff"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def ip_to_long(c: Column) -> Column:
    """Number of a dotted IPv4 address; null for anything else, IPv6 included."""
    octet = F.split(c, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + F.get(octet, F.lit(i)).cast("bigint")
    return F.when(c.rlike(IPV4), number)


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once, however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def ip_key(c: Column) -> Column:
    """An address as 32 hex digits that sort like addresses: IPv6 in any of its spellings, and dotted IPv4 as its mapped form
    `::ffff:a.b.c.d`. Null for anything else."""

    def hexed(number: Column) -> Column:
        return F.lower(F.lpad(F.hex(number), 8, "0"))

    def groups(half: Column) -> Column:
        return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":"))

    def without_dots(text: Column) -> Column:
        number = hexed(ip_to_long(F.regexp_extract(text, r"([0-9.]*)$", 1)))
        return F.concat(F.regexp_extract(text, r"^(.*:)", 1), _bound(number, lambda h: F.concat(F.substring(h, 1, 4), F.lit(":"), F.substring(h, 5, 4))))

    def filled(sides: Column) -> Column:
        head, rest = F.get(sides, F.lit(0)), F.get(sides, F.lit(1))
        left = 8 - F.size(head) - F.coalesce(F.size(rest), F.lit(0))
        short = F.concat(head, F.array_repeat(F.lit("0"), F.greatest(left, F.lit(0))), rest)
        return F.when((F.size(sides) == 2) & (left > 0), short).when((F.size(sides) == 1) & (left == 0), head)

    def joined(parts: Column) -> Column:
        good = F.forall(parts, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(good, F.array_join(F.transform(parts, lambda g: F.lpad(g, 4, "0")), ""))

    low = F.lower(c)
    plain = F.when(F.contains(c, F.lit(".")), _bound(low, without_dots)).otherwise(low)
    sides = F.transform(F.split(plain, "::"), groups)
    v6 = F.when(F.contains(c, F.lit(":")), _bound(_bound(sides, filled), joined))
    return F.coalesce(v6, F.concat(F.lit(MAPPED), hexed(ip_to_long(c))))


def long_to_ip(n: Column) -> Column:
    """Dotted text of an address number."""
    parts = [F.pmod(F.floor(n / (256**p)), F.lit(256)).cast("string") for p in (3, 2, 1, 0)]
    return F.concat_ws(".", *parts)
