"""Places of IP addresses by range lookup."""

from __future__ import annotations

import os.path
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.net import MAPPED, ip_key, ip_to_long, long_to_ip
from tidewatch.operators.joins import small_or_hashed
from tidewatch.session import checkpointed

# Names of the derived columns after the address column's name.
PLACE_FIELDS = (
    "country_name",
    "country_name_zh",
    "country_iso_code",
    "city_name_zh",
    "city_name_en",
    "region_code",
    "region_zh",
)
NO_ADDRESS = "0.0.0.0"
WALK_BITS = 16
BUCKET_BITS = (8, 10, 12, 14, 16, 20, 24)
# Bytes of range pieces that may be broadcast, and pieces of one bucket that an address may be compared with.
BROADCAST_BYTES = 128 << 20
BUCKET_PIECES = 256
PIECE_BYTES = 96  # a piece without its texts
# Rows of one /16 bucket that a task walks; a bucket with more is dealt to several tasks.
WALK_ROWS = 1 << 20
# Hex digits of the prefix by which IPv6 ranges are dealt out. Disjoint ranges that share a shorter prefix and differ in the
# next digit are at most 15 for each prefix, so there are less than 16 ** SHORT of them.
SHORT = 4


def _bucket(address: Column, bits: int) -> Column:
    return F.shiftright(address, bits)


def _cut(ranges: DataFrame, bits: int, *kept: str) -> DataFrame:
    """Ranges cut at the borders of buckets of `2^bits` addresses: `_bucket`, `_lo`, `_hi` and the kept columns."""
    buckets = F.sequence(_bucket(F.col("start_ip"), bits), _bucket(F.col("end_ip"), bits))
    first = F.shiftleft("_bucket", bits)
    return ranges.withColumn("_bucket", F.explode(buckets)).select(
        "_bucket",
        F.greatest("start_ip", first).alias("_lo"),
        F.least("end_ip", first + (2**bits - 1)).alias("_hi"),
        *kept,
    )


def _place() -> Column:
    """The place of a range as one struct. A longitude of exactly 0 gives no location."""
    return F.struct(F.when(F.col("lon") != 0, F.struct("lon", "lat")).alias("location"), *PLACE_FIELDS).alias("_place")


def visible_stretches(ranges: Iterable[tuple]) -> Iterator[tuple]:
    """Stretches of which no two overlap, from ranges (bucket, first, last, mark) sorted by bucket, then as they win: by original start, and
    of equal starts the longest first. Gives (bucket, first, last, mark).

    A sweep that keeps the open ranges on a stack, the one that counts on top. A range that ends no later than one which starts after it
    never counts again and leaves the stack, so the ends on it fall from bottom to top and each range is put and taken once.
    """
    bucket, at, stack = None, 0, []

    def closed(before: int | None) -> Iterator[tuple]:
        nonlocal at
        while stack and (before is None or stack[-1][0] < before):
            last, mark = stack.pop()
            if last >= at:
                yield bucket, at, last, mark
                at = last + 1

    for own, first, last, mark in ranges:
        if own != bucket:
            yield from closed(None)
            bucket, at = own, first
        yield from closed(first)
        if stack and at < first:
            yield bucket, at, first - 1, stack[-1][1]
        at = first
        while stack and stack[-1][0] <= last:
            stack.pop()
        stack.append((last, mark))
    yield from closed(None)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`visible_stretches` over sorted batches of `_bucket`, `_lo`, `_hi`, `start_ip`, `end_ip`, holding one batch and the open ranges."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    found: list[tuple] = []

    def packed() -> pa.RecordBatch:
        lo, hi, marks = zip(*found, strict=True)
        columns = [lo, hi, [m[0] for m in marks], [m[1] for m in marks]]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["_at", "_to", "_start", "_end"])

    for _, first, last, mark in visible_stretches((b, lo, hi, (start, end)) for b, lo, hi, start, end in rows):
        found.append((first, last, mark))
        if len(found) == 8192:
            yield packed()
            found.clear()
    if found:
        yield packed()


def _one_place(ranges: DataFrame) -> DataFrame:
    """Ranges that do not end before they start, equal ones once, under the least place: `start_ip`, `end_ip`, `_place`."""
    good = ranges.where("start_ip <= end_ip").groupBy("start_ip", "end_ip").agg(F.min(F.struct(_place(), "lon", "lat")).alias("_p"))
    return good.select("start_ip", "end_ip", F.col("_p._place").alias("_place"))


def disjoint_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges as `start_ip`, `end_ip`, `_place` of which no two overlap.

    An address in several ranges belongs to the one that starts last, of these to the one that ends first, of equal ranges to
    the least place. Ranges that end before they start, and null ends, are dropped. Only buckets of 65,536 addresses in
    which ranges overlap are cut anew, by one sweep over each (see `visible_stretches`).
    """
    whole = _one_place(ranges)
    pieces = _cut(whole, WALK_BITS, "start_ip", "end_ip", "_place")
    before = Window.partitionBy("_bucket").orderBy("_lo", "_hi", "start_ip", "end_ip").rowsBetween(Window.unboundedPreceding, -1)
    crowded = pieces.withColumn("_reach", F.max("_hi").over(before)).where("_lo <= _reach").select("_bucket").distinct()
    crowded = checkpointed(crowded)
    if crowded.isEmpty():
        return whole
    mixed = pieces.join(crowded, "_bucket", "left_semi").select("_bucket", "_lo", "_hi", "start_ip", "end_ip")
    sorted_ = mixed.repartition("_bucket").sortWithinPartitions("_bucket", "start_ip", F.desc("end_ip"))
    best = sorted_.mapInArrow(_swept, "_at long, _to long, _start long, _end long")
    met = best.join(whole, (F.col("_start") == F.col("start_ip")) & (F.col("_end") == F.col("end_ip")))
    cut = met.select(F.col("_at").alias("start_ip"), F.col("_to").alias("end_ip"), "_place")
    return pieces.join(crowded, "_bucket", "left_anti").select(F.col("_lo").alias("start_ip"), F.col("_hi").alias("end_ip"), "_place").unionByName(cut)


def range_pieces(ranges: DataFrame, bits: int = WALK_BITS) -> DataFrame:
    """Pieces of disjoint ranges by bucket: `_bucket`, first and last address, and the place."""
    return _cut(ranges, bits, "_place")


def _piece_size() -> Column:
    return F.coalesce(F.octet_length(F.to_json("_place")), F.lit(0)) + PIECE_BYTES


def finest_bits(ranges: DataFrame, limit: int) -> int | None:
    """Bits of the smallest bucket that cuts disjoint ranges into pieces of at most `limit` bytes in all; None if none does,
    or if a bucket would hold more than `BUCKET_PIECES` of them."""
    lo, hi, size = F.col("start_ip"), F.col("end_ip"), _piece_size()
    pieces = [F.sum((_bucket(hi, b) - _bucket(lo, b) + 1) * size).alias(str(b)) for b in BUCKET_BITS]
    counted = ranges.agg(*pieces).first()
    bits = next((b for b in BUCKET_BITS if (counted[str(b)] or 0) <= limit), None)
    if bits is None:
        return None
    fullest = range_pieces(ranges, bits).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return bits if (fullest or 0) <= BUCKET_PIECES else None


def _usable(c: Column) -> Column:
    return F.when(c != NO_ADDRESS, ip_to_long(c))


def _place_columns(ip: str, place: Column) -> list[Column]:
    fields = ("location", *PLACE_FIELDS)
    return [place[f].alias(f"{ip}_{f}") for f in fields]


def _with_broadcast(df: DataFrame, ip: str, pieces: DataFrame, bits: int) -> DataFrame:
    left = df.withColumn("_ip", _usable(F.col(ip))).withColumn("_b", _bucket(F.col("_ip"), bits))
    hit = (F.col("_b") == F.col("_bucket")) & F.col("_ip").between(F.col("_lo"), F.col("_hi"))
    joined = left.join(F.broadcast(pieces), hit, "left")
    return joined.select(*df.columns, *_place_columns(ip, F.col("_place")))


def places_of(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """Place of each distinct address text in column `_text`, by walking addresses and ranges in order.

    Work per /16 bucket is linear, and a bucket holds at most 65,536 addresses and as many ranges.
    """
    ips = addresses.select("_text", _usable(F.col("_text")).alias("_at")).filter(F.col("_at").isNotNull())
    walk = range_pieces(ranges).select(
        "_bucket", F.col("_lo").alias("_at"), F.lit(0).alias("_kind"), "_hi", "_place"
    ).unionByName(
        ips.select(_bucket(F.col("_at"), WALK_BITS).alias("_bucket"), "_at", F.lit(1).alias("_kind"), "_text"),
        allowMissingColumns=True,
    )
    so_far = Window.partitionBy("_bucket").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    piece = F.last(F.when(F.col("_kind") == 0, F.struct("_hi", "_place")), True).over(so_far)
    return (
        walk.withColumn("_piece", piece)
        .filter((F.col("_kind") == 1) & (F.col("_at") <= F.col("_piece._hi")))
        .select("_text", F.col("_piece._place").alias("_place"))
    )


def _address_counts(df: DataFrame, ip_cols: Sequence[str]) -> DataFrame:
    """Rows `_n` and about how many distinct addresses `_d` each column (`_of`) has in each /16 bucket, kept."""
    each = F.array(*[F.struct(F.lit(i).alias("_of"), _usable(F.col(ip)).alias("_at")) for i, ip in enumerate(ip_cols)])
    found = df.select(F.explode(each).alias("_a")).select("_a.*").where("_at IS NOT NULL")
    counts = found.groupBy("_of", _bucket(F.col("_at"), WALK_BITS).alias("_bucket"))
    return checkpointed(counts.agg(F.count(F.lit(1)).alias("_n"), F.approx_count_distinct("_at", 0.2).alias("_d")))


def _walked(df: DataFrame, ip: str, ranges: DataFrame, busy: DataFrame) -> DataFrame:
    """`df` with the place columns of an address column, by walking its rows and the ranges in order: rows are shuffled once, and
    neither made distinct nor joined back. Buckets in `busy` (`_bucket`, `_tasks`) meet their ranges in that many tasks, and rows
    without an address go to many tasks under buckets that hold no range.
    """
    spread = F.monotonically_increasing_id()
    rows = df.select("*", _usable(F.col(ip)).alias("_at"), spread.alias("_row"), F.lit(1).alias("_kind"))
    rows = rows.withColumn("_bucket", F.coalesce(_bucket(F.col("_at"), WALK_BITS), -1 - F.pmod("_row", F.lit(4096))))
    pieces = range_pieces(ranges).select("_bucket", F.col("_lo").alias("_at"), F.lit(0).alias("_kind"), "_hi", "_place")
    place = ["_bucket"]
    if not busy.isEmpty():
        place, tasks = ["_bucket", "_task"], F.coalesce("_tasks", F.lit(1))
        rows = rows.join(small_or_hashed(busy), "_bucket", "left").withColumn("_task", F.pmod("_row", tasks)).drop("_tasks")
        dealt = F.explode(F.sequence(F.lit(0).cast("bigint"), tasks - 1))
        pieces = pieces.join(small_or_hashed(busy), "_bucket", "left").withColumn("_task", dealt).drop("_tasks")
    walk = rows.drop("_row").unionByName(pieces, allowMissingColumns=True)
    so_far = Window.partitionBy(*place).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    walk = walk.withColumn("_piece", F.last(F.when(F.col("_kind") == 0, F.struct("_hi", "_place")), True).over(so_far)).where("_kind = 1")
    met = F.when(F.col("_at") <= F.col("_piece._hi"), F.col("_piece._place"))
    return walk.withColumn("_place", met).select(*df.columns, *_place_columns(ip, F.col("_place")))


def _swept_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As `_swept`, over keys of hex digits, with the prefix that both ends of a stretch share."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    names = ["_level", "_prefix", "_at", "_to", "_start", "_end"]
    found: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*found, strict=True)]
        return pa.record_batch([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.string()) for c in columns[1:])], names)

    ranges = ((b, int(lo, 16), int(hi, 16), (start, end)) for b, lo, hi, start, end in rows)
    for _, first, last, mark in visible_stretches(ranges):
        lo, hi = f"{first:032x}", f"{last:032x}"
        prefix = os.path.commonprefix([lo, hi])
        found.append((len(prefix), prefix, lo, hi, *mark))
        if len(found) == 8192:
            yield packed()
            found.clear()
    if found:
        yield packed()


def prefix_pieces(ranges: DataFrame) -> DataFrame:
    """IPv6 ranges (`start_ip`, `end_ip` as text, and the places) as stretches of which no two overlap, each under the prefix of
    `_level` hex digits that all its addresses share: `_level`, `_prefix`, `_at`, `_to`, `_place`.

    The rule for overlapping ranges is that of `disjoint_ranges`. Ranges are cut at the borders of 2^112 addresses and
    swept in order.
    """
    keyed = ranges.withColumns({"start_ip": ip_key(F.col("start_ip")), "end_ip": ip_key(F.col("end_ip"))})
    whole = checkpointed(_one_place(keyed))
    first, last = (F.conv(F.substring(c, 1, 4), 16, 10).cast("int") for c in ("start_ip", "end_ip"))
    cut = whole.select("start_ip", "end_ip", F.explode(F.sequence(first, last)).alias("_bucket"))
    border = F.lower(F.lpad(F.hex("_bucket"), 4, "0"))
    cut = cut.withColumns({"_lo": F.greatest("start_ip", F.rpad(border, 32, "0")), "_hi": F.least("end_ip", F.rpad(border, 32, "f"))})
    sorted_ = cut.repartition("_bucket").sortWithinPartitions("_bucket", "start_ip", F.desc("end_ip"))
    fields = "_level int, _prefix string, _at string, _to string, _start string, _end string"
    swept = sorted_.select("_bucket", "_lo", "_hi", "start_ip", "end_ip").mapInArrow(_swept_keys, fields)
    met = swept.join(whole, (F.col("_start") == F.col("start_ip")) & (F.col("_end") == F.col("end_ip")))
    return met.select("_level", "_prefix", "_at", "_to", "_place")


def places_of_keys(keys: DataFrame, pieces: DataFrame) -> DataFrame:
    """`keys` that have a place, with it, by joins on prefixes of the address in `_key` of the lengths that `pieces` have (33 at most).

    A prefix holds at most 15 stretches, as disjoint ones differ in the digit after it, so no address is compared with many.
    Stretches under short prefixes, where many addresses meet, are few by that bound and are broadcast.
    """
    levels = sorted(r["_level"] for r in pieces.select("_level").distinct().collect())

    def met(levels: list[int], pieces: DataFrame) -> DataFrame:
        prefixes = [F.struct(F.lit(n).alias("_level"), F.substring("_key", 1, n).alias("_prefix")) for n in levels]
        wide = keys.withColumn("_p", F.explode(F.array(*prefixes))).select(*keys.columns, "_p.*")
        return wide.join(pieces, ["_level", "_prefix"]).where(F.col("_key").between(F.col("_at"), F.col("_to"))).select(*keys.columns, "_place")

    found = [
        met(own, F.broadcast(part) if own[0] < SHORT else part)
        for own, part in (
            ([n for n in levels if n < SHORT], pieces.where(F.col("_level") < SHORT)),
            ([n for n in levels if n >= SHORT], pieces.where(F.col("_level") >= SHORT)),
        )
        if own
    ]
    if not found:
        return keys.limit(0).crossJoin(pieces.select("_place").limit(0))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _joined_back(df: DataFrame, key: Column, places: DataFrame) -> DataFrame:
    """`df` with the `_place` of its key. Rows without a key go to many tasks under keys that meet nothing."""
    spread = F.concat(F.lit("-"), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("string"))
    return df.withColumn("_key", F.coalesce(key, spread)).join(places, F.col("_key") == F.col("_met"), "left").drop("_key", "_met")


def _with_places6(df: DataFrame, ip_cols: Sequence[str], ranges: DataFrame, broadcast_bytes: int, ranges6: DataFrame) -> DataFrame:
    """Fills the place columns of addresses with a colon. Reading an address is dear, so it is done once for each distinct text, and places are
    joined back by text. An address of `ranges` in IPv6 spelling has its place there, and what that lacks from `ranges6`."""
    fields = ("location", *PLACE_FIELDS)
    texts = {ip: F.when(F.contains(F.col(ip), F.lit(":")) & F.col(ip).rlike("^[0-9A-Fa-f:.]+$"), F.col(ip)) for ip in ip_cols}
    distinct = df.select(F.explode(F.array(*texts.values())).alias("_met")).where("_met IS NOT NULL").distinct()
    keyed = checkpointed(distinct.withColumn("_key", ip_key(F.col("_met"))).where("_key IS NOT NULL"))
    pieces = checkpointed(prefix_pieces(ranges6))
    mapped = F.substring("_key", 1, 24) == MAPPED
    only6, both = keyed.where(~mapped), keyed.where(mapped)
    dotted = long_to_ip(F.conv(F.substring("_key", 25, 8), 16, 10).cast("bigint"))
    four = _with_places4(both.select("_met", dotted.alias("_v4")), ["_v4"], ranges, broadcast_bytes)
    four = four.join(places_of_keys(both, pieces).drop("_key"), "_met", "left")
    first = F.struct(*[F.coalesce(F.col(f"_v4_{f}"), F.col("_place")[f]).alias(f) for f in fields])
    places = checkpointed(places_of_keys(only6, pieces).drop("_key").unionByName(four.select("_met", first.alias("_place"))))
    for ip in ip_cols:
        names = [f"{ip}_{f}" for f in fields]
        other = [c for c in df.columns if c not in names]
        filled = [F.coalesce(F.col(n), F.col("_place")[f]).alias(n) for n, f in zip(names, fields, strict=True)]
        df = _joined_back(df, texts[ip], places).select(*other, *filled)
    return df


def geo_enrich(
    df: DataFrame, ip_cols: Sequence[str], ranges: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, ranges6: DataFrame | None = None
) -> DataFrame:
    """Left lookup of each address column; adds its location, country, city and region columns.

    Ranges may overlap: see `disjoint_ranges` for the one that counts, whichever way is taken. The disjoint ranges are
    measured. If they can be cut into pieces of at most `broadcast_bytes`, few in every bucket, these are broadcast, in the
    smallest buckets that allows, and `df` is not shuffled at all. Otherwise each column is placed by an ordered walk: of its distinct
    addresses, if the places of these can be broadcast, else of the rows, which are shuffled once by bucket. Addresses that have
    no place go to many tasks under buckets that meet nothing, and buckets with very many rows to several tasks.

    `ranges6` has the ranges of IPv6 addresses, their ends as text. With it, IPv6 addresses in any spelling get their places too,
    and IPv4 addresses that are written as IPv6 ones (`::ffff:1.2.3.4`) those of `ranges`.
    """
    columns = df.columns
    ranges = checkpointed(disjoint_ranges(ranges))
    placed = _with_places4(df, ip_cols, ranges, broadcast_bytes)
    if ranges6 is not None:
        placed = _with_places6(placed, ip_cols, ranges, broadcast_bytes, ranges6)
    return placed.select(*columns, *[f"{ip}_{f}" for ip in ip_cols for f in ("location", *PLACE_FIELDS)])


def _with_places4(df: DataFrame, ip_cols: Sequence[str], ranges: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Places by disjoint ranges, kept."""
    bits = finest_bits(ranges, broadcast_bytes)
    if bits is not None:
        pieces = range_pieces(ranges, bits)
        for ip in ip_cols:
            df = _with_broadcast(df, ip, pieces, bits)
        return df
    counts = _address_counts(df, ip_cols)
    distinct = {r["_of"]: r["_d"] for r in counts.groupBy("_of").agg(F.sum("_d").alias("_d")).collect()}
    size = ranges.agg(F.avg(_piece_size())).first()[0] or 0
    columns = df.columns
    few = [i for i in range(len(ip_cols)) if distinct.get(i, 0) * size <= broadcast_bytes]
    for i in sorted(range(len(ip_cols)), key=few.__contains__):
        ip, own = ip_cols[i], df.columns
        if i in few:
            texts = df.select(F.col(ip).alias("_text")).distinct()
            places = checkpointed(places_of(texts, ranges))
            df = df.join(F.broadcast(places), F.col(ip) == F.col("_text"), "left").select(*own, *_place_columns(ip, F.col("_place")))
        else:
            busy = counts.where((F.col("_of") == i) & (F.col("_n") > WALK_ROWS))
            df = _walked(df, ip, ranges, busy.select("_bucket", F.ceil(F.col("_n") / WALK_ROWS).alias("_tasks")))
    return df.select(*columns, *[f"{ip}_{f}" for ip in ip_cols for f in ("location", *PLACE_FIELDS)])
