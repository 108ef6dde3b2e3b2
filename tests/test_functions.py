from __future__ import annotations

import base64
import datetime as dt
import hashlib
import random

from pyspark.sql import functions as F

from tests.helpers import each, one
from tidewatch.functions import net, numbers, rpc, text, times


def test_comma_int(spark):
    got = each(spark, ["1,024", " 7 ", "", "1.5", "x", None, "-3", "12,34"], "string", lambda c: numbers.comma_int(F.col(c)))
    assert got == [1024, 7, None, None, None, None, -3, 1234]


def test_round_tenths_like_c(spark):
    rnd = random.Random(5)
    values = [2.25, 2.75, 0.15, 0.25, 0.05, 1023.95, -8.0, 0.0, 2.35, 1e12 + 0.25]
    values += [rnd.uniform(0, 1024) for _ in range(300)] + [rnd.randrange(0, 20000) / 20 for _ in range(300)]
    got = each(spark, values, "double", lambda c: F.format_string("%6.1f", numbers.round_tenths(F.col(c))))
    assert got == ["%6.1f" % v for v in values]


def test_humanize(spark):
    values = [0.0, 100.0, 128.0, 1024.0**4, 1024.0**5, 1024.0**6, -1.0]
    assert each(spark, values, "double", lambda c: numbers.humanize_bytes(F.col(c))) == [
        "   0.0 B/s  ", " 800.0 B/s  ", "   1.0 KiB/s", "   8.0 TiB/s", "   8.0 TiB/s", "8192.0 TiB/s", "  -8.0 B/s  ",
    ]
    assert each(spark, values[:4], "double", lambda c: numbers.humanize_bits(F.col(c))) == [
        "   0.0 bps  ", " 100.0 bps  ", " 128.0 bps  ", "   1.0 Tbps ",
    ]
    assert each(spark, [0.999, 1.0, -1.0], "double", lambda c: numbers.humanize_percent(F.col(c))) == [
        "    99 %    ", "   100 %    ", "  -100 %    ",
    ]


def test_parse_local_by_length(spark):
    values = [
        "2019-01-10 01:02:03", "2019-1-10 1:2:3", "2019-01-10", "2019-1-10", "20190110", "2019-1-1", "2019110",
        "2019-01-10  01:02:03", "2019-13-01", "", None, "2019-02-30", "12019-01-10", "2019-01-10 24:00:00", "2019-01-10T01:02:03",
        "2019-01-10 01:02:03.5", " 2019-01-10",
    ]
    got = each(spark, values, "string", lambda c: times.parse_local(F.col(c)))
    at = dt.datetime(2019, 1, 9, 17, 2, 3)
    day = dt.datetime(2019, 1, 9, 16)
    assert got == [at, at, day, day, day, None, day, at] + [None] * 9


def test_epochs(spark):
    row, schema = (dt.datetime(2019, 1, 18, 22, 0, 0, 250000),), "x timestamp_ntz"
    assert one(spark, times.epoch_seconds(F.col("x")), schema, row) == 1547848800
    assert one(spark, times.epoch_seconds(F.col("x"), 8), schema, row) == 1547820000
    assert one(spark, times.epoch_millis(F.col("x")), schema, row) == 1547848800250
    assert one(spark, times.epoch_text(F.lit("1547820000"), 8)) == "2019-01-18 22:00:00"
    assert one(spark, times.month_label(F.col("x")), schema, row) == "2019.01"
    assert one(spark, times.day_label(F.col("x")), schema, row) == "2019-01-18"


def test_age_text(spark):
    as_of = dt.datetime(2024, 1, 15, 12)
    spans = [dt.timedelta(0), dt.timedelta(seconds=59), dt.timedelta(days=1), dt.timedelta(days=3, hours=5, minutes=7, seconds=9),
             dt.timedelta(seconds=-1), dt.timedelta(microseconds=-1), dt.timedelta(hours=23, minutes=59, seconds=59.5)]
    got = each(spark, [as_of - s for s in spans], "timestamp_ntz", lambda c: times.age_text(F.col(c), F.lit("2024-01-15 12:00:00")))
    assert got == ["0h 0m 0s", "0h 0m 59s", "1d 0h 0m", "3d 5h 7m", "-1d 23h 59m", "-1d 23h 59m", "23h 59m 59s"]


def test_cn_date(spark):
    assert each(spark, ["2019年3月7日", "2019年03月07日", "2019-03-07"], "string", lambda c: times.parse_cn_date(F.col(c))) == [
        "2019-03-07", "2019-03-07", None,
    ]


def test_ip(spark):
    values = ["1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "::1", "", None, "0.0.0.0", "1.2.3.04"]
    assert each(spark, values, "string", lambda c: net.ip_to_long(F.col(c))) == [
        16909060, 4294967295, None, None, None, None, None, 0, None,
    ]
    assert each(spark, [16909060, 4294967295, 0], "bigint", lambda c: net.long_to_ip(F.col(c))) == [
        "1.2.3.4", "255.255.255.255", "0.0.0.0",
    ]


def test_globs(spark):
    names = ["web-1", "web.1", "db1", None, "a]b", "web\n2", "Web-1", "x^y", "a-b"]

    def match(*patterns):
        return each(spark, names, "string", lambda c: text.glob_match(F.col(c), patterns))

    assert match("web*") == [True, True, False, False, False, True, False, False, False]
    assert match("web?1", "d[a-c]1") == [True, True, True, False, False, False, False, False, False]
    assert match("web[!.]1") == [True] + [False] * 8
    assert match("*") == [True] * 9
    assert match("a[]]b") == [False, False, False, False, True, False, False, False, False]
    assert match("x[^]y") == [False] * 7 + [True, False]
    assert match("web.1") == [False, True] + [False] * 7
    assert match("") == [False, False, False, True, False, False, False, False, False]


def test_template(spark):
    got = one(spark, text.fill_template(
        F.lit("h/purl?d=dstr&s=dstart&l=dlimit"), F.lit("2019-01-02"), F.lit(1000), F.lit(50), F.lit("acc/list")))
    assert got == "h/acc/list?d=2019-01-02&s=1000&l=50"


def test_secrets(spark):
    values = ['{"auth": "abc", "password": "p", "user": "u"}', '{"auth":"abc"}', '{"auth": null}']
    assert each(spark, values, "string", lambda c: text.hide_secrets(F.col(c))) == [
        '{"auth": "***", "password": "***", "user": "u"}', '{"auth":"***"}', '{"auth": null}',
    ]


def test_uuid(spark):
    good = "0123abcd-0123-4567-89ab-0123456789ab"
    packed = [f"uuid={good},x=1", f"x=1,uuid={good}", "x=1", None, "uuid=", "uuid=a,uuid=b"]
    assert each(spark, packed, "string", lambda c: text.packed_uuid(F.col(c))) == [good, good, None, None, None, "ab"]
    assert each(spark, [good, good.upper(), good[:-1], None, good + "0"], "string", lambda c: text.is_uuid(F.col(c))) == [
        True, False, False, False, False,
    ]


def test_split_at_mark(spark):
    values = ["混合结构5层", "砖木", "框架结构"]
    assert each(spark, values, "string", lambda c: text.head_through(F.col(c), "构")) == ["混合结构", "", "框架结构"]
    assert each(spark, values, "string", lambda c: text.tail_after(F.col(c), "构")) == ["5层", "砖木", ""]


def test_option_list(spark):
    values = ["砂浆 清水墙", "（ 石材） ） 漆", "", "  "]
    assert each(spark, values, "string", lambda c: text.option_list(F.col(c))) == [
        "[('砂浆','砂浆'),('清水墙','清水墙')]", "[('石材','石材'),('漆','漆')]", "[]", "[]",
    ]


def test_base64_and_md5(spark):
    blob = bytes(range(256))
    got = one(spark, text.flat_base64(F.col("x")), "x binary", (blob,))
    assert got == base64.b64encode(blob).decode()
    assert one(spark, F.md5(F.lit("pw"))) == hashlib.md5(b"pw").hexdigest()


def test_severity(spark):
    assert each(spark, ["0", "5", "6", "-1", "x", None], "string", lambda c: rpc.severity(F.col(c))) == [
        "not_classified", "disaster", "unknown", "unknown", "unknown", "unknown",
    ]


def test_answers(spark):
    values = ['{"result": 1}', '{"result": null}', '{"error": {"code": -32602, "message": "No", "data": "d"}}',
              '{"error": "text", "result": 2}', '{"id": 1}', "", '{"result"', '{"error": {}}']
    assert each(spark, values, "string", lambda c: rpc.outcome(F.col(c))) == [
        "ok", "ok", "error", "ok", "missing", "empty", "broken", "error",
    ]
    got = each(spark, values, "string", lambda c: rpc.error_text(F.col(c)))
    assert got == [None, None, "No d [-32602]", None, None, None, None, " None [-1]"]
