from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from tests.helpers import one, rows
from tidewatch.functions.rpc import request_json
from tidewatch.operators import metadata as md
from tidewatch.operators.rpclog import read_answers, recent_requests
from tidewatch.sources.landed import SCHEMAS


def test_views(spark):
    data = [("m", "x_b", 2), ("m", "x_a", 1), ("m", "name", 3), ("none", "id", 1)]
    out = {r["model"]: r for r in md.model_views(spark.createDataFrame(data, SCHEMAS["model_fields"])).collect()}
    xml = '  <field name="x_a"/>\n  <field name="x_b"/>\n'
    assert out["m"]["list_xml"] == f'<tree string="uv_m_list">\n{xml}</tree>'
    assert out["m"]["form_xml"] == f'<?xml version="1.0"?>\n<form string="uv_m_form">\n<sheet>\n{xml}</sheet></form>'
    assert out["none"]["list_xml"] == '<tree string="uv_none_list">\n</tree>' and out["none"]["list_name"] == "uv_none_list"


def test_defaults_and_copy(spark):
    df = spark.createDataFrame([(53, 1, None, "z")], "id int, x_wykg_a int, x_wykg_b string, x_other string")
    assert rows(md.defaults_of(df, ["id"], "x_wykg_", "x_pg_item")) == [(53, "x_wykg_a", "1", "x_pg_item"), (53, "x_wykg_b", None, "x_pg_item")]
    catalog = spark.createDataFrame([("waf_a", "t", "u"), ("wafa", "t", "u"), ("b_waf_", "t", "u")], SCHEMAS["catalog"])
    assert rows(md.copy_catalog(catalog), "name") == [("waf_a",)]
    assert rows(md.copy_catalog(catalog, catalog.limit(0)), "name") == [("waf_a",)]


def test_request_envelope(spark):
    col = request_json(F.lit("host.get"), F.struct(F.lit("n").alias("name")), F.lit(None).cast("string"), F.lit(3))
    assert json.loads(one(spark, col)) == {"jsonrpc": "2.0", "method": "host.get", "params": {"name": "n"}, "auth": None, "id": 3}


def test_log(spark):
    at = dt.datetime(2024, 1, 1)
    data = [("a", at + dt.timedelta(minutes=i), '{"password": "p%d"}' % i, '{"result": {"n": %d}}' % i, "1") for i in range(12)]
    log = spark.createDataFrame(data + [("b", at, "{}", '{"error": {"code": 1, "message": "m", "data": "d"}}', "9")], SCHEMAS["rpc_log"])
    recent = recent_requests(log, "server", "ts", "request")
    assert rows(recent.groupBy("server").count()) == [("a", 10), ("b", 1)]
    assert recent.filter("server = 'a' and age = 1").first()["ts"] == at + dt.timedelta(minutes=11)
    assert "WindowGroupLimit" in recent._jdf.queryExecution().executedPlan().toString()
    out = read_answers(log)
    assert rows(out.filter("server = 'b'"), "outcome", "result", "error") == [("error", None, "m d [1]")]
    assert rows(out.filter("server = 'a'").select("request").distinct()) == [('{"password": "***"}',)]
    assert out.filter("result = '{\"n\":3}'").count() == 1
