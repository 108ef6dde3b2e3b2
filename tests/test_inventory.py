from __future__ import annotations

import json

from tests.helpers import rows
from tidewatch.operators import inventory as inv
from tidewatch.sources.landed import SCHEMAS


def data(spark):
    desired = [
        (2, "running", "4", "8192", "h1", "web", "g1", "nc1", "1.1.1.1", "2.2.2.2"),
        (3, "running", "4", "8192", "h1", "web2", "g1", "nc1", "1.1.1.1", "2.2.2.2"),
        (4, "running", "4", "8192", "h1", "web2", "g1", "nc1", "1.1.1.1", "2.2.2.2"),
        (5, "stopped", "1", "1", "h2", "off", "g9", "nc2", "1.1.1.2", None),
        (6, "running", "1", "1", "h3", "new", "g2", None, "1.1.1.3", None),
        (7, "running", "1", "1", "h3", "newer", "g2", None, "1.1.1.3", None),
        (8, "running", "1", "1", "h4", "same", "g0", "nc4", "1.1.1.4", "3.3.3.3"),
    ]
    hosts = [("51", "h1", "web(1.1.1.1)(2.2.2.2)", ["1", "2"]), ("54", "h4", "same(1.1.1.4)(3.3.3.3)", ["10186"])]
    return (
        inv.running_rows(spark.createDataFrame(desired, SCHEMAS["desired_hosts"])),
        spark.createDataFrame(hosts, SCHEMAS["actual_hosts"]),
        spark.createDataFrame([("7", "g0")], SCHEMAS["actual_groups"]),
    )


def test_groups(spark):
    desired, _, groups = data(spark)
    assert rows(inv.missing_groups(desired, groups)) == [("g1",), ("g2",)]


def test_actions_in_order(spark):
    got = rows(inv.inventory_actions(*data(spark)), "row_idx", "seq", "action", "host", "hostid", "value")
    host = next(g for g in got if g[2] == "create_host")
    assert [g for g in got if g[2] != "create_host"] == [
        (None, 0, "create_group", None, None, "g1"), (None, 0, "create_group", None, None, "g2"),
        (2, 3, "add_template", "h1", "51", "1,2,10186"),
        (3, 2, "update_name", "h1", "51", "web2(1.1.1.1)(2.2.2.2)"),
        (7, 2, "update_name", "h3", None, "newer(1.1.1.3)(None)"),
    ]
    assert host[:5] == (6, 1, "create_host", "h3", None)
    assert json.loads(host[5]) == {
        "host": "h3", "name": "new(1.1.1.3)(None)", "description": "CPU:(1)核 内存：(1)Mb NC_ID:(None)",
        "interfaces": [{"type": 1, "main": 1, "useip": 1, "ip": "1.1.1.3", "dns": "", "port": "10050"}],
        "groups": [{"groupid": None}], "templates": [{"templateid": "10186"}],
    }
