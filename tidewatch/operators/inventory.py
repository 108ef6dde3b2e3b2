"""Reconciling a desired host list with the hosts and groups that exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import python_text
from tidewatch.operators.ordered import carry_forward

# The state looked for, the template to link, the agent interface and the description of a new host.
RUNNING = "running"
TEMPLATE_ID = "10186"
AGENT_PORT = "10050"
DESCRIPTION = "CPU:(%s)核 内存：(%s)Mb NC_ID:(%s)"


def running_rows(sheet: DataFrame) -> DataFrame:
    return sheet.filter(F.col("status") == RUNNING)


def shown_name(name: Column, ip: Column, pip: Column) -> Column:
    """`name(ip)(pip)`; a missing part reads `None`."""
    return F.format_string("%s(%s)(%s)", python_text(name), python_text(ip), python_text(pip))


def description(cpu: Column, mem: Column, nc_id: Column) -> Column:
    return F.format_string(DESCRIPTION, python_text(cpu), python_text(mem), python_text(nc_id))


def with_names(desired: DataFrame) -> DataFrame:
    return desired.withColumns(
        {
            "hname": shown_name(F.col("name"), F.col("ip"), F.col("pip")),
            "description": description(F.col("cpu"), F.col("mem"), F.col("nc_id")),
        }
    )


def missing_groups(desired: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups to create, each once."""
    return desired.select("grp").distinct().join(groups.select(F.col("name").alias("grp")), "grp", "left_anti")


def host_object(groupid: Column, template: str = TEMPLATE_ID) -> Column:
    """The nested object of a new host, as JSON."""
    agent = F.struct(
        F.lit(1).alias("type"),
        F.lit(1).alias("main"),
        F.lit(1).alias("useip"),
        F.col("ip").alias("ip"),
        F.lit("").alias("dns"),
        F.lit(AGENT_PORT).alias("port"),
    )
    host = F.struct(
        F.col("host").alias("host"),
        F.col("hname").alias("name"),
        F.col("description").alias("description"),
        F.array(agent).alias("interfaces"),
        F.array(F.struct(groupid.alias("groupid"))).alias("groups"),
        F.array(F.struct(F.lit(template).alias("templateid"))).alias("templates"),
    )
    return F.to_json(host, {"ignoreNullFields": "false"})


def _action(order: int, action: str, test: Column, value: Column) -> Column:
    step = F.struct(F.lit(order).alias("seq"), F.lit(action).alias("action"), value.cast("string").alias("value"))
    return F.when(test, step)


def host_actions(
    desired: DataFrame, hosts: DataFrame, groups: DataFrame, template: str = TEMPLATE_ID
) -> DataFrame:
    """Actions per desired row, in order: `row_idx, seq, action, host, hostid, grp, value`.

    Rows of one host act one after the other: the first meets the existing host, each later one the
    name that the row before it left behind, and a template that is then linked. A missing template list is empty.
    """
    rows = carry_forward(
        with_names(desired), ["host"], "row_idx", previous={"_before": F.col("hname")}
    ).drop("_chunk")
    actual = hosts.select("hostid", "host", F.col("name").alias("_name"), "template_ids")
    known = groups.select("groupid", F.col("name").alias("grp"))
    state = rows.join(actual, "host", "left").join(known, "grp", "left")
    linked = F.coalesce("template_ids", F.array().cast("array<string>"))

    first = F.col("_before").isNull()
    exists = F.col("hostid").isNotNull()
    present = F.coalesce(F.col("_before"), F.col("_name"))
    unlinked = ~F.coalesce(F.array_contains(linked, template), F.lit(False))
    wanted = F.array_join(F.array_append(linked, template), ",")
    steps = F.array_compact(
        F.array(
            _action(1, "create_host", first & ~exists, host_object(F.col("groupid"), template)),
            _action(2, "update_name", (exists | ~first) & (F.col("hname") != present), F.col("hname")),
            _action(3, "add_template", exists & first & unlinked, wanted),
        )
    )
    return state.withColumn("_s", F.explode(steps)).select(
        "row_idx", "_s.seq", "_s.action", "host", "hostid", "grp", "_s.value"
    )


def inventory_actions(
    desired: DataFrame, hosts: DataFrame, groups: DataFrame, template: str = TEMPLATE_ID
) -> DataFrame:
    """Groups to create (sequence 0, no row) together with the host actions."""
    create = missing_groups(desired, groups).select(
        F.lit(None).cast("bigint").alias("row_idx"),
        F.lit(0).alias("seq"),
        F.lit("create_group").alias("action"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("hostid"),
        "grp",
        F.col("grp").alias("value"),
    )
    return create.unionByName(host_actions(desired, hosts, groups, template))
