from __future__ import annotations

import random

import pytest

from tests.helpers import rows
from tidewatch.operators import firewall
from tidewatch.operators.firewall import POLICY_COLUMNS, policy_table
from tidewatch.plans import landing
from tidewatch.plans.network import policy_lines
from tidewatch.plans.registry import Tables
from tidewatch.sources.landed import read_lines
from tidewatch.sources.sinks import write_policy_sheet

SCHEMA = "file string, line_no bigint, line string"


def numbered(spark, **files):
    data = [(f, i, line) for f, lines in files.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def by_blocks(lines):
    """Expected rows, by cutting the file at its closing lines and looking at each block on its own."""
    split = [line.strip(" \t\r\n").split(" ") for line in lines]
    out, begin = [], 0
    for i, f in enumerate(split):
        if f[0] != "rule" or len(f) == 3:
            continue
        block, before = split[begin:i], split[: i + 1]
        begin = i + 1

        def last(rows_, word, at, test=lambda f: True):
            return next((r[at] for r in reversed(rows_) if r[0] == word and test(r)), "")

        three = lambda f: len(f) == 3
        lists = [[r[1] for r in block if r[0] == w] for w in ("source-ip", "destination-ip", "service")]
        head = (
            last(before, "interzone", 2), last(before, "interzone", 4), last(block, "rule", 1, three), last(block, "comment", 1),
            last(block, "comment", 3, lambda f: len(f) > 3),
        )
        out += [(*head, s, d, v, f[1], last(before, "rule", 2, three)) for s in lists[0] for d in lists[1] for v in lists[2]]
    return out


SMALL = [
    "firewall aspf enable", "interzone source trust destination dmz", "  comment web user li ", "source-ip 1.1.1.1", "source-ip 1.1.1.2",
    "destination-ip 2.2.2.2", "service http", "service  ssh", "rule 10 permit", "rule enable",
    "comment none", "source-ip 3.3.3.3", "destination-ip 4.4.4.4", "rule 11 deny", "rule disable",
    "interzone source a destination b", "source-ip 5.5.5.5", "destination-ip 6.6.6.6", "service any", "rule enable",
    "source-ip 7.7.7.7", "destination-ip 8.8.8.8", "service any",
]


@pytest.mark.parametrize("size", [1, 4, 8192])
def test_small_file(spark, size):
    got = rows(policy_table(numbered(spark, f=SMALL), size), *POLICY_COLUMNS)
    assert got == sorted([
        ("trust", "dmz", "10", "web", "li", "1.1.1.1", "2.2.2.2", "http", "enable", "permit"),
        ("trust", "dmz", "10", "web", "li", "1.1.1.2", "2.2.2.2", "http", "enable", "permit"),
        ("trust", "dmz", "10", "web", "li", "1.1.1.1", "2.2.2.2", "", "enable", "permit"),
        ("trust", "dmz", "10", "web", "li", "1.1.1.2", "2.2.2.2", "", "enable", "permit"),
        ("a", "b", "", "", "", "5.5.5.5", "6.6.6.6", "any", "enable", "deny"),
    ])


def make_lines(seed, n):
    rnd = random.Random(seed)
    kinds = [
        lambda: f"interzone source z{rnd.randrange(9)} destination y{rnd.randrange(9)}", lambda: f"comment c{rnd.randrange(99)}",
        lambda: f"comment c{rnd.randrange(99)} user u{rnd.randrange(9)}", lambda: f"source-ip s{rnd.randrange(99)}",
        lambda: f"destination-ip d{rnd.randrange(99)}", lambda: f"service v{rnd.randrange(99)}",
        lambda: f"rule {rnd.randrange(99)} {rnd.choice(['permit', 'deny'])}", lambda: f"rule {rnd.choice(['enable', 'disable'])}",
        lambda: "", lambda: "other words",
    ]
    return [k() for k in rnd.choices(kinds, [1, 1, 1, 6, 6, 6, 2, 2, 1, 1], k=n)]


@pytest.mark.parametrize("size", [2, 7, 64, 10_000])
def test_random_files_at_any_chunk_size(spark, size):
    files = {"a": make_lines(1, 400), "b": make_lines(2, 90), "c": ["source-ip x"] * 5}
    got = rows(policy_table(numbered(spark, **files), size), "file", *POLICY_COLUMNS)
    want = [(f, *r) for f, lines in files.items() for r in by_blocks(lines)]
    assert sorted(got) == sorted(want) and len(want) > 100


def test_from_files(spark, tmp_path):
    (tmp_path / "fw.txt").write_text("\n".join(SMALL))
    assert policy_table(read_lines(spark, str(tmp_path))).count() == 5


def test_files_written_in_parts(spark, tmp_path, monkeypatch):
    """A file is written by several tasks, in order, and its parts are numbered as one file."""
    at = {"orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double", "lineitem": "l_orderkey long, l_suppkey long, l_partkey long, l_discount double"}
    rnd = random.Random(9)
    made = {
        "orders": [(i, rnd.randrange(9), rnd.choice("FOP"), float(rnd.randrange(500_000))) for i in range(400)],
        "lineitem": [(rnd.randrange(400), rnd.randrange(9), rnd.randrange(9), rnd.choice([0.0, 0.07])) for _ in range(900)],
    }
    for name, schema in at.items():
        spark.createDataFrame(made[name], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    kept = []
    monkeypatch.setattr(landing, "work_path", lambda *_: kept.append(str(tmp_path / "written")) or kept[-1])
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = rows(landing.policy_files(Tables(spark, str(tmp_path))), "file", *POLICY_COLUMNS)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got and sorted(got) == sorted(rows(policy_table(policy_lines(Tables(spark, str(tmp_path)))), "file", *POLICY_COLUMNS))
    parts = [p.parent.name for p in (tmp_path / "written").rglob("part-*.txt")]
    assert set(parts) == {f"file=fw{i}" for i in range(5)} and len(parts) > 5


def test_lines_are_shuffled_once_as_text(spark, monkeypatch):
    """What is shuffled and sorted by chunk is the text, in tasks cut by lines, and what is grouped holds no states."""
    monkeypatch.setattr(firewall, "TASK_LINES", 20)
    lines = numbered(spark, a=make_lines(4, 900))
    plan = policy_table(lines, 64)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(file#" in plan and ", 45)" in plan
    sorts = [x.split("Sort [", 1)[1] for x in plan.splitlines() if "Sort [" in x and "_chunk" in x and "line_no" in x]
    assert len(sorts) == 1
    got = rows(policy_table(lines, 64), "file", *POLICY_COLUMNS)
    assert sorted(got) == sorted(("a", *r) for r in by_blocks(make_lines(4, 900)))


def test_packed_sheet_has_the_same_rows(spark, tmp_path):
    table = policy_table(numbered(spark, f=SMALL))
    write_policy_sheet(table, str(tmp_path / "plain"))
    write_policy_sheet(table, str(tmp_path / "packed"), "gzip")
    plain, packed = (spark.read.option("header", True).csv(str(tmp_path / n)) for n in ("plain", "packed"))
    assert list((tmp_path / "packed").glob("*.csv.gz")) and rows(plain, *plain.columns) == rows(packed, *packed.columns)


def test_first_pass_sorts_no_lines_and_leaves_few(spark, monkeypatch):
    """What is known of chunks comes from numbers added up, and only lines at the edges of chunks or of states are read for more."""
    lines = numbered(spark, a=make_lines(5, 3000), b=["service x"] * 300)
    want = sorted(("a", *r) for r in by_blocks(make_lines(5, 3000)))
    for bound in (firewall.BROADCAST_CHUNKS, 0):
        monkeypatch.setattr(firewall, "BROADCAST_CHUNKS", bound)
        kept, write = [], firewall.__dict__["checkpointed"]
        with monkeypatch.context() as m:
            m.setattr(firewall, "checkpointed", lambda df: kept.append((df._jdf.queryExecution().executedPlan().toString(), write(df))) or kept[-1][1])
            got = rows(policy_table(lines, 512), "file", *POLICY_COLUMNS)
        (marks, _), (edges, few) = kept[:2]
        assert "HashAggregate" in marks and "Sort" not in marks
        assert ("BroadcastHashJoin" in edges) == (bound > 0) and few.where("file = 'a'").count() < 500 and few.where("file = 'b'").count() == 300
        assert got == want


def test_sheet_reads_empty_fields_as_null(spark, tmp_path, monkeypatch):
    """The query's sheet, read as a stream, has the rows of the table, with quotes and commas, and null for what is empty."""
    lines = [*SMALL, 'comment a,"b" user \\c"', "source-ip x", "destination-ip y", "service z,", "rule enable"]
    table = policy_table(numbered(spark, f=lines))
    monkeypatch.setattr(landing, "policy_lines", lambda _: numbered(spark, f=lines))
    monkeypatch.setattr(landing, "work_path", lambda *_: str(tmp_path / "sheet"))
    got = landing.policy_sheet(Tables(spark, str(tmp_path)))
    want = [tuple(v or None for v in r) for r in rows(table, *POLICY_COLUMNS)]
    assert sorted(map(repr, rows(got, *got.columns))) == sorted(map(repr, want)) and len(want) == 13
