from __future__ import annotations

import base64
import random
import re
import time

from pyspark.sql import functions as F

from tests.helpers import rows
from tidewatch.operators import documents as doc
from tidewatch.session import checkpointed
from tidewatch.sources.landed import SCHEMAS

LETTER = [
    "估价报告", "  ", "　\t", "张三（先生/女士）:", "现受委托,对位于南江路70号的住宅价值作初步估价。", "其建筑面积88.50平方米，",
    "在价值时点2019年3月7日的抵押评估价值为人民币若干，", "单价：12,345元/平方米。", "",
]


def paras(spark):
    data = [(1, i, t) for i, t in enumerate(LETTER)] + [(2, 0, "其他文件"), (3, 0, "（先生/女士）:"), (4, 0, " ")]
    return spark.createDataFrame(data, SCHEMAS["doc_paras"])


def test_text_drops_blank_paragraphs(spark):
    got = dict(map(tuple, doc.document_text(paras(spark)).collect()))
    assert got == {1: "\n".join(p for p in LETTER if p.strip()) + "\n", 2: "其他文件\n", 3: "（先生/女士）:\n"}


def test_fields_and_rejects(spark):
    docs = doc.document_text(paras(spark))
    got = doc.appraisal_fields(docs)
    assert got.columns == ["doc_id", "x_name", "x_zzjl_qsr", "x_md", "x_jzmj", "x_cp_date", "x_cp_dj"]
    assert rows(got) == [(1, "南江路70号", "张三", "住宅", 88.5, "2019-03-07", "12345")]
    assert rows(doc.appraisal_rejects(docs), "doc_id") == [(2,), (3,)]


def test_a_long_text_is_searched_whole(spark):
    long = "填充文字。\n" * 20000 + "\n".join(p for p in LETTER if p.strip()) + "\n" + "附件\n" * 5000
    docs = spark.createDataFrame([(1, long), (2, "填充\n" * 50000 + "（先生/女士）:")], "doc_id bigint, text string")
    assert rows(doc.appraisal_fields(docs), "doc_id", "x_cp_dj") == [(1, "12345")]
    assert rows(doc.appraisal_rejects(docs), "doc_id") == [(2,)]


PATTERN = re.compile(
    r"[\S|\s|\n]+\n(\w+)（先生/女士）:[\S|\s|\n|.]+对位于(\w+)的(\w+)价值作初步估价[\S|\s|\n|.]+建筑面积(\d+\.\d+)平方米"
    r"[\S|\s|\n|.]+在价值时点(\d+年\d+月\d+日)的抵押评估价值为[\S|\s|\n|.]+单价：([\d|,]+)元"
)


def test_same_groups_as_the_pattern_on_random_letters(spark):
    draw = random.Random(1)
    whole = ["\n张三（先生/女士）:", "对位于南江路的住宅价值作初步估价", "建筑面积88.50平方米", "在价值时点2019年3月7日的抵押评估价值为", "单价：1,2元"]
    parts = [*whole, "\n", "李（先生/女士）:", "对位于", "南江路", "的", "价值作初步估价", "。", "x", "建筑面积", "在价值时点", "单价：", "7元", " "]
    texts = []
    for n in range(1500):
        picked = [draw.choice(parts) for _ in range(draw.randint(0, 4))]
        for part in whole:
            picked += [part] * (draw.random() < 0.95) + [draw.choice(parts) for _ in range(draw.randint(0, 3))]
        texts.append((n, "".join(picked)))
    docs = spark.createDataFrame([*texts, (-1, None), (-2, "")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", doc._letter_parts(F.col("text")).alias("p")).collect()}
    want = {n: list(m.groups()) if (m := PATTERN.match(t)) else None for n, t in texts} | {-1: None, -2: None}
    assert got == want and sum(w is not None for w in want.values()) > 300


def test_letters_by_the_pattern_and_from_the_end_are_the_same(spark):
    """Letters with each mark once, whole or with a part missing or moved, and runs whose marks may be taken in several ways."""
    draw = random.Random(2)
    parts = ["估价", "\n张\n李三（先生/女士）:", "x", "对位于南的江路的住的价值作初步估价值作初步估价", "。", "建筑面积１2.5平方米", "y\n", "在价值时点2019年3月7日的抵押评估价值为", "，", "单价：1|,2元", "元"]
    texts = ["".join(parts), "".join(parts) + "\n\0单价：", "".join(parts) + "单价：无", "\0" + "".join(parts), "".join(parts).replace("的住的", "的的")]
    for _ in range(400):
        kept = [p for p in parts if draw.random() < 0.95]
        if draw.random() < 0.3:
            i, j = draw.randrange(len(kept)), draw.randrange(len(kept))
            kept[i], kept[j] = kept[j], kept[i]
        texts.append("".join(kept))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    text = F.col("text")
    got = docs.select(doc._letter_parts(text).alias("p"), doc._parts_from_end(text).alias("q"), "text").collect()
    for r in got:
        want = list(m.groups()) if (m := PATTERN.match(r["text"])) else None
        assert r["p"] == r["q"] == want
    assert sum(r["p"] is not None for r in got) > 50
    plan = docs.select(doc._letter_parts(text).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_replace") < plan.index("array_max")  # the pattern first, the search from the end for the others


def test_near_matches_of_a_megabyte_take_no_second_more(spark):
    head, almost = "填充\n张三（先生/女士）:x。", "对位于A的B价值作初步估价建筑面积1.5平方米在价值时点2019年3月7日的抵押评估价值为单价："
    for text in (head + almost * 20_000, head + "对位于的" * 250_000 + "。建筑面积1.5平方米"):
        docs = checkpointed(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
        assert doc.appraisal_rejects(docs).count() == 1
        began = time.perf_counter()
        assert doc.appraisal_rejects(docs).count() == 1
        assert time.perf_counter() - began < 3


def test_digits_of_any_script(spark):
    text = "\n".join(p for p in LETTER if p.strip())
    docs = [(1, text.replace("88.50", "１２.５")), (2, text.replace("2019年3月7日", "２０１９年３月７日")), (3, text.replace("88.50", "9" * 400 + ".5"))]
    got = doc.appraisal_fields(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert rows(got, "doc_id", "x_jzmj", "x_cp_date")[:2] == [(1, 12.5, "2019-03-07"), (2, 88.5, "2019-03-07")]


def test_cells(spark):
    data = [(1, 0, 1, 2, "混合结构5层"), (1, 0, 8, 2, "说明"), (1, 0, 9, 9, "无"), (1, 1, 2, 2, "other table"), (2, 0, 1, 2, "砖木"), (3, 0, 1, 2, "框架结构")]
    out = doc.table_fields(spark.createDataFrame(data, SCHEMAS["doc_cells"]))
    assert len(out.columns) == 16
    assert rows(out, "doc_id", "x_wykg_jg", "x_wykg_zcs", "x_ptss_desc", "x_wykg_hx") == [
        (1, "混合结构", "5层", "说明", None), (2, "", "砖木", None, None), (3, "框架结构", "", None, None),
    ]


def test_images(spark):
    blob = bytes(range(100))
    images = spark.createDataFrame([(1, 0, blob), (1, 8, blob), (1, 10, b"x"), (1, 11, b"y")], SCHEMAS["doc_images"])
    out = doc.image_fields(images)
    assert len(out.columns) == 11 and "" not in out.columns
    assert rows(out, "x_img_loc_s_150_150", "x_img_ytjg", "x_img_yt") == [(base64.b64encode(blob).decode(), "eA==", None)]
    assert rows(doc.image_rejects(images), "pos") == [(11,)]


def test_records(spark):
    cells = spark.createDataFrame([(1, 0, 2, 2, "三房")], SCHEMAS["doc_cells"])
    images = spark.createDataFrame([(1, 1, b"x")], SCHEMAS["doc_images"])
    out = doc.document_records(paras(spark), cells, images)
    assert rows(out, "doc_id", "x_name", "x_wykg_hx", "x_img_wg") == [(1, "南江路70号", "三房", "eA==")]
