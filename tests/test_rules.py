"""Rules and foldings against values stated here, apart from the tables of the code and its SQL."""

import pytest
from pyspark.sql import functions as F

from inkmill.functions import han, rules

NAMES = {
    "经典slogan合集.pdf": "文案珍藏", "某某VI手册.pdf": "品牌手册", "BrandBook 2020.pdf": "品牌手册", "抖音直播运营.pptx": "平台运营", "KOL投放.pdf": "平台运营", "白皮书.pdf": "行业报告",
    "趋势日历.pdf": "行业报告", "Campaign brief.docx": "营销策划", "作品集.pdf": "营销策划", "readme.txt": "其他", "文案与报告.pdf": "文案珍藏", "小红书报告.pdf": "平台运营", "": "其他",
}
SUBS = {
    "作品集.pdf": "作品集", "文案培训教程.pdf": "培训教程", "the copy book.pdf": "培训教程", "春节CNY方案.pdf": "节日营销", "双11活动.pdf": "节日营销", "音乐节快闪.pdf": "活动策划", "JWT比稿.pdf": "4A提案",
    "4A提案.pdf": "4A提案", "整合方案.pdf": "品牌综合方案", "案例集培训.pdf": "作品集",
}


def test_categories_and_subcategories(spark):
    rows = spark.createDataFrame([(n,) for n in {**NAMES, **SUBS}], "name string").select("name", rules.classify(F.col("name")).alias("c"), rules.subcategory(F.col("name"), F.lit("营销策划")).alias("s"), rules.subcategory(F.col("name"), F.lit("其他")).alias("none")).collect()
    got = {r.name: r for r in rows}
    assert {n: got[n].c for n in NAMES} == NAMES and {n: got[n].s for n in SUBS} == SUBS and all(r.none is None for r in rows)


def test_other_rules_and_none(spark):
    own = {"first": ["a.c", "(x"], "second": ["b"], "empty": []}
    rows = spark.createDataFrame([("A.C",), ("abc",), ("x(x",), ("zzz",), (None,)], "n string").select(rules.classify(F.col("n"), own, "rest").alias("c")).collect()
    assert [r.c for r in rows] == ["first", "second", "first", "rest", "rest"]


@pytest.mark.parametrize(("broken", "whole"), [("⽂⽔⽕", "文水火"), ("⺟⻳⺠", "母龟⺠"), ("文，A①", "文，A①")])
def test_foldings(spark, broken, whole):
    assert spark.range(1).select(han.fold_radicals(F.lit(broken)).alias("x")).first().x == whole


KEYWORDS = [
    ("品牌策略 " * 5 + "市场 " * 4, ["品牌", "策略", "市场"]),
    ("品牌 " * 3, []),
    ("的了" * 9 + "如何 " * 9, []),
    ("甲乙 " * 4 + "丙丁 " * 9, ["丙丁", "甲乙"]),
    ("甲乙甲" * 6, ["甲乙"]),
    (None, []),
    ("latin only", []),
]


def test_keywords(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(KEYWORDS)], "i int, t string").select("i", han.keywords(F.col("t")).alias("k")).orderBy("i").collect()
    assert [r.k for r in rows] == [k for _, k in KEYWORDS]
