"""Quality classes and ordered keyword rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.binding import bound

OTHER = "其他"
PLANNED = "营销策划"
GENERAL = "品牌综合方案"

#: Categories by file name, the first that has a keyword (fixed values; pass others to ``classify``).
CATEGORIES = {
    "文案珍藏": ["文案", "金句", "slogan", "珍藏", "经典", "合集", "apple", "iphone", "无印良品", "掌生谷粒", "东东枪", "基本修养", "数英", "奥美", "文案的"],
    "品牌手册": ["品牌手册", "vi手册", "视觉规范", "品牌规范", "brandbook", "品牌全案", "品牌手冊"],
    "平台运营": ["小红书", "抖音", "直播", "视频号", "b站", "快手", "私域", "种草", "运营", "达人", "kol", "投放", "公众号", "社媒"],
    "行业报告": ["报告", "洞察", "趋势", "白皮书", "蓝皮书", "研究", "数据", "榜", "分析", "日历"],
    "营销策划": ["策划", "全案", "campaign", "方案", "营销", "推广", "活动", "传播", "策略", "brief", "提案", "创意", "培训", "作品集"],
}
#: Sub-categories of PLANNED (fixed values).
SUBCATEGORIES = {
    "作品集": ["作品集", "案例集"],
    "培训教程": ["培训", "教程", "方法论", "技巧", "怎么写", "如何写", "入门", "创意培训", "修辞法", "炼成", "论语", "之道", "可延展", "创意课", "思维模型", "创造概念", "copy book", "french", "法兰奇", "广告语法", "顶尖文案", "顶尖广告"],
    "节日营销": ["cny", "春节", "新年", "妇女节", "女神节", "三八", "618", "双11", "双十一", "中秋", "七夕", "圣诞", "情人节", "母亲节", "父亲节", "国庆", "元宵", "520", "年货", "新春", "开学", "万圣"],
    "活动策划": ["音乐节", "快闪", "发布会", "市集", "launch", "活动", "盛典", "嘉年华", "巡展", "周年", "画展", "酒水节", "露营", "奥运"],
    "4A提案": ["4a", "提案", "比稿", "jwt", "ddb", "奥美", "havas", "恒美", "智威汤逊", "tbwa", "karma", "grey", "精信", "传播方案", "传播策略", "campaign", "创意策略", "脚本", "tvc"],
}
#: Averages per unit for 'text' and for 'sparse' (fixed values).
LIMITS = {"pdf": (80, 15), "pptx": (60, 12)}
WORD_CHARS = 200
LABELS = {"text": "文字型", "sparse": "稀疏", "image": "图片型"}
OCR_LABEL = "文字型(OCR)"

USABLE = ("text", "sparse")
RETRYABLE = ("failed", "unsupported", "needs_conversion")


def first_rule(name: Column, rules: dict[str, list[str]], default: str) -> Column:
    """Label of the first rule of which a keyword is in the lower-case name; one search for each rule."""

    def labelled(low: Column) -> Column:
        out = F.lit(default)
        for label, words in reversed(rules.items()):
            if words:
                out = F.when(low.rlike("|".join(rf"\Q{w}\E" for w in words)), label).otherwise(out)
        return out

    return bound(F.lower(name), labelled)


def classify(name: Column, rules: dict[str, list[str]] | None = None, default: str = OTHER) -> Column:
    return first_rule(name, CATEGORIES if rules is None else rules, default)


def subcategory(name: Column, category: Column, rules: dict[str, list[str]] | None = None, of: str = PLANNED, default: str = GENERAL) -> Column:
    """Null outside of the category that has sub-categories."""
    sub = first_rule(name, SUBCATEGORIES if rules is None else rules, default)
    return bound(category, lambda c: F.when(c == of, sub))


def judge(chars: Column, units: Column, kind: str = "pdf") -> Column:
    """text, sparse or image by characters per unit; no units count as none."""
    high, low = LIMITS["pptx" if kind == "pptx" else "pdf"]
    average = F.when(units > 0, chars / units).otherwise(0.0)
    return F.when(average >= high, "text").when(average >= low, "sparse").otherwise("image")


def judge_word(chars: Column) -> Column:
    return F.when(chars >= WORD_CHARS, "text").otherwise("sparse")


def judge_by_ext(ext: Column, chars: Column, units: Column) -> Column:
    """Quality of an extracted file by its kind; null for what has no extractor."""
    return (
        F.when(ext == ".pdf", judge(chars, units, "pdf"))
        .when(ext == ".pptx", judge(chars, units, "pptx"))
        .when(ext.isin(".doc", ".docx"), judge_word(chars))
        .when(ext == ".epub", "text")
    )


def quality_label(quality: Column, ocr: Column, ocr_label: str = OCR_LABEL) -> Column:
    out = F.when(F.coalesce(ocr, F.lit(False)), ocr_label)
    for q, label in LABELS.items():
        out = out.when(quality == q, label)
    return out.otherwise(quality)


def location(category: Column, sub: Column) -> Column:
    return F.concat_ws("/", category, sub)
