"""Weighted keyword search over a library."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import text
from inkmill.operators.library import note
from inkmill.sources import builder, manifests

TITLE_WEIGHT, META_WEIGHT, BODY_MOST = 5, 3, 10


def library_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, title, tags, excerpt, source, body, quality) of a library's Markdown files, as files have them.

    Folders whose names begin with a dot or an underscore are left out, and generated files at the top.  A file without a title
    has its name.  The workers read the files, through the engine's file systems.
    """
    read = spark.read.text(root, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True)
    base = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
    decode = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    full = F.regexp_replace(decode(F.col("_metadata.file_path")), r"\A[a-z0-9]+:(//[^/]*)?(?=/)", "")
    files = read.select(F.substring(full, len(base) + 1, 1 << 30).alias("path"), F.col("value").alias("markdown"))
    files = files.filter(~F.col("path").isin(*builder.GENERATED) & ~F.col("path").rlike(r"(\A|/)[._][^/]*/"))
    parsed = manifests.parse_markdown(files)
    field = lambda k: F.coalesce(F.element_at("fields", k), F.lit(""))
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    return parsed.select("path", F.coalesce(F.element_at("fields", "title"), name).alias("title"), field("tags").alias("tags"), field("excerpt").alias("excerpt"), field("source").alias("source"), "body", field("quality").alias("quality"))


def searchable(library: DataFrame) -> DataFrame:
    """(path, title, tags, excerpt, source, body, quality) of library documents; a note before the body is searched too."""
    body = F.concat_ws("\n", note(), "body")
    return library.select("path", "title", F.array_join("tags", ", ").alias("tags"), "excerpt", F.col("name").alias("source"), body.alias("body"), "quality")


def meta() -> Column:
    """Tags, excerpt and source with the title before them."""
    return F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("title", "tags", "excerpt", "source")))


def in_category(rows: DataFrame, category: str | None) -> DataFrame:
    """Rows whose folder's path begins with the category; a document without a folder has none."""
    folder = F.regexp_extract("path", r"(?s)\A(.*)/[^/]*\z", 1)
    return rows.filter((folder != "") & folder.startswith(category)) if category else rows


def scored(rows: DataFrame, words: list[str]) -> DataFrame:
    """Rows with t, m and b of each keyword's number, those with a hit, with ``score`` and ``why``."""
    score, why = [], []
    for i, w in enumerate(words):
        t, m, b = F.col(f"t{i}"), F.col(f"m{i}"), F.col(f"b{i}")
        score.append(TITLE_WEIGHT * t + META_WEIGHT * F.greatest(m - t, F.lit(0)) + F.least(b, F.lit(BODY_MOST)))
        parts = F.concat_ws(" ", *(F.when(n > 0, F.concat(F.lit(f"{label}×"), n.cast("string"))) for label, n in (("标题", t), ("标签摘要", m - t), ("正文", b))))
        hit = (t > 0) | (m > t) | (b > 0)
        why.append(F.when(hit, F.concat(F.lit(f"{w}("), parts, F.lit(")")) if len(words) > 1 else parts))
    return rows.withColumns({"score": reduce(lambda a, b: a + b, score), "why": F.concat_ws(" ", *why)}).filter("score > 0")


def shown(rows: DataFrame, words: list[str]) -> DataFrame:
    """Scored rows with the context of the first keyword that the body has."""
    context = [F.when(F.col(f"b{i}") > 0, text.context(F.col("body"), w)) for i, w in enumerate(words)]
    return rows.select("path", "score", "why", F.coalesce(*context, F.lit("")).alias("context"), "quality")


def search(corpus: DataFrame, keywords: list[str], category: str | None = None) -> DataFrame:
    """(path, score, why, context, quality) of documents that any keyword hits.

    A hit in the title scores 5, one in tags, excerpt or source 3, one in the body 1
    up to 10; a keyword given twice counts twice.  ``category`` is a prefix of the folder's path, and leaves out
    documents without one.  One narrow pass, whatever the number of keywords; ``grams.find`` has an index instead.
    """
    words = [k.lower() for k in keywords]
    rows = in_category(corpus, category).withColumns({"_title": F.lower("title"), "_meta": F.lower(meta()), "_body": F.lower("body")})
    for i, w in enumerate(words):
        rows = rows.withColumns({f"{c}{i}": F.coalesce(text.occurrences(F.col(f), w), F.lit(0)) for c, f in (("t", "_title"), ("m", "_meta"), ("b", "_body"))})
    return shown(scored(rows, words), words)


def top(hits: DataFrame, k: int = 10) -> DataFrame:
    """The best ``k``; equal scores in order of path."""
    return hits.orderBy(F.desc("score"), "path").limit(k)
