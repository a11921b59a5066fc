"""Line dedup by overlapping windows of three consecutive lines.

Lines are what ``\\n`` separates, compared without edge spaces; a carriage return is part of its line.  Every window of
three consecutive lines, but for three blank ones, is hashed to 128 bits; a window seen
before, in the order of (doc_id, row, line number), is a later occurrence, and the
lines that later occurrences cover are removed.  Only hashes and positions are
shuffled for the search; texts move once, to meet the lines to remove.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common

WIDTH = 3
_FIRST = -(1 << 63)


def window_hashes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(_row, pos, h1, h2) of each window; pos is the number of its first line from 0."""
    lines = docs.select("_row", F.split(F.coalesce(F.col("text"), F.lit("")), "\n").alias("_raw"))
    lines = lines.filter(F.size("_raw") >= width).select("_row", F.transform("_raw", lambda line: F.trim(line)).alias("_lines"))

    def hashed(at, *seed):
        return F.xxhash64(*seed, *(F.get("_lines", at + F.lit(i)) for i in range(width)))

    def one(at):
        blank = F.lit(True)
        for i in range(width):
            blank = blank & (F.get("_lines", at + F.lit(i)) == "")
        return F.when(~blank, F.struct(at.alias("pos"), hashed(at).alias("h1"), hashed(at, F.lit("second")).alias("h2")))

    made = lines.select("_row", F.explode(F.transform(F.sequence(F.lit(0), F.size("_lines") - F.lit(width)), one)).alias("w"))
    return made.filter("w is not null").select("_row", "w.pos", "w.h1", "w.h2")


def repeated_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(_row, drop): the sorted numbers of the lines that later occurrences cover."""
    w = common.cut(window_hashes(docs, width), "line-windows")
    first = (
        w.groupBy("h1", "h2")
        .agg(F.min(F.struct("_row", "pos")).alias("f"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("h1", "h2", "n", F.col("f._row").alias("first_row"), F.col("f.pos").alias("first_pos"))
    )
    later = common.join_counted(w, common.cut(first, "first-windows"), ["h1", "h2"], "n").filter("_row <> first_row or pos <> first_pos")
    return later.groupBy("_row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.col("pos") + i))))).alias("drop"))


def dedup_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """All columns of ``docs`` with ``text``, in whatever case its name is, cleaned, and n_lines and n_removed added.

    The first occurrence of every window stays.  A null text stays null and has 0
    lines; an empty text has one.  Null doc_ids come before all others; their rows, and rows that repeat a
    doc_id, are rows of their own, in the order they are read in, and lose only what they repeat
    themselves.  A text that loses all its lines becomes empty; no row goes.
    Columns named n_lines or n_removed are replaced; all others stay, whatever their names.  An empty table gives none.
    """
    own = docs.select(*(common.col(c) for c in docs.columns if c.lower() not in ("n_lines", "n_removed")))
    held, row = common.numbered(own, F.coalesce(common.as_long(own, "doc_id"), F.lit(_FIRST)), "line-rows")
    cleaned = common.named(own.columns, "text")
    of, drop = common.fresh(held, "_of"), common.fresh(held, "_drop")
    found = common.cut(repeated_lines(held.select(F.col(row).alias("_row"), "text"), width).select(F.col("_row").alias(of), F.col("drop").alias(drop)), "repeated-lines")
    maybe, others = common.split(held, F.col(row), found.select(of))
    joined = maybe.join(found, F.col(row) == F.col(of), "left").drop(of)
    joined = joined.union(others.withColumn(drop, F.lit(None).cast("array<int>")))
    split_text = common.fresh(joined, "_lines")
    joined = joined.withColumn(split_text, F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(split_text) - 1), drop)
    keep = F.when(F.size(drop) > 0, F.array_join(F.transform(left, lambda i: F.get(split_text, i)), "\n")).otherwise(F.col("text"))
    return joined.select(
        *(keep.alias(c) if c == cleaned else common.col(c) for c in own.columns),
        F.coalesce(F.greatest(F.size(split_text), F.lit(0)), F.lit(0)).alias("n_lines"),
        F.when(F.col("text").isNull() | F.col(drop).isNull(), 0).otherwise(F.size(drop)).alias("n_removed"),
    )


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.coalesce("text", F.lit("")).alias("text"))


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS raw FROM documents
), w AS (
  SELECT doc_id, pos - 1 AS pos, trim(raw[pos], ' ') AS a, trim(raw[pos + 1], ' ') AS b, trim(raw[pos + 2], ' ') AS c
  FROM (SELECT doc_id, raw, unnest(range(1, len(raw) - 1)) AS pos FROM lines WHERE len(raw) >= 3)
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id NULLS FIRST, pos) AS rn
    FROM w WHERE NOT (a = '' AND b = '' AND c = '')
  ) WHERE rn > 1
), covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, range(0, 3) AS r(k)
), numbered AS (
  SELECT doc_id, unnest(raw) AS line, generate_subscripts(raw, 1) - 1 AS pos FROM lines
), kept AS (
  SELECT n.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
         coalesce(string_agg(n.line, chr(10) ORDER BY n.pos) FILTER (WHERE c.pos IS NULL), '') AS text
  FROM numbered n LEFT JOIN covered c ON c.doc_id IS NOT DISTINCT FROM n.doc_id AND c.pos = n.pos GROUP BY n.doc_id
)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_removed AS INTEGER) AS n_removed, text FROM kept
"""
