"""Rules as a table: the first rule, by position, one of whose keywords a text contains.

All keywords of all rules make one Aho-Corasick automaton, which finds them in one pass over a text, however many there are.  It is built
once and broadcast if the keywords take MAX_BYTES at most; more keywords meet the texts' substrings of their lengths in a shuffled join.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.sources.shared import cut

#: UTF-8 bytes of distinct keywords that are broadcast as an automaton, which takes about 50 times as much.
MAX_BYTES = 4 << 20
_NONE = np.iinfo(np.int64).max


def _lowered(rules: DataFrame) -> DataFrame:
    """(word, position): each distinct keyword in lower case with its first rule."""
    own = rules.filter("keyword is not null and position is not null")
    return own.groupBy(F.lower("keyword").alias("word")).agg(F.min(F.col("position").cast("long")).alias("position"))


def automaton(words: list[tuple[str, int]]) -> tuple[ahocorasick.Automaton | None, int]:
    """The automaton of (keyword, position), and the position of the empty keyword, which every text contains."""
    out, empty = ahocorasick.Automaton(), _NONE
    for word, position in words:
        if word:
            out.add_word(word, position)
        else:
            empty = min(empty, position)
    if not len(out):
        return None, empty
    out.make_automaton()
    return out, empty


def _fresh(df: DataFrame, name: str) -> str:
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _by_automaton(rows: DataFrame, words: DataFrame, text_col: str, name: str) -> DataFrame:
    found = automaton([(r["word"], r["position"]) for r in words.collect()])  # at most MAX_BYTES of keywords
    shared = rows.sparkSession.sparkContext.broadcast(found)
    fields = rows.schema.fields
    plain = [f"c{i}" for i in range(len(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, empty = shared.value
        for b in batches:
            first = [None if t is None else min((p for _, p in machine.iter(t)), default=_NONE) if machine else _NONE for t in b.column(len(fields)).to_pylist()]
            position = [None if p is None or min(p, empty) == _NONE else min(p, empty) for p in first]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(position, pa.int64())], names=[*plain, "position"])

    schema = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(plain, fields)), T.StructField("position", T.LongType())])
    return rows.select(*map(_col, rows.columns), F.lower(_col(text_col))).toDF(*plain, "t").mapInArrow(run, schema).toDF(*rows.columns, name)


def _substrings(n: int) -> Column:
    """All substrings of ``n`` characters of the column t."""
    return F.transform(F.sequence(F.lit(1), F.length("t") - (n - 1)), lambda i: F.substring("t", i, F.lit(n)))


def _by_join(rows: DataFrame, words: DataFrame, text_col: str, name: str) -> DataFrame:
    """Texts' distinct substrings of the keywords' lengths, of which there are few, joined to the keywords."""
    row, own = _fresh(rows, "_row"), _fresh(rows, "_found")
    keyed = cut(rows.withColumn(row, F.monotonically_increasing_id()), "texts")
    words = cut(words, "keywords")
    lengths = sorted(r[0] for r in words.select(F.length("word")).distinct().collect())
    low = keyed.select(F.col(row).alias("row"), F.lower(_col(text_col)).alias("t")).filter("t is not null")
    empty = low.select("row", F.lit("").alias("word"))
    parts = [empty] if 0 in lengths else []
    for n in (x for x in lengths if x):
        parts.append(low.filter(F.length("t") >= n).select("row", F.explode(_substrings(n)).alias("word")))
    if not parts:
        return rows.withColumn(name, F.lit(None).cast("long"))
    all_parts = parts[0]
    for p in parts[1:]:
        all_parts = all_parts.union(p)
    # one row for each text and keyword at most reaches the aggregation; a keyword that very many texts have is split by AQE's skew join
    first = all_parts.join(words.hint("merge"), "word").groupBy("row").agg(F.min("position").alias(name if name != row else own))
    return keyed.join(first.withColumnRenamed("row", row), row, "left").select(*map(_col, rows.columns), _col(name))


def first_rule(rows: DataFrame, rules: DataFrame, text_col: str, name: str = "position", most_bytes: int = MAX_BYTES) -> DataFrame:
    """``rows`` with ``name``, the least position of a rule one of whose keywords the text contains; null if none does.

    ``rules`` has (position, keyword), a row for each keyword.  Case doesn't matter.  A null text has no rule; an empty keyword is in every other
    text; null keywords are in none.  Columns of ``rows`` stay, whatever their names; ``name`` must not be among them.
    """
    words = _lowered(rules)
    size = words.agg(F.sum(F.octet_length("word"))).first()[0] or 0
    return (_by_automaton if size <= most_bytes else _by_join)(rows, words, text_col, name)


def classify(rows: DataFrame, rules: DataFrame, text_col: str, default: str, most_bytes: int = MAX_BYTES) -> DataFrame:
    """``rows`` with the ``category`` of the first rule of ``rules`` (position, category, keyword) that holds, or the default."""
    at = _fresh(rows, "_at")
    found = first_rule(rows, rules, text_col, at, most_bytes)
    labels = rules.groupBy(F.col("position").cast("long").alias(at)).agg(F.min("category").alias("category"))
    return found.join(labels, at, "left").select(*map(_col, rows.columns), F.coalesce("category", F.lit(default)).alias("category"))
