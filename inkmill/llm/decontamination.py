"""Benchmark decontamination: size-partitioned MinHash containment search, exact verification.

Only DataFrame functions are used.  Items are partitioned by size (powers of two).  Containment t of an item of n
shingles means that at most floor((1 - t) n) of them are lacking; in a partition whose largest size is u that is
floor((1 - t) u) at most.  An item's sketch is its bottom-k MinHash, the k least hashes of its shingles, with k one
more than that bound: a document that contains the share t of it has a shingle of the sketch for certain, so the
search has recall 1 in every partition, and k is small where items are short.  Documents are so
much longer than items that a sketch of a document would share almost nothing
with an item's (a Jaccard similarity near 0.001), so all their shingle hashes
are looked up in the sketches.  Candidates are verified on shingle texts.

Documents with equal texts are one candidate (by md5), so copies are verified once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common

WORDS = 5
CONTAINMENT = 0.8
#: Bytes of a table that may be broadcast; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20
#: What a row takes in a hash relation beside its strings.
ROW_BYTES = 64


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), "")


def _shingles(words: str, k: int, make) -> Column:
    """Array of ``make(position)`` for each shingle of the array column; none if it is shorter."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - F.lit(k)), make)


def shingle_hash(words: Column, at: Column, k: int = WORDS) -> Column:
    return F.xxhash64(*(F.get(words, at + F.lit(j)) for j in range(k)))


def shingle_hashes(words: str, k: int = WORDS) -> Column:
    return _shingles(words, k, lambda i: shingle_hash(F.col(words), i, k))


def shingle_texts(words: str, k: int = WORDS) -> Column:
    return _shingles(words, k, lambda i: F.array_join(F.slice(words, i + F.lit(1), k), " "))


def items_of(benchmark: DataFrame, k: int = WORDS) -> DataFrame:
    """(item, words) of the distinct word sequences with at least k words."""
    w = benchmark.select(words_of(F.col("text")).alias("words")).filter(F.size("words") >= k)
    return w.select(F.md5(F.array_join("words", " ").cast("binary")).alias("item"), "words").dropDuplicates(["item"])


def sketches(items: DataFrame, containment: float = CONTAINMENT, k: int = WORDS) -> DataFrame:
    """(h, item): each item's least hashes, as many as its size partition asks for."""
    sized = items.select("item", F.array_sort(F.array_distinct(shingle_hashes("words", k))).alias("all")).withColumn("part", F.floor(F.log2(F.size("all"))))
    upper = sized.groupBy("part").agg(F.max(F.size("all")).alias("upper"))
    length = F.floor((1 - containment) * F.col("upper") + 1e-9).cast("int") + 1
    return sized.join(F.broadcast(upper), "part").select(F.explode(F.slice("all", F.lit(1), length)).alias("h"), "item")  # at most 63 parts


def fits(table: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a table may be broadcast, by the bytes of its rows."""
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in table.schema.fields if f.dataType.simpleString() == "string"]
    return (table.agg(F.sum(sum(strings, F.lit(ROW_BYTES)))).first()[0] or 0) <= most


def _joined(rows: DataFrame, table: DataFrame, key: str, most: int) -> DataFrame:
    """Inner join; beyond ``most`` bytes only rows that may have a partner are shuffled, and skewed partitions are split by the engine."""
    if fits(table, most):
        return rows.join(F.broadcast(table), key)
    return common.split(rows, F.col(key), table.select(key))[0].join(table, key)


def contaminated(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT, k: int = WORDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, item, n_shared, n_shingles) of texts that hold at least that share of an item's shingles."""
    items = common.cut(items_of(benchmark, k), "items")
    sketch = common.cut(sketches(items, containment, k), "sketches")
    texts = docs.select(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"), "text")
    worded = texts.select("key", words_of(F.col("text")).alias("words")).filter(F.size("words") >= k)
    placed = worded.select("key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.lit(k))).alias("i"))  # compiled, unlike a lambda
    probes = placed.select("key", shingle_hash(F.col("words"), F.col("i"), k).alias("h"))
    candidates = common.cut(_joined(probes, sketch, "h", broadcast_bytes).select("key", "item").distinct(), "candidates")

    keys = common.cut(candidates.select("key").distinct(), "candidate-keys")
    held = common.semi(texts, F.col("key"), keys).groupBy("key").agg(F.first("text").alias("text"))
    in_texts = held.select("key", words_of(F.col("text")).alias("words")).select("key", F.explode(F.array_distinct(shingle_texts("words", k))).alias("s"))
    of_items = common.cut(items.select("item", F.array_distinct(shingle_texts("words", k)).alias("all")).select("item", F.size("all").alias("n_shingles"), F.explode("all").alias("s")), "item-shingles")
    shared = _joined(in_texts, of_items, "s", broadcast_bytes).groupBy("key", "item").agg(F.count("*").alias("n_shared"), F.max("n_shingles").alias("n_shingles"))
    return shared.filter(F.col("n_shared") >= containment * F.col("n_shingles") - 1e-9).join(candidates, ["key", "item"], "left_semi")


def find_leaks(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT, k: int = WORDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment): a row for each document and item it contains.

    Words are compared in lower case and without punctuation.  Null texts are empty;
    items of fewer than ``k`` words have no shingle and are never found.  Null and
    repeated ids are allowed: a row of ``docs`` or of ``benchmark`` counts by its
    text, and gives its rows.  Other columns are not read; empty tables give none.
    """
    found = common.cut(contaminated(docs, benchmark, containment, k, broadcast_bytes), "leaks")
    named = benchmark.select("item_id", words_of(F.col("text")).alias("_w")).select("item_id", F.md5(F.array_join("_w", " ").cast("binary")).alias("item"))
    by_item = common.cut(found.join(named, "item"), "named-leaks")
    ids = docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"))
    return _joined(ids, by_item, "key", broadcast_bytes).select("doc_id", "item_id", "n_shared", F.col("n_shingles").cast("long").alias("n_shingles"), (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT, k: int = WORDS) -> DataFrame:
    """Rows of ``docs`` whose text contains no item, with all their columns."""
    keys = common.cut(contaminated(docs, benchmark, containment, k).select("key").distinct(), "leaks")
    return common.anti(docs, F.md5(F.coalesce("text", F.lit("")).cast("binary")), keys)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b WHERE len(w) >= 5)),
sizes AS (SELECT item_id, count(*) AS n FROM bs GROUP BY 1)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n) AS n_shingles, count(*) / any_value(n) AS containment
FROM ds JOIN bs USING (s) JOIN sizes USING (item_id) GROUP BY doc_id, item_id HAVING 5 * count(*) >= 4 * any_value(n)
"""
