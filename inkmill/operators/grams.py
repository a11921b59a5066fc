"""A positional inverted index of a library's pairs of characters, for the keyword search.

A posting has a pair of characters, a document, a field and the places where the pair stands in the field's lower-cased text.  Postings are
dealt to buckets by the pair's hash and sorted by pair, so a keyword reads its own buckets only.  A keyword stands where its pairs
stand in a row, so counts are exact, without a text being read; texts are read for the context of hits alone.

Documents are indexed in generations: changed ones are added in a new one, and only a document's newest postings count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions.batches import bound_batches, release
from inkmill.operators import search
from inkmill.sources.shared import file_system

BUCKETS = 64
#: Files of a bucket and generation: pairs that most documents have are dealt to several.
PARTS = 4
TITLE, META, BODY = range(FIELDS := 3)
#: Characters that are sorted at once; a longer document is sorted by itself.
BLOCK = 1 << 20


def _varints(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of non-negative numbers, seven bits in each and the last below 128, and how many each has."""
    size = sum((n >= 1 << 7 * k).astype(np.int64) for k in range(1, 5)) + 1
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=1))):
        has = np.flatnonzero(size > k)
        more = size[has] > k + 1
        out[at[has] + k] = (n[has] >> 7 * k & 127) | more.astype(np.int64) << 7
    return out, size


def _numbers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``_varints``, and where each one's bytes end."""
    end = np.flatnonzero(data < 128) + 1
    if not len(end):
        return np.empty(0, np.int64), end
    start = np.concatenate(([0], end[:-1]))
    place = np.arange(len(data)) - np.repeat(start, end - start)
    return np.add.reduceat((data.astype(np.int64) & 127) << 7 * place, start), end


def _offsets(sizes: np.ndarray) -> pa.Buffer:
    return pa.py_buffer(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))


def _block(paths: pa.Array, texts: list[str]) -> pa.RecordBatch | None:
    """Postings of documents, of which ``texts`` has the fields in turn: one sort of all their pairs of characters."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(length) - length
    unit = np.repeat(np.arange(len(texts)), length)
    at = np.flatnonzero(unit[:-1] == unit[1:])
    if not len(at):
        return None
    there = np.zeros(0x110000, bool)
    there[codes] = True
    rank = np.cumsum(there, dtype=np.int32) - 1
    kinds, own = int(rank[-1]) + 1, rank[codes].astype(np.uint64)
    bits = int(at[-1]).bit_length()
    group = (unit[at].astype(np.uint64) * kinds + own[at]) * kinds + own[at + 1]
    if len(texts) * kinds * kinds << bits < 1 << 64:
        both = np.sort(group << np.uint64(bits) | at.astype(np.uint64))
        group, at = both >> np.uint64(bits), (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    else:
        order = np.argsort(group, kind="stable")
        group, at = group[order], at[order]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    heads = at[first]
    place = at - start[unit[at]]
    step = np.diff(place, prepend=0)
    step[first] = place[first]
    data, size = _varints(step)
    pairs = codes[np.stack([heads, heads + 1], 1)]
    wide = 1 + (pairs >= 0x80) + (pairs >= 0x800).astype(np.int64) + (pairs >= 0x10000)
    names = pa.py_buffer(pairs.tobytes().decode("utf-32-le").encode())
    n, of = len(first), unit[heads]
    return pa.RecordBatch.from_arrays(
        [
            pa.StringArray.from_buffers(n, _offsets(wide.sum(1)), names), paths.take(pa.array(of // FIELDS)), pa.array((of % FIELDS).astype(np.int8)),
            pa.Array.from_buffers(pa.binary(), n, [None, _offsets(np.add.reduceat(size, first)), pa.py_buffer(data)]),
        ],
        names=["pair", "path", "field", "at"],
    )


def _postings(corpus: DataFrame) -> DataFrame:
    """(pair, path, field, at) of the fields of (path, title, meta, body) in lower case; ``at`` has the steps from place to place as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for row in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True) for t in row]
            ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))[FIELDS - 1 :: FIELDS]
            low = 0
            while low < b.num_rows:
                done = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
                out = _block(b.column(0).slice(low, high - low), texts[low * FIELDS : high * FIELDS])
                low = high
                if out is not None:
                    yield out
        release()

    bound_batches(corpus.sparkSession)
    low = corpus.select("path", F.lower("title"), F.lower(search.meta()), F.lower("body"))
    return low.mapInArrow(run, "pair string, path string, field byte, at binary")


def _places(held: DataFrame) -> DataFrame:
    """Postings with ``at`` as an array of places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = b.column(3).to_pylist()
            steps, end = _numbers(np.frombuffer(b"".join(cells), np.uint8))
            rows = np.cumsum(np.fromiter(map(len, cells), np.int64, len(cells)))
            stop = np.searchsorted(end, rows, "right")
            sizes = np.diff(stop, prepend=0)
            total = np.concatenate(([0], np.cumsum(steps)))
            at = total[1:] - np.repeat(total[stop - sizes], sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], stop)).astype(np.int32)), pa.array(at.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], lists], names=["pair", "path", "field", "at"])
        release()

    bound_batches(held.sparkSession)
    return held.mapInArrow(run, "pair string, path string, field byte, at array<int>")


def _bucket(pair: Column) -> Column:
    return F.pmod(F.xxhash64(pair), F.lit(BUCKETS)).cast("int")


def generations(spark: SparkSession, root: str) -> list[int]:
    fs, where = file_system(spark, root)
    names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n[4:]) for n in names if n.startswith("gen-"))


def add(corpus: DataFrame, root: str, removed: DataFrame | None = None) -> int:
    """Index documents (path, title, tags, excerpt, source, body) that are new or changed, and forget ``removed`` (path); the generation's number.

    A generation is put in place by one rename; a run that ends before it leaves the index as it was.  One process adds at a time.
    """
    spark = corpus.sparkSession
    number = max(generations(spark, root), default=0) + 1
    made = f"{root}/.gen-{number}"
    fs, part = file_system(spark, made)
    fs.delete(part, True)
    rows = _postings(corpus).withColumn("bucket", _bucket(F.col("pair")))
    rows = rows.repartition("bucket", F.pmod(F.xxhash64("path"), F.lit(PARTS))).sortWithinPartitions("bucket", "pair")
    rows.write.partitionBy("bucket").parquet(f"{made}/postings")
    paths = corpus.select("path", F.lit(False).alias("gone"))
    paths = paths.unionByName(removed.select("path", F.lit(True).alias("gone"))) if removed is not None else paths
    paths.write.parquet(f"{made}/paths")
    if not fs.rename(part, file_system(spark, f"{root}/gen-{number}")[1]):
        raise RuntimeError(f"generation {number} is there already")
    return number


_POSTING = "pair string, path string, field byte, at binary, bucket int"


def _held(spark: SparkSession, root: str, pairs: list[str]) -> DataFrame:
    """Postings of the given pairs as they are stored, of documents as they were indexed last."""
    wanted = [F.lit(p) for p in pairs]
    buckets = [r[0] for r in spark.createDataFrame([(p,) for p in pairs], "pair string").select(_bucket(F.col("pair"))).distinct().collect()]
    rows, paths = None, None
    for g in generations(spark, root):
        own = spark.read.schema(_POSTING).parquet(f"{root}/gen-{g}/postings").filter(F.col("bucket").isin(buckets) & F.col("pair").isin(*wanted)).select("pair", "path", "field", "at", F.lit(g).alias("gen"))
        there = spark.read.schema("path string, gone boolean").parquet(f"{root}/gen-{g}/paths").select("path", "gone", F.lit(g).alias("gen"))
        rows, paths = (own, there) if rows is None else (rows.unionByName(own), paths.unionByName(there))
    if rows is None:
        return spark.createDataFrame([], _POSTING).drop("bucket")
    last = paths.groupBy("path").agg(F.max(F.struct("gen", "gone")).alias("s")).filter("not s.gone").select("path", F.col("s.gen").alias("gen"))
    return rows.join(last, ["path", "gen"]).select("pair", "path", "field", "at")


def postings(spark: SparkSession, root: str, pairs: list[str]) -> DataFrame:
    """(pair, path, field, at) of the given pairs, of documents as they were indexed last."""
    return _places(_held(spark, root, pairs))


def _count(starts: Column, length: int) -> Column:
    """How many of the ascending places don't overlap the one counted before."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(-length).alias("last"))
    step = lambda s, p: F.when(p >= s["last"] + length, F.struct((s["n"] + 1).alias("n"), p.alias("last"))).otherwise(s)
    return F.aggregate(starts, zero, step, lambda s: s["n"])


def _moved(places: Column, by: int) -> Column:
    return F.transform(places, lambda x: x - by)


def counts(spark: SparkSession, root: str, words: list[str]) -> DataFrame:
    """(path, and t, m and b with the keyword's number): how often each keyword of two characters or more stands in title, meta and body.

    Only documents that have all pairs of a keyword in a field are looked at.
    """
    pairs = {i: list(dict.fromkeys(w[j : j + 2] for j in range(len(w) - 1))) for i, w in enumerate(words)}
    held = _held(spark, root, sorted({p for own in pairs.values() for p in own}))
    out = None
    for i, w in enumerate(words):
        own = _places(held.filter(F.col("pair").isin(*map(F.lit, pairs[i])))).groupBy("path", "field").agg(F.map_from_entries(F.collect_list(F.struct("pair", "at"))).alias("places"))
        own = own.filter(F.size("places") == len(pairs[i]))
        starts = F.element_at("places", w[:2])
        for j in range(1, len(w) - 1):
            starts = F.array_intersect(starts, _moved(F.element_at("places", w[j : j + 2]), j))
        n = _count(F.array_sort(starts), len(w))
        found = own.select("path", "field", F.lit(i).alias("word"), n.alias("n")).filter("n > 0")
        out = found if out is None else out.unionByName(found)
    at = lambda i, field: F.coalesce(F.max(F.when((F.col("word") == i) & (F.col("field") == field), F.col("n"))), F.lit(0))
    return out.groupBy("path").agg(*(at(i, f).alias(f"{c}{i}") for i in range(len(words)) for f, c in ((TITLE, "t"), (META, "m"), (BODY, "b"))))


def find(corpus: DataFrame, root: str, keywords: list[str], category: str | None = None) -> DataFrame:
    """The rows of ``search.search``, by the index at ``root``; of ``corpus`` (path, body, quality) only the hits' rows are used.

    A keyword of one character has no pair; with one, the whole corpus is searched, which then needs all columns.
    """
    words = [k.lower() for k in keywords]
    if any(len(w) < 2 for w in words):
        return search.search(corpus, keywords, category)
    hits = search.in_category(counts(corpus.sparkSession, root, words), category)
    hits = search.scored(hits, words).select("path", "score", "why", *(F.col(f"b{i}") for i in range(len(words))))
    return search.shown(hits.join(corpus.select("path", "body", "quality"), "path"), words)
