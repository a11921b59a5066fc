"""N-gram Jaccard join: MinHash banding, then exact verification on full n-gram sets.

1. Texts with equal word sequences (a 128-bit digest) are one class of copies
   with the first row, in the order of doc_id, as representative; copies never meet in pairs.
2. Representatives get a MinHash signature; ``bands_for`` chooses rows and bands so
   that a pair at the threshold shares a band with the target recall.  Only band
   hashes are shuffled.  A bucket links its members to its least member: a star,
   not all pairs.
3. Components of these links bound where linked pairs can be.  Texts of a component of more than
   ``MOST_BLOCKS`` blocks are banded again with more rows, which tells those apart that only share boilerplate, at
   the same recall.
4. A component is dealt to blocks of bounded weight; each pair of blocks is one unit of work,
   which compares every pair in it on the full n-gram sets.  So each
   pair is compared exactly once, and no task holds more than two blocks.
5. A unit returns one row per text with links: how many documents it links to,
   and a local root.  Components of (text, root) are the classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common
from inkmill.llm.components import connected_components
from inkmill.llm.wordhash import blocks, distinct_in_groups, mix, shingles_of, words_of

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: n-grams and texts of a block at most, on average; one longer text is a block's worth by itself.
BLOCK_SHINGLES = 1 << 18
BLOCK_TEXTS = 1024
#: Rows of a band, at first and for texts of large components; components of more blocks are large.
ROWS = (5, 9)
MOST_BLOCKS = 2
_LAST = (1 << 63) - 1


def bands_for(threshold: float, recall: float, rows: int = 5) -> int:
    """Bands of ``rows`` rows such that a pair at the threshold shares one with the recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1


def _families(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    return seeds[:n], seeds[n:] | np.uint64(1)


def minhash_bands(shingles: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands) of texts that all have shingles."""
    flip, mult = _families(bands * rows)
    out = np.zeros((len(offsets) - 1, bands), np.uint64)
    for b in range(bands):
        for r in range(rows):
            j = b * rows + r
            least = np.minimum.reduceat((shingles ^ flip[j]) * mult[j], offsets[:-1])
            out[:, b] = mix(out[:, b] + least + np.uint64(j + 1))
    return out


def digest(words: np.ndarray, text: str) -> bytes:
    """Equal for equal word sequences; of texts without words, for equal texts."""
    return hashlib.blake2b(words.tobytes() if len(words) else b"\x00" + text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(_row, doc_id, key, n, bands) of each row; n is its number of distinct shingles."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column(2).to_pylist()
        keys: list[bytes] = []
        counts, all_bands = [], []
        for lo, hi in blocks(texts):
            w, at = words_of(texts[lo:hi])
            s, offsets = shingles_of(w, at, words)
            keys += [digest(w[at[i] : at[i + 1]], texts[lo + i] or "") for i in range(hi - lo)]
            full = np.diff(offsets) > 0
            got = np.zeros((hi - lo, bands), np.uint64)
            if full.any():
                got[full] = minhash_bands(s, offsets[np.append(full, True)], bands, rows)
            all_bands.append(got)
            counts.append(np.diff(distinct_in_groups(s, offsets)[1]))
        flat = np.concatenate(all_bands)
        hashes = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, bands), pa.int32()), pa.array(flat.reshape(-1).view(np.int64)))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(np.concatenate(counts).astype(np.int64)), hashes], names=["_row", "doc_id", "key", "n", "bands"])

    return common.map_arrow(docs, run, "_row long, doc_id long, key binary, n long, bands array<long>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, shingles): sorted distinct shingle hashes as little-endian bytes."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column(1).to_pylist()
        out: list[bytes] = []
        for lo, hi in blocks(texts):
            s, at, _ = distinct_in_groups(*shingles_of(*words_of(texts[lo:hi]), words))
            out += [s[at[i] : at[i + 1]].tobytes() for i in range(hi - lo)]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["node", "shingles"])

    return common.map_arrow(docs, run, "node long, shingles binary")


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct arrays."""
    n = len(sets)
    if n == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), shared], [shared, len(sets[1])]])
    _, term, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    out = np.zeros((n, n), np.int64)
    everywhere = df == n
    out += int(everywhere.sum())
    common_terms = (df > 1) & ~everywhere
    number = np.cumsum(common_terms) - 1
    use = common_terms[term]
    term, owner = number[term[use]], owner[use]
    order = np.argsort(term, kind="stable")
    term, owner = term[order], owner[order]
    for lo in range(0, int(common_terms.sum()), columns):
        i, j = np.searchsorted(term, [lo, lo + columns])
        m = np.zeros((n, columns), np.float32)
        m[owner[i:j], term[i:j] - lo] = 1
        out += np.rint(m @ m.T).astype(np.int64)
    return out


def compare(nodes: np.ndarray, sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, across: bool, threshold: float) -> list[tuple[int, int, int]]:
    """(node, links, root) of the nodes with links; only pairs of unequal sides count if ``across``."""
    n = len(nodes)
    if n < 2:
        return []
    size = np.array([len(s) for s in sets])
    shared = overlaps(sets)
    linked = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9
    np.fill_diagonal(linked, False)
    if across:
        linked &= side[:, None] != side[None, :]
    links = linked @ copies
    root = np.full(n, -1)
    for i in np.flatnonzero(links):
        if root[i] < 0:
            root[i] = i
            front = np.array([i])
            while len(front):
                front = np.flatnonzero(linked[front].any(0) & (root < 0))
                root[front] = i
    return [(int(nodes[i]), int(links[i]), int(nodes[root[i]])) for i in np.flatnonzero(links)]


def _verify(units: DataFrame, threshold: float) -> DataFrame:
    """Rows (component, i, j, block, node, copies, shingles), sorted by unit in each partition."""
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, out = None, {}, []

        def close() -> None:
            if len(held) > 1:
                block, copies, sets = zip(*held.values(), strict=True)
                out.extend(compare(np.array([*held]), list(sets), np.array(copies), np.array(block), unit[1] != unit[2], threshold))

        for b in batches:
            for *key, block, node, copies, shingles in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != unit:
                    close()
                    unit, held = key, {}
                held[node] = block, copies, np.frombuffer(shingles, np.uint64)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
        common.release()

    return common.small_batches(units).mapInArrow(run, "node long, links long, root long")


def _candidates(banded: DataFrame) -> DataFrame:
    """(node, component) of the nodes of (node, bands) that share a band with another."""
    postings = banded.select("node", F.explode("bands").alias("band"))
    leads = common.cut(postings.groupBy("band").agg(F.min("node").alias("lead"), F.count("*").alias("c")).filter("c > 1"), "leads")
    return connected_components(common.join_counted(postings, leads, ["band"], "c").filter("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v")))


def _dealt(candidates: DataFrame, reps: DataFrame, block_shingles: int, block_texts: int) -> DataFrame:
    """(component, node, copies, blocks): blocks is how many the component is dealt to."""
    weighed = candidates.join(reps.filter("n > 0").select("node", "copies", "n"), "node")
    parts = weighed.groupBy("component").agg(F.ceil(F.greatest(F.sum("n") / block_shingles, F.count("*") / block_texts)).cast("int").alias("blocks"), F.count("*").alias("c"))
    return common.cut(common.join_counted(common.cut(weighed, "weighed"), common.cut(parts, "parts"), ["component"], "c").select("component", "node", "copies", "blocks"), "dealt")


def _linked(held: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL, rows: tuple[int, ...] = ROWS, block_shingles: int = BLOCK_SHINGLES, block_texts: int = BLOCK_TEXTS, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """(_row, doc_id, root, n_links) of each row of ``held`` (_row, doc_id, text); root is the first row of its class."""
    sig = common.cut(signatures(held.select("_row", common.as_long(held, "doc_id").alias("doc_id"), "text"), words, bands_for(threshold, recall, rows[0]), rows[0]), "signatures")
    reps = common.cut(sig.groupBy("key").agg(F.min("_row").alias("node"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")), "representatives")
    texts = held.select(F.col("_row").alias("node"), "text")

    dealt = _dealt(_candidates(reps.filter("n > 0").select("node", "bands")), reps, block_shingles, block_texts)
    for more in rows[1:]:
        large = dealt.filter(F.col("blocks") > most_blocks)
        if not large.limit(1).count():
            break
        again = common.semi(texts, F.col("node"), large.select("node")).select(F.col("node").alias("_row"), F.lit(None).cast("long").alias("doc_id"), "text")
        banded = common.cut(signatures(again, words, bands_for(threshold, recall, more), more).select(F.col("_row").alias("node"), "bands"), "signatures")
        dealt = dealt.filter(F.col("blocks") <= most_blocks).unionByName(_dealt(_candidates(banded), reps, block_shingles, block_texts))

    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sets = shingle_sets(common.semi(texts, F.col("node"), dealt.select("node")), words)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = (
        dealt.join(sets, "node")
        .select("component", "node", "copies", "block", "shingles", other)
        .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "shingles")
        .repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j")
    )
    found = common.cut(_verify(units, threshold), "links")
    classes = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    by_node = reps.select("key", "node", "copies").join(links, "node", "left").join(classes, "node", "left")
    by_key = common.cut(by_node.select("key", "copies", F.coalesce("component", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes-by-key")
    return common.join_counted(sig.select("_row", "doc_id", "key"), by_key, ["key"], "copies").select("_row", "doc_id", "root", "n_links")


def jaccard_classes(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, n_links): one row per row of ``docs`` (doc_id, text, ...).

    n_links is the number of other rows whose n-gram sets are at least as similar as the
    threshold, copies included; class_id is the least doc_id of the
    rows that links join.  A text of fewer than ``words`` words is one n-gram; a null text is
    empty; texts without words link to equal texts only.  A row without doc_id comes
    after all others; a class is null if no row of it has an id.  Repeated rows are copies of
    each other (ids are longs: what is no number is a row without an id); rows of one doc_id with different texts are rows of their own.  Other columns are not read.
    ``options`` are those of ``_linked``: threshold, words, recall, rows of a band, limits of blocks.
    """
    own = docs.select(common.as_long(docs, "doc_id").alias("doc_id"), "text")
    place = F.coalesce("doc_id", F.lit(_LAST))
    held, _ = common.numbered(own, place, "near-rows")
    found = _linked(held, **options)
    if common.distinct(own, place):
        return found.select("doc_id", F.when(F.col("root") == F.col("_row"), F.col("doc_id")).otherwise(F.col("root")).alias("class_id"), "n_links")
    found = common.cut(found, "near-classes")
    sizes = found.groupBy("root").agg(F.count("*").alias("c"))
    ids = common.cut(sizes.join(found.filter("root = _row").select("root", F.col("doc_id").alias("class_id")), "root"), "class-ids")
    return common.join_counted(found, ids, ["root"], "c").select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The first row of each class of ``docs`` in the order of doc_id, and of its rows without an id the first too.

    Rows that share a doc_id but not their texts are told apart.  All columns stay, whatever their names.
    """
    held, row = common.numbered(docs, F.coalesce(common.as_long(docs, "doc_id"), F.lit(_LAST)), "near-rows")
    classes = common.cut(_linked(held.select(F.col(row).alias("_row"), "doc_id", "text"), **options), "classes")
    unnamed = classes.filter("doc_id is null")
    firsts = unnamed.groupBy("root").agg(F.min("_row").alias("first")).select("first")
    drop = classes.filter("doc_id is not null and _row <> root").select("_row").union(common.anti(unnamed.select("_row"), F.col("_row"), firsts))
    return common.anti(held, F.col(row), drop).select(*map(common.col, docs.columns))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(common.table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') AS w FROM documents
), texts AS (
  SELECT min(doc_id) AS node, count(*) AS copies, CASE WHEN len(w) > 0 THEN array_to_string(w, ' ') ELSE chr(1) || text END AS key, any_value(w) AS w
  FROM words GROUP BY 3
), shingles AS (
  SELECT DISTINCT node, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT node, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM texts WHERE len(w) > 0)
), sizes AS (SELECT node, count(*) AS n FROM shingles GROUP BY node),
shared AS (
  SELECT a.node AS u, b.node AS v, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.node <> b.node GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT u, v FROM shared JOIN sizes x ON x.node = u JOIN sizes y ON y.node = v WHERE 5 * k >= 4 * (x.n + y.n - k)
), reach AS (
  SELECT node, node AS seen FROM texts UNION SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.seen
), classes AS (SELECT node, min(seen) AS class_id FROM reach GROUP BY node),
counts AS (SELECT u AS node, sum(t.copies) AS links FROM links JOIN texts t ON t.node = v GROUP BY u)
SELECT d.doc_id, c.class_id, CAST(coalesce(n.links, 0) + t.copies - 1 AS BIGINT) AS n_links
FROM words d
JOIN texts t ON t.key = CASE WHEN len(d.w) > 0 THEN array_to_string(d.w, ' ') ELSE chr(1) || d.text END
JOIN classes c ON c.node = t.node LEFT JOIN counts n ON n.node = t.node
"""
