"""Language-model scores: stupid backoff from n-gram count tables of the corpus itself.

A word's score is its n-gram's count over the context's count; where the n-gram
has no count, it is ``alpha`` times the score one order below.  Counts
come from all other documents: a document's own are taken off (else every n-gram
would be known).  A document's score is the sum of its words' logarithms.

1. Documents are dealt to blocks.  A block's n-grams of all orders are its relation (gram, n), sorted, with each distinct one once.
   A frequent n-gram is so in it once a block, however many documents have it.  The order 0, one n-gram that every word has, counts the words of the corpus.
2. The relations are partitioned by ranges of the n-gram's hash.  A part of a block's relation is shuffled as one row of two packed columns.
3. A part is summed to the count table of its range, which is joined to the relations of all blocks there: both are sorted by n-gram.  What goes back to a
   block is the column that the join adds, in the order of its relation: how often the other blocks have each n-gram.
4. It meets the documents by block, and is summed per document.

Rows of one n-gram and block each, shuffled as such, take 11.6 bytes and 13.5 bytes on the way back; packed columns take about 6 and less than 1.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common
from inkmill.llm.wordhash import blocks, mix, words_of

ORDER = 3
ALPHA = 0.4
#: Characters of a block on average; one longer text is a block's worth by itself.  There are as many parts as blocks, so that either takes the same memory on any corpus.
BLOCK_CHARS = 10_000_000
#: Bytes of documents that a task deals out at once; those of one block are compressed together.
HELD = 32_000_000
#: Most tasks of a shuffle, however many blocks there are; a task takes its blocks one by one.
MAX_TASKS = 1 << 14
#: The n-gram of order 0.
_EMPTY = np.uint64(0)
_LAST = (1 << 63) - 1
_DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def block_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts and their offsets."""
    parts = [words_of(texts[lo:hi]) for lo, hi in blocks(texts)]
    words = np.concatenate([w for w, _ in parts]) if parts else np.empty(0, np.uint64)
    counts = np.concatenate([np.diff(o) for _, o in parts]) if parts else np.empty(0, np.int64)
    return words, np.concatenate([[0], np.cumsum(counts)])


def ngrams(words: np.ndarray, offsets: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For k = 1 to order: the words where a k-gram of their text ends, and the hashes of these k-grams."""
    place = np.arange(len(words)) - np.repeat(offsets[:-1], np.diff(offsets))
    gram = mix(words + np.uint64(1))
    yield np.arange(len(words)), gram
    for k in range(2, order + 1):
        longer = np.zeros(len(words), np.uint64)
        longer[k - 1 :] = mix(gram[k - 1 :] * np.uint64(0x9E3779B97F4A7C15) + mix(words[: max(0, len(words) - k + 1)] ^ np.uint64(k)))
        gram = longer
        ends = np.flatnonzero(place >= k - 1)
        yield ends, gram[ends]


def relation(words: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a block of all orders: sorted hashes, of which the first is the empty one, and counts."""
    grams, counts = np.unique(np.concatenate([gram for _, gram in ngrams(words, offsets, order)]), return_counts=True)
    return np.append(_EMPTY, grams), np.append(len(words), counts)


def cuts(grams: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of hashes begins in the sorted ``grams``, and the end."""
    return np.append(np.searchsorted(grams, np.array([-(-(p << 64) // parts) for p in range(parts)], np.uint64)), len(grams))


def packed(values: np.ndarray) -> bytes:
    """Integers of 64 bits, compressed by bytes of one significance: of small ones most are zero."""
    return pa.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=8 * size, codec="zstd"), np.uint8).reshape(8, size).T.copy().view(kind).reshape(size)


def beyond(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row (gram, count) of several relations: the count of its n-gram in all of them, without its own."""
    turn = np.argsort(grams)
    ordered = grams[turn]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    total = np.add.reduceat(counts[turn], first)
    out = np.empty(len(grams), np.int64)
    out[turn] = np.repeat(total, np.diff(np.append(first, len(grams))))
    return out - counts


def log_scores(words: np.ndarray, offsets: np.ndarray, order: int, alpha: float, grams: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log scores of all words of a block, by the counts of all other documents; ``grams`` are sorted, the first is the empty one."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    context = np.log(np.maximum(1, totals[0] - np.diff(offsets)))[owner]
    score = np.zeros(len(words))
    for k, (ends, gram) in enumerate(ngrams(words, offsets, order), 1):
        turn = np.argsort(gram, kind="stable")  # so equal n-grams are in order of their documents
        gram, own = gram[turn], owner[ends][turn]
        first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (own[1:] != own[:-1])])[: len(gram)])
        count = np.diff(np.append(first, len(gram)))
        at = np.minimum(np.searchsorted(grams, gram[first]), len(grams) - 1)
        others = np.empty(len(gram), np.int64)
        others[turn] = np.repeat(np.where(grams[at] == gram[first], totals[at] - count, 0), count)
        logs = np.log(np.maximum(1, others))
        if k == 1:
            score[ends] = logs - context[ends]
        else:
            score[ends] = np.where(others > 0, logs - context[ends - 1], score[ends] + np.log(alpha))
        context = np.zeros(len(words))
        context[ends] = logs
    return score


def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, docs) of rows (block, doc_id, text): those of a block are one Arrow stream, compressed, for each HELD bytes."""

    def deal(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).sort_by("block").combine_chunks()
        block = rows["block"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        docs = []
        for lo, hi in itertools.pairwise(edges):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(rows.slice(lo, hi - lo).select(["doc_id", "text"]).cast(_DOCS))
            docs.append(sink.getvalue().to_pybytes())
        return pa.record_batch({"block": pa.array(block[edges[:-1]], pa.int32()), "docs": pa.array(docs, pa.binary())})

    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.nbytes for x in held) >= HELD:
            yield deal(held)
            held = []
    if held:
        yield deal(held)
    common.release()


def documents(bundles: pa.Table) -> pa.Table:
    return pa.concat_tables(pa.ipc.open_stream(x).read_all() for x in bundles["docs"].to_pylist())


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_words, log_score): natural logarithms summed over the words of each row.

    A word that no other row has counts as seen once.  The first words of a text are
    scored by the n-grams there are, without a penalty.  A null text is empty; without words the score is 0.
    Null and repeated ids are allowed: every row is a document of its own, and copies count for each other.
    Other columns are not read; an empty table gives none.
    """
    own = docs.select(common.as_long(docs, "doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows, row = common.numbered(own, F.coalesce("doc_id", F.lit(_LAST)), "scored-rows")
    n = max(1, -(-(own.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    tasks = min(n, MAX_TASKS)
    blocked = rows.select(F.pmod(F.xxhash64(row), F.lit(n)).cast("int").alias("block"), "doc_id", "text")
    dealt = common.small_batches(blocked).mapInArrow(bundled, "block int, docs binary").repartition(tasks, "block")

    def explode(d: pa.Table) -> pa.Table:
        grams, counts = relation(*block_words(documents(d)["text"].to_pylist()), order)
        at = cuts(grams, n)
        spans = [(p, lo, hi) for p, (lo, hi) in enumerate(itertools.pairwise(at.tolist())) if lo < hi]
        common.release()
        return pa.table({
            "part": pa.array([p for p, _, _ in spans], pa.int32()),
            "block": pa.array([d["block"][0].as_py()] * len(spans), pa.int32()),
            "size": pa.array([hi - lo for _, lo, hi in spans], pa.int32()),
            "steps": pa.array([packed(np.diff(grams[lo:hi], prepend=_EMPTY)) for _, lo, hi in spans], pa.binary()),
            "counts": pa.array([packed(counts[lo:hi]) for _, lo, hi in spans], pa.binary()),
        })

    def count(d: pa.Table) -> pa.Table:
        size = d["size"].to_pylist()
        grams = np.concatenate([np.cumsum(unpacked(x, m, np.uint64), dtype=np.uint64) for x, m in zip(d["steps"].to_pylist(), size, strict=True)])
        counts = np.concatenate([unpacked(x, m, np.int64) for x, m in zip(d["counts"].to_pylist(), size, strict=True)])
        others = np.split(beyond(grams, counts), np.cumsum(size)[:-1])
        common.release()
        return pa.table({"block": d["block"], "part": d["part"], "size": d["size"], "others": pa.array([packed(x) for x in others], pa.binary())})

    def finish(d: pa.Table, a: pa.Table) -> pa.Table:
        d = documents(d)
        words, offsets = block_words(d["text"].to_pylist())
        d = d.drop_columns("text")
        n_words = np.diff(offsets)
        total = np.zeros(len(n_words))
        if len(words):
            a = a.sort_by("part")
            grams, counts = relation(words, offsets, order)
            others = np.concatenate([unpacked(x, m, np.int64) for x, m in zip(a["others"].to_pylist(), a["size"].to_pylist(), strict=True)])
            logs = log_scores(words, offsets, order, alpha, grams, counts + others)
            full = n_words > 0
            total[full] = np.add.reduceat(logs, offsets[:-1][full])
            common.release()
        return pa.table({"doc_id": d["doc_id"], "n_words": pa.array(n_words.astype(np.int64)), "log_score": pa.array(total)})

    grams = dealt.groupBy("block").applyInArrow(explode, "part int, block int, size int, steps binary, counts binary").repartition(tasks, "part")
    # Ranges of hashes are alike in size; a frequent n-gram adds one row of a block's million or more to its part.
    others = grams.groupBy("part").applyInArrow(count, "block int, part int, size int, others binary").repartition(tasks, "block")
    return dealt.groupBy("block").cogroup(others.groupBy("block")).applyInArrow(finish, "doc_id long, n_words long, log_score double")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') AS w FROM documents),
t AS (
  SELECT doc_id, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
),
own1 AS (SELECT doc_id, c, count(*) AS n FROM t GROUP BY ALL),
own2 AS (SELECT doc_id, b, c, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY ALL),
own3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM t WHERE a IS NOT NULL GROUP BY ALL),
all1 AS (SELECT c, sum(n) AS n FROM own1 GROUP BY ALL),
all2 AS (SELECT b, c, sum(n) AS n FROM own2 GROUP BY ALL),
all3 AS (SELECT a, b, c, sum(n) AS n FROM own3 GROUP BY ALL),
other1 AS (SELECT doc_id, c, all1.n - own1.n AS n FROM own1 JOIN all1 USING (c)),
other2 AS (SELECT doc_id, b, c, all2.n - own2.n AS n FROM own2 JOIN all2 USING (b, c)),
other3 AS (SELECT doc_id, a, b, c, all3.n - own3.n AS n FROM own3 JOIN all3 USING (a, b, c)),
total AS (SELECT count(*) AS n FROM t),
logs AS (
  SELECT t.doc_id,
    CASE WHEN g.n > 0 THEN ln(g.n) - ln(greatest(1, gc.n)) ELSE CASE WHEN t.a IS NOT NULL THEN ln(0.4) ELSE 0 END +
      CASE WHEN h.n > 0 THEN ln(h.n) - ln(greatest(1, hc.n)) ELSE CASE WHEN t.b IS NOT NULL THEN ln(0.4) ELSE 0 END +
        ln(greatest(1, u.n)) - ln(greatest(1, total.n - len(d.w))) END END AS s
  FROM t JOIN d USING (doc_id) CROSS JOIN total
  JOIN other1 u ON u.doc_id = t.doc_id AND u.c = t.c
  LEFT JOIN other2 h ON h.doc_id = t.doc_id AND h.b = t.b AND h.c = t.c
  LEFT JOIN other1 hc ON hc.doc_id = t.doc_id AND hc.c = t.b
  LEFT JOIN other3 g ON g.doc_id = t.doc_id AND g.a = t.a AND g.b = t.b AND g.c = t.c
  LEFT JOIN other2 gc ON gc.doc_id = t.doc_id AND gc.b = t.a AND gc.c = t.b
), sums AS (SELECT doc_id, sum(s) AS s FROM logs GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, round(coalesce(s, 0), 3) AS log_score FROM d LEFT JOIN sums USING (doc_id)
"""
