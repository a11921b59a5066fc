"""Substring dedup by content-defined chunks: every passage of a given length that occurred before, at any place.

A text is a row of units: words, and single characters for all else but spaces, for scripts
without spaces and for words over LONG characters.  A passage is a span from
a unit's start to a unit's end that has ``min_run`` characters or ``words`` words.  One that
occurred before, in the order of doc_id, is removed; the first occurrence stays.

1. Rows of equal text are told by a digest; all but the first are repeats as a whole.
2. A gear rolling hash ranks all positions by the GEAR characters from there on.  The least rank in the shortest passage from each unit is its
   anchor, so equal passages have equal anchors, whatever was inserted before them.  (A mask on the hash, as is usual, leaves
   some passages without a cut.)  A shingle of half the length stands for an anchor: one that occurs at one place only is in
   no repeat, and only about one in ten is shuffled.
3. The passages with one anchor make a chunk of variable length.  A chunk that an earlier row has too, by its digest, is a
   repeat, all its passages included.
4. Of what is left with a shared anchor, one row for each chunk, passages are compared by 128-bit
   digests.  Besides the shortest at each start there is one for each end that those skip, so together they
   cover a repeat to both its edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common
from inkmill.llm.wordhash import _word_table, blocks, code_points, mix, span_hashes

MIN_RUN = 180
#: The fewest words of a passage of over 50, however short they are.
WORDS = 51
LONG = 32
#: Characters of the rolling hash; a half of a passage of the default length has more, for shorter ones it is less.
GEAR = 32
#: Characters that a worker takes at once; a longer text is taken alone.
BLOCK_CHARS = 500_000
_LAST = (1 << 63) - 1
#: Scripts without spaces between words, by first and last code point.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_space = np.array([chr(c).isspace() for c in range(0x3001)] + [False])


def units_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the units, and the number of words that begin before each (one more than units)."""
    space = _space[np.minimum(codes, len(_space) - 1)]
    word = _word_table()[codes] & ~space
    for lo, hi in UNSPACED:
        word &= (codes < lo) | (codes > hi)
    before = np.concatenate([[False], word[:-1]])
    begins = word & ~before
    step = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    runs, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    first = ~space & ~(word & before)
    for i in np.flatnonzero(stops - runs > LONG).tolist():
        first[runs[i] : stops[i]] = True
    last = ~space & np.concatenate([(space | first)[1:], [True]])
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.concatenate([[0], np.cumsum(begins[starts])])


def shortest(starts: np.ndarray, ends: np.ndarray, count: np.ndarray, limit: np.ndarray, chars: int, words: int) -> np.ndarray:
    """For each unit the last one of the shortest passage from it; len(starts) if ``limit``, the text's last unit, comes before."""
    to = np.minimum(np.searchsorted(ends, starts + chars), np.searchsorted(count[1:], count[:-1] + words))
    return np.where(to <= limit, to, len(starts))


def least_in(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Positions of the first least value of ``hashes[lo..hi]``, both included."""
    level = np.arange(len(hashes))
    power = np.frexp(hi - lo + 1)[1] - 1
    out = np.empty(len(lo), np.int64)
    for k in range(int(power.max(initial=-1)) + 1):
        if k:
            a, b = level[: -(1 << (k - 1))], level[1 << (k - 1) :]
            level = np.where(hashes[b] < hashes[a], b, a)
        at = np.flatnonzero(power == k)
        a, b = level[lo[at]], level[hi[at] - (1 << k) + 1]
        out[at] = np.where(hashes[b] < hashes[a], b, a)
    return out


def gear_hashes(codes: np.ndarray, window: int = GEAR) -> np.ndarray:
    """Gear hash of the ``window`` characters that begin at each position: the sum of their table values, each shifted once more than the next.

    It rolls by doubling: sums of 2k characters are two sums of k.  The table's value of a character is a mixed hash of its code point.
    """
    h = mix(codes[::-1].astype(np.uint64) + np.uint64(0x6A09E667F3BCC909))
    k = 1
    while k < window:
        longer = h.copy()
        longer[k:] += h[:-k] << np.uint64(k)
        h, k = longer, 2 * k
    return h[::-1]


class Passages:
    """Of a block of texts: first (``at``) and last units of the shortest passages, the text of each and its anchor (``taken``), with the anchor's shingle."""

    def __init__(self, texts: list[str | None], chars: int, words: int) -> None:
        self.codes = code_points("\n".join(t or "" for t in texts) + "\n")
        self.edges = np.cumsum([0] + [len(t or "") + 1 for t in texts])
        self.starts, self.ends, count = units_of(self.codes)
        n = len(self.starts)
        text = np.searchsorted(self.edges, self.starts, "right") - 1
        limit = np.searchsorted(self.starts, self.edges[text + 1]) - 1
        to = shortest(self.starts, self.ends, count, limit, chars, words)
        half = shortest(self.starts, self.ends, count, limit, (chars + 1) // 2, (words + 1) // 2)
        at = np.flatnonzero(to < n)
        whole = np.flatnonzero(half < n)
        shingles = np.zeros(n, np.uint64)
        shingles[whole] = span_hashes(self.codes, self.starts[whole], self.ends[half[whole]])
        self.at, self.to, self.text = at, to[at], text[at]
        inside = whole[np.searchsorted(half[whole], self.to, "right") - 1] if len(at) else at
        reach = max(1, min(GEAR, (chars + 1) // 2, 2 * ((words + 1) // 2) - 1))  # within any shingle
        ranks = mix(gear_hashes(self.codes, 1 << reach.bit_length() - 1))
        self.taken = least_in(ranks[self.starts], at, inside)
        self.digest = shingles[self.taken]
        self.ends_at = np.minimum(np.append(to, n)[at + 1], limit[at] + 1)

    def every(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, start and end of the passages at ``use`` (numbers in ``at``), with the longer ones for ends that are skipped."""
        more = np.maximum(self.ends_at[use] - self.to[use], 1)
        which = np.repeat(use, more)
        step = np.arange(len(which)) - np.repeat(np.cumsum(more) - more, more)
        return self.text[which], self.starts[self.at[which]], self.ends[self.to[which] + step]


def is_passage(text: str, chars: int, words: int) -> bool:
    starts, ends, count = units_of(code_points(text))
    return len(starts) > 0 and bool(ends[-1] - starts[0] >= chars or count[-1] >= words)


def stretch_table(docs: DataFrame, min_run: int, words: int) -> DataFrame:
    """(_row, digest, stretch, span, again) of each shingle taken: its hash, that of the passages that take it from the
    first one's start to the last one's end, start << 32 | end of this, and whether the row takes an equal shingle elsewhere."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, number = b.column(1).to_pylist(), b.column(0).to_numpy()
        out = []
        for lo, hi in blocks(texts, BLOCK_CHARS):
            p = Passages(texts[lo:hi], min_run, words)
            one = np.flatnonzero(np.diff(p.taken, prepend=-1))
            last = np.append(one[1:], len(p.taken))[: len(one)] - 1
            start, end = p.starts[p.at[one]], p.ends[np.maximum(p.ends_at[last] - 1, p.to[last])]
            text, digest = p.text[one], p.digest[one]
            order = np.lexsort((digest, text))
            same = (np.diff(text[order]) == 0) & (np.diff(digest[order]) == 0)
            again = np.zeros(len(one), bool)
            again[order[1:][same]] = again[order[:-1][same]] = True
            span = ((start - p.edges[text]) << 32) | (end - p.edges[text])
            out.append((number[lo:hi][text], digest.view(np.int64), span_hashes(p.codes, start, end).view(np.int64), span, again))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["_row", "digest", "stretch", "span", "again"])

    return common.map_arrow(docs.select("_row", "text"), run, "_row long, digest long, stretch long, span long, again boolean", rows=500)


def passage_table(docs: DataFrame, min_run: int, words: int) -> DataFrame:
    """(_row, span, h1, h2) of the passages whose shingle is in ``_shared``; span is start << 32 | end.

    Those that repeat an earlier one of their own row without overlap have null digests.
    """

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, number, shared = b.column(1).to_pylist(), b.column(0).to_numpy(), b.column(2)
        out = []
        for lo, hi in blocks(texts, BLOCK_CHARS):
            p = Passages(texts[lo:hi], min_run, words)
            first = np.searchsorted(p.text, np.arange(hi - lo + 1))
            use = [first[i] + np.flatnonzero(np.isin(p.digest[first[i] : first[i + 1]], shared[lo + i].values.to_numpy().view(np.uint64))) for i in range(hi - lo) if shared[lo + i].is_valid]
            text, start, end = p.every(np.concatenate([*use, np.empty(0, np.int64)]).astype(np.int64))
            h1, h2 = span_hashes(p.codes, start, end), span_hashes(p.codes + np.uint32(1 << 21), start, end)
            order = np.lexsort((start, h2, h1, text))
            text, start, end, h1, h2 = (x[order] for x in (text, start, end, h1, h2))
            new = np.ones(len(order), bool)
            new[1:] = (text[1:] != text[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            own = start >= end[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else new
            span = ((start - p.edges[text]) << 32) | (end - p.edges[text])
            out.append((number[lo:hi][text], span, h1.view(np.int64), h2.view(np.int64), own))
        rows, spans, h1, h2, own = (np.concatenate(x) for x in zip(*out, strict=True))
        columns = [pa.array(rows), pa.array(spans), pa.array(h1, mask=own), pa.array(h2, mask=own)]
        return pa.RecordBatch.from_arrays(columns, names=["_row", "span", "h1", "h2"])

    return common.map_arrow(docs.select("_row", "text", "_shared"), run, "_row long, span long, h1 long, h2 long", rows=500)


def joined_spans(spans: np.ndarray) -> list[tuple[int, int]]:
    """Sorted disjoint (start, end) of spans start << 32 | end."""
    spans = np.sort(spans)
    start, end = spans >> 32, np.maximum.accumulate(spans & 0xFFFFFFFF)
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return list(zip(start[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist(), strict=True))


def dedup_substrings(docs: DataFrame, min_run: int = MIN_RUN, words: int = WORDS) -> DataFrame:
    """All columns of ``docs`` with ``text`` cleaned, and n_removed and removed (start, end in code points) added.

    Null and empty texts stay as they are, with nothing removed.  Rows without doc_id come after all
    others; those, and rows that repeat a doc_id, are rows of their own, in the order they are read in.  A later
    occurrence within a row goes too, unless it overlaps the first.  Of a passage, parts of words at its edges stay.
    Columns named n_removed or removed are replaced.  An empty table gives none.
    """
    keep = [c for c in docs.columns if c.lower() not in ("n_removed", "removed")]
    base, row = common.numbered(docs.select(*map(common.col, keep)), F.coalesce(common.as_long(docs, "doc_id"), F.lit(_LAST)), "substring-rows")
    held = base.select(F.col(row).alias("_row"), "text")

    digests = common.cut(held.filter("text <> ''").select("_row", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2")), "text-digests")
    texts = common.cut(digests.groupBy("h1", "h2").agg(F.min("_row").alias("first"), F.count("*").alias("n")).filter("n > 1"), "equal-texts")
    copies = common.cut(common.join_counted(digests, texts, ["h1", "h2"], "n").filter("_row <> first").select("_row"), "text-copies")
    own = common.anti(held, F.col("_row"), copies)

    table = common.cut(stretch_table(own, min_run, words), "stretches")
    often = table.groupBy("digest").agg(F.min("_row").alias("first"), F.count("*").alias("n"), (F.min("stretch") != F.max("stretch")).alias("several")).filter("n > 1")
    shared = common.cut(common.join_counted(table, common.cut(often, "often"), ["digest"], "n").drop("n").filter("several or again or _row <> first"), "shared-stretches")
    several = shared.filter("several").drop("first")
    heads = common.cut(several.groupBy("digest", "stretch").agg(F.min("_row").alias("first"), F.count("*").alias("n")), "heads")
    headed = common.join_counted(several, heads, ["digest", "stretch"], "n")
    resolved = shared.filter("not several").select("_row", "digest", "span", "first").union(headed.select("_row", "digest", "span", "first"))
    resolved = common.cut(resolved.select("_row", "digest", "span", (F.col("_row") != F.col("first")).alias("later")), "resolved-stretches")

    left = common.cut(resolved.filter("not later").groupBy(F.col("_row").alias("_of")).agg(F.collect_list("digest").alias("_shared")), "shingles-left")
    maybe, _ = common.split(held, F.col("_row"), left.select("_of"))
    found = common.cut(passage_table(maybe.join(left, F.col("_row") == F.col("_of")), min_run, words), "passages")
    known = found.filter("h1 is not null")
    first = known.groupBy("h1", "h2").agg(F.min("_row").alias("first"), F.max("_row").alias("most"), F.count("*").alias("n")).filter("most <> first").drop("most")
    later = common.join_counted(known, common.cut(first, "first-passages"), ["h1", "h2"], "n").filter("_row <> first").select("_row", "span").union(found.filter("h1 is null").select("_row", "span"))
    later = later.union(resolved.filter("later").select("_row", "span"))
    spans = later.groupBy("_row").agg(F.collect_list("span").alias("_spans")).union(copies.select("_row", F.array(F.lit(-1).cast("long"))))
    of, which = common.fresh(base, "_of"), common.fresh(base, "_spans")
    spans = common.cut(spans.select(F.col("_row").alias(of), F.col("_spans").alias(which)), "repeated-spans")

    maybe, others = common.split(base, F.col(row), spans.select(of))
    columns = list(map(common.col, keep))
    joined = maybe.join(spans, F.col(row) == F.col(of), "left").select(*columns, which).union(others.select(*columns, F.lit(None).cast("array<long>")))
    at = keep.index(common.named(keep, "text"))
    schema = common.with_field(docs.select(*columns).schema, "n_removed", "long")
    schema = common.with_field(schema, "removed", "array<struct<start:bigint,`end`:bigint>>")
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = [], []
        later = b.column(len(keep))
        for i, t in enumerate(b.column(at).to_pylist()):
            cut: list[tuple[int, int]] = []
            if t and later[i].is_valid:
                values = later[i].values.to_numpy()
                if values[0] >= 0:
                    cut = joined_spans(values)
                elif is_passage(t, min_run, words):
                    cut = [(0, len(t))]
                edges = [0, *(x for s in cut for x in s), len(t)]
                t = "".join(t[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2))
            texts.append(t)
            spans.append([{"start": s, "end": e} for s, e in cut])
        columns = [pa.array(texts, pa.string()) if j == at else b.column(j) for j in range(len(keep))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([sum(x["end"] - x["start"] for x in s) for s in spans], pa.int64()), pa.array(spans, spans_type)], names=[*keep, "n_removed", "removed"])

    return common.map_arrow(joined, run, schema, rows=500)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_removed", "removed", "text")
