"""Document fingerprints: I-Match with several randomised lexicon subsets.

Terms whose inverse document frequency lies in a chosen band are kept; a text's
distinct kept terms, sorted, are hashed once as a whole and once for each of several random
subsets of the lexicon.  A hash folds the terms' own hashes by a sum, so that their order and repetitions don't matter: that is what sorting them is
for.  The subsets take an 8th, a 16th and so on to a 512th of the lexicon, so that texts of any length have
subsets with one or two of their terms, which tell how many terms two texts share; a larger one differs by any term.  The likeness of two fingerprints is the share
of equal hashes among those that either text has, in the subsets of the rates that suit them.

Document frequencies are counted over all documents in a count-min sketch, two rows of 2**18 hashed terms, so
what the driver collects and broadcasts has a fixed size at any size of corpus.
A term's count is the least of its two, so a rare term counts as a frequent one only if it shares a bucket with one in both rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common
from inkmill.llm.wordhash import BLOCK_CHARS, blocks, distinct_in_groups, mix, words_of

BUCKETS = 1 << 18
SKETCH_ROWS = 2
#: The band: terms in 5 % of the documents at most, and in 0.04 % at least.
IDF_LOW, IDF_HIGH = 3.0, 7.8
#: Bits of a hash that must be 0 for a term to be in a subset, and subsets of each kind.
RATES = (3, 4, 5, 6, 7, 8, 9)
REPEATS = 12
HASHES = 1 + len(RATES) * REPEATS
#: Characters that one unit of the pass over neighbours holds on average, while there are at most so many units.
UNIT_CHARS = 24_000_000
MAX_UNITS = 1 << 14
#: Rows for each unit, on average, that tell where units end.
SAMPLE = 16


def sketch_places(terms: np.ndarray) -> np.ndarray:
    """Buckets of the terms in each row of the sketch (rows x terms)."""
    return np.stack([mix(terms ^ np.uint64(0xC2B2AE3D27D4EB4F * r & 0xFFFFFFFFFFFFFFFF)) % np.uint64(BUCKETS) + np.uint64(r * BUCKETS) for r in range(SKETCH_ROWS)]).astype(np.int64)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """The sketch of how many documents have each term (rows x buckets), and how many documents there are."""
    size = SKETCH_ROWS * BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size + 1, np.int64)  # the last counts documents
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                texts = b.column(0).slice(at, 1000).to_pylist()
                held[size] += len(texts)
                for lo, hi in blocks(texts):
                    terms = distinct_in_groups(*words_of(texts[lo:hi]))[0]
                    held[:size] += np.bincount(sketch_places(terms).reshape(-1), minlength=size)
        full = np.flatnonzero(held)
        if len(full):
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(held[full])], names=["bucket", "n"])

    got = common.small_batches(docs).select(text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out[:size].reshape(SKETCH_ROWS, BUCKETS), int(out[size])


@dataclass
class Lexicon:
    """Which terms are in the band: by sketch bucket, whether its count is not too small, and not too large."""

    enough: np.ndarray
    few: np.ndarray

    @classmethod
    def of(cls, sketch: np.ndarray, n: int, low: float = IDF_LOW, high: float = IDF_HIGH) -> Lexicon:
        idf = np.log(max(1, n) / np.maximum(sketch.reshape(-1), 1))
        return cls((sketch.reshape(-1) > 0) & (idf <= high), idf >= low)

    def has(self, terms: np.ndarray) -> np.ndarray:
        places = sketch_places(terms)
        return self.enough[places].all(0) & self.few[places].any(0)

    def hashes(self, texts: list[str]) -> np.ndarray:
        """(texts x HASHES) 32-bit hashes; 0 where a subset has none of a text's terms.

        The first is of all kept terms; without any, of all words; without words, of the text.
        """
        w, offsets = words_of(texts)
        inside = self.has(w)
        owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
        has = np.zeros(len(texts), bool)
        has[owner[inside]] = True
        use = inside | ~has[owner]
        kept = owner[use]
        terms, at, _ = distinct_in_groups(w[use], np.searchsorted(kept, np.arange(len(texts) + 1)))
        out = np.zeros((len(texts), HASHES), np.uint32)
        full = np.flatnonzero(np.diff(at) > 0)
        if len(full):
            starts = at[full]
            out[full, 0] = _folded(mix(terms), np.ones(len(terms), bool), starts)
            k = 1
            for r, bits in enumerate(RATES):
                for i in range(REPEATS):
                    turn, place = divmod(i, 64 // bits)  # each hash value has the bits of several subsets
                    if not place:
                        value = mix(terms ^ np.uint64(0x51ED2701 + 64 * r + turn))
                    member = (value >> np.uint64(place * bits)) & np.uint64((1 << bits) - 1)
                    out[full, k] = _folded(value * np.uint64(2 * k + 1), member == 0, starts)
                    k += 1
        for i in np.flatnonzero(np.diff(at) == 0):
            out[i, 0] = int.from_bytes(hashlib.blake2b(texts[i].encode("utf-8", "surrogatepass"), digest_size=4).digest(), "big") | 1
        return out


def _folded(values: np.ndarray, member: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """32-bit hash of each run's member values, 0 without any; the runs are of sorted distinct terms."""
    total = np.add.reduceat(np.where(member, values, np.uint64(0)), starts)
    n = np.add.reduceat(member.astype(np.int64), starts)
    return np.where(n > 0, (mix(total + n.astype(np.uint64)) >> np.uint64(32)) | np.uint64(1), np.uint64(0)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes of subsets among those that either row has, 0 to 1; 1 if the hashes of all terms are equal.

    Of the rates it is those around the sparsest of which either row has half of the subsets at least: the denser ones, or the
    densest for texts of a few terms, hold so many terms that any difference shows, of sparser ones there are too few.
    """
    either, same = (a > 0) | (b > 0), a == b
    shape = (len(a), len(RATES), REPEATS)
    have, equal = either[:, 1:].reshape(shape).sum(2), (same & either)[:, 1:].reshape(shape).sum(2)
    enough = 2 * have >= REPEATS
    best = np.where(enough.any(1), len(RATES) - 1 - np.argmax(enough[:, ::-1], 1), 0)
    near = np.abs(np.arange(len(RATES))[None, :] - best[:, None]) <= 1
    share = (equal * near).sum(1) / np.maximum(1, (have * near).sum(1))
    return np.where(either[:, 0] & same[:, 0], 1.0, share)


def as_text(hashes: np.ndarray) -> list[str]:
    return [h.astype(">u4").tobytes().hex() for h in hashes]


def lexicon_of(docs: DataFrame, low: float = IDF_LOW, high: float = IDF_HIGH) -> Lexicon:
    return Lexicon.of(*document_frequencies(docs), low, high)


def fingerprint(docs: DataFrame, lexicon: Lexicon, column: str = "fingerprint") -> DataFrame:
    """All rows and columns of ``docs`` with the fingerprint of the whole text (null: empty) added.

    A column of that name is replaced; equal texts have equal fingerprints.
    Repeated rows stay; an empty table stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(lexicon)  # 2**20 bytes
    keep = [c for c in docs.columns if c.lower() != column.lower()]
    base = docs.select(*map(common.col, keep))
    at = keep.index(common.named(keep, "text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in b.column(at).to_pylist()]
        out = [x for lo, hi in blocks(texts) for x in as_text(held.value.hashes(texts[lo:hi]))]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*keep, column])

    return common.map_arrow(base, run, common.with_field(base.schema, column, "string"))


def _falling(place: pa.Array, tie: pa.Array) -> np.ndarray:
    """Sortable keys of the order of falling place and rising tie."""
    pair = np.empty((len(place), 2), ">u8")
    pair[:, 0] = ~(place.to_numpy().view(np.uint64) ^ np.uint64(1 << 63))
    pair[:, 1] = tie.to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
    return pair.view("V16").reshape(-1)


def _ranks(cuts: list[bytes], keys: np.ndarray) -> np.ndarray:
    """How many of the sorted ``cuts`` are below each key."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    return np.array([bisect_left(cuts, k.tobytes()) for k in distinct], np.int64)[inverse]


def _units(docs: DataFrame, unit_chars: int = UNIT_CHARS, most: int = MAX_UNITS) -> tuple[DataFrame, int]:
    """Documents dealt to ranges of the order, each with the document that follows its last; and the number of ranges.

    Rows (unit, extra, place, tie, doc_id, text): place is doc_id, the least long for null, and tie a hash of the text, so
    rows without an id are in many units.  ``extra`` rows stand at the
    end of a unit and are the first of the next (after the last: of the first).  A bounded sample tells where units end;
    that balances them only.
    """
    least = -(1 << 63)
    own = docs.select(F.coalesce(common.as_long(docs, "doc_id"), F.lit(least)).alias("place"), common.as_long(docs, "doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.select("place", F.xxhash64("text").alias("tie"), "doc_id", "text")
    chars, rows = own.agg(F.sum(F.length("text")), F.count("*")).first()
    n = max(1, min(most, -(-(chars or 0) // unit_chars)))
    share = min(1 << 62, (SAMPLE * n << 62) // max(1, rows))
    sample = own.select("place", "tie").filter(F.pmod(F.xxhash64("place", "tie"), F.lit(1 << 62)) < share).groupBy("place", "tie").agg(F.count("*").alias("n")).toArrow() if n > 1 else None
    cuts: list[bytes] = []
    if sample is not None and sample.num_rows:
        sample = sample.combine_chunks()
        keys = _falling(sample["place"].chunk(0), sample["tie"].chunk(0))
        order = sorted(range(len(keys)), key=lambda i: keys[i].tobytes())
        reach = np.cumsum(sample["n"].to_numpy()[order])
        ends = np.unique(np.searchsorted(reach, reach[-1] * np.arange(1, n) / n))
        cuts = [keys[order[i]].tobytes() for i in ends]

    def number(b: pa.RecordBatch) -> pa.RecordBatch:
        keys = _falling(b.column(0), b.column(1))
        held: dict[int, bytes] = {}
        for unit, key in zip(_ranks(cuts, keys).tolist(), keys, strict=True):
            key = key.tobytes()
            held[unit] = min(held.get(unit, key), key)
        return pa.RecordBatch.from_arrays([pa.array([*held], pa.int64()), pa.array([*held.values()], pa.binary())], names=["unit", "first"])

    firsts = {r["unit"]: bytes(r["first"]) for r in common.map_arrow(own.select("place", "tie"), number, "unit long, first binary", rows=100_000).groupBy("unit").agg(F.min("first").alias("first")).collect()}
    order = sorted(firsts)
    before = {firsts[u]: order[i - 1] for i, u in enumerate(order)}  # the unit that ends with this row; the first follows the last

    def deal(b: pa.RecordBatch) -> pa.RecordBatch:
        keys = _falling(b.column(0), b.column(1))
        follows = [before.get(k.tobytes(), -1) for k in keys]
        again = np.flatnonzero(np.array(follows, np.int64) >= 0)
        take = pa.array(np.concatenate([np.arange(len(keys)), again]))
        units = np.concatenate([_ranks(cuts, keys), np.array(follows, np.int64)[again]])
        extra = np.concatenate([np.zeros(len(keys), np.int32), np.ones(len(again), np.int32)])
        rest = pa.Table.from_batches([b]).take(take).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([pa.array(units), pa.array(extra), *rest.columns], names=["unit", "extra", "place", "tie", "doc_id", "text"])

    return common.map_arrow(own, deal, "unit long, extra int, place long, tie long, doc_id long, text string"), n


def compare_edits(docs: DataFrame, lexicon: Lexicon, unit_chars: int = UNIT_CHARS) -> DataFrame:
    """Fingerprints of each text and of its edit by the next document, and their likeness.

    The next document is that of the next lower doc_id; after the last comes the first.  The
    edit replaces the last half (floor) of the code points by the first as many, or all,
    of the next document.  Null texts are empty and null doc_ids last; among
    equal doc_ids the order is that of the texts' hashes.  A single document is its own
    next.  Columns: doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next.  An empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    dealt, n = _units(docs, unit_chars)
    dealt = dealt.repartition(n, "unit").sortWithinPartitions("unit", "extra", F.desc("place"), "tie", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def emit(rows: list[tuple], texts: list[str]) -> pa.RecordBatch:
        """Rows of all texts but the last, which is only a next one."""
        edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, texts[1:], strict=False)]
        own = held.value.hashes(texts)
        new = held.value.hashes(edited)
        columns = [[r[0] for r in rows], [len(t) for t in texts[:-1]], edited, as_text(own[:-1]), as_text(new), likeness(own[:-1], new), likeness(own[:-1], own[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        texts: list[str] = []
        size, unit, over = 0, None, False
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                for u, extra, doc_id, text in zip(*(part.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                    if u != unit:
                        rows, texts, size, unit, over = [], [], 0, u, False
                    if over:
                        continue
                    texts.append(text)
                    size += len(text)
                    if rows and (extra or size > BLOCK_CHARS):
                        yield emit(rows, texts)
                        rows, texts, size = [], [text], len(text)
                    over = bool(extra)
                    rows.append((doc_id,))

    return common.small_batches(dealt).select("unit", "extra", "place", "doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = compare_edits(docs, lexicon_of(docs))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
