"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a text are the hashed words it has (log counts, scaled to length
one), about a dozen statistics of its structure, and the length that the table
states beside the text.  The score is a logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2]

whose last term holds all pairwise interactions in time linear in the features.
The model is fitted on the driver from a bounded sample of labelled rows
(``max_rows``, rows of the lowest id hashes) and broadcast; its size is fixed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common
from inkmill.llm.wordhash import blocks, code_points, distinct_in_groups, words_of

BUCKETS = 1 << 15
RANK = 8
MAX_ROWS = 8_000
THRESHOLD = 0.7
STATS = ("chars", "words", "word_length", "upper", "digit", "symbol", "line_words", "line_end", "line_repeats", "word_variety", "long_words", "stated_chars", "stated_differs")


def statistics(text: str, n_words: int, n_distinct: int, stated: int | None) -> list[float]:
    """Structure statistics and metadata of one text, each about 0 to 1; all defined for an empty text."""
    n = len(text)
    if n:
        # Classes of all characters at once; ASCII classes and all letters above are enough here.
        c = code_points(text)
        upper = np.count_nonzero((c >= 65) & (c <= 90))
        letter = upper + np.count_nonzero(((c >= 97) & (c <= 122)) | (c >= 0xC0))
        digit = np.count_nonzero((c >= 48) & (c <= 57))
        space = np.count_nonzero(c <= 32)
    else:
        upper = letter = digit = space = 0
    solid = max(1, n - space)
    symbol = n - space - letter - digit
    lines = [x for x in (x.strip() for x in text.split("\n")) if x]
    k = max(1, len(lines))
    ends = sum(x[-1] in ".!?:;\"')" for x in lines)
    return [
        np.log1p(n) / 12,
        np.log1p(n_words) / 10,
        min(2.0, letter / max(1, n_words) / 10),
        upper / max(1, letter),
        digit / solid,
        min(1.0, symbol / solid * 3),
        np.log1p(n_words / k) / 6,
        ends / k,
        1 - len(set(lines)) / k,
        n_distinct / max(1, n_words),
        min(2.0, n_distinct / max(1.0, np.sqrt(n_words)) / 20),
        0.0 if stated is None else np.log1p(max(0, stated)) / 12,
        float(stated is None or stated != n),
    ]


def features(texts: list[str | None], stated: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words as bucket, value and offset arrays, and the dense statistics."""
    words, offsets = words_of(texts)
    bucket, at, counts = distinct_in_groups(words % np.uint64(BUCKETS), offsets)
    value = np.log1p(counts)
    n = np.diff(at)
    norm = np.sqrt(np.add.reduceat(np.concatenate([value**2, [0.0]]), at[:-1]) * (n > 0))
    value = value / np.repeat(np.maximum(norm, 1e-9), n)
    dense = np.array([statistics(t or "", int(w), int(d), s) for t, w, d, s in zip(texts, np.diff(offsets), n, stated, strict=True)])
    return bucket.astype(np.int32), value.astype(np.float32), at, dense.reshape(len(texts), len(STATS)).astype(np.float32)


def _sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows between offsets; 0 for an empty range."""
    if not len(x):
        return np.zeros((len(at) - 1, *x.shape[1:]), x.dtype)
    c = np.concatenate([x, np.zeros((1, *x.shape[1:]), x.dtype)])
    out = np.add.reduceat(c, at[:-1], axis=0)
    out[np.diff(at) == 0] = 0
    return out


@dataclass
class FactorisationMachine:
    """Weights of the buckets and, after them, of the statistics."""

    rank: int = RANK
    w0: float = 0.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + len(STATS), np.float32))
    v: np.ndarray | None = None
    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(STATS), np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(STATS), np.float32))

    def _parts(self, bucket, value, at, dense):
        vx = self.v[bucket] * value[:, None]
        dv = self.v[BUCKETS:]
        s = _sums(vx, at) + dense @ dv
        q = _sums(vx**2, at) + dense**2 @ dv**2
        linear = _sums(self.w[bucket] * value, at) + dense @ self.w[BUCKETS:]
        return self.w0 + linear + 0.5 * (s**2 - q).sum(1), s

    def score(self, bucket, value, at, dense) -> np.ndarray:
        z, _ = self._parts(bucket, value, at, np.clip((dense - self.mean) / self.scale, -4, 4))
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def fit(self, bucket, value, at, dense, y, epochs: int = 6, batch: int = 256, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = dense.mean(0), np.maximum(dense.std(0), 1e-3)
        dense = np.clip((dense - self.mean) / self.scale, -4, 4)
        self.v = rng.normal(0, 0.02, (BUCKETS + len(STATS), self.rank)).astype(np.float32)
        self.w0 = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        gw, gv, g0 = np.full(self.w.shape, 1e-6, np.float32), np.full(self.v.shape, 1e-6, np.float32), 1e-6
        n = np.diff(at)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for lo in range(0, len(order), batch):
                rows = order[lo : lo + batch]
                take = np.concatenate([np.arange(at[r], at[r + 1]) for r in rows]) if len(rows) else np.empty(0, int)
                b, x, d = bucket[take], value[take], dense[rows]
                o = np.concatenate([[0], np.cumsum(n[rows])])
                z, s = self._parts(b, x, o, d)
                e = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)).astype(np.float32)
                er = np.repeat(e, n[rows])
                sr = np.repeat(s, n[rows], axis=0)
                # Gradients by parameter: adagrad on what the batch touches.
                u, inverse = np.unique(b, return_inverse=True)
                dw, dv = np.zeros(len(u), np.float32), np.zeros((len(u), self.rank), np.float32)
                np.add.at(dw, inverse, er * x)
                np.add.at(dv, inverse, (er * x)[:, None] * (sr - self.v[b] * x[:, None]))
                dw += decay * self.w[u]
                dv += decay * self.v[u]
                gw[u] += dw**2
                gv[u] += dv**2
                self.w[u] -= rate * dw / np.sqrt(gw[u])
                self.v[u] -= rate * dv / np.sqrt(gv[u])
                t = slice(BUCKETS, None)
                dw = e @ d + decay * self.w[t]
                dv = d.T @ (e[:, None] * s) - (e @ d**2)[:, None] * self.v[t] + decay * self.v[t]
                gw[t] += dw**2
                gv[t] += dv**2
                self.w[t] -= 2 * rate * dw / np.sqrt(gw[t])
                self.v[t] -= rate * dv / np.sqrt(gv[t])
                g0 += float(e.sum()) ** 2
                self.w0 -= rate * float(e.sum()) / np.sqrt(g0)
        return self


def _stated(docs: DataFrame) -> Column:
    """The stated length; null without a column of that name, and for what is no number."""
    return common.as_long(docs, "n_chars") if "n_chars" in (c.lower() for c in docs.columns) else F.lit(None).cast("long")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> FactorisationMachine:
    """Fit on labelled documents whose crc32(doc_id) mod 4 is not 2.

    At most about ``max_rows`` labelled ids are taken, those with the lowest hashes of
    doc_id; the sample is so bounded, and so is what the driver collects.  An id that is labelled several times counts
    once, by its higher label; one with several texts by the least of them.  Without
    any usable label the model is the constant 0.5.
    """
    known = labels.select(common.as_long(labels, "doc_id").alias("_id"), common.as_long(labels, "quality").cast("int").alias("_y")).filter("_id is not null and _y in (0, 1)").filter(common.remainder("_id", 4) != 2)
    known = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    n = known.count()
    if n > max_rows:
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 62)) < (max_rows << 62) // n)
    texts = docs.select(common.as_long(docs, "doc_id").alias("_id"), "text", _stated(docs).alias("stated"))
    rows = texts.join(F.broadcast(known), "_id")  # bounded by max_rows
    rows = rows.groupBy("_id", "_y").agg(F.min(F.struct("text", "stated")).alias("r")).select("r.text", "r.stated", "_y")

    def extract(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, stated = b.column(0).to_pylist(), b.column(1).to_pylist()
        out = {"bucket": [], "value": [], "dense": []}
        for lo, hi in blocks(texts):
            bucket, value, at, dense = features(texts[lo:hi], stated[lo:hi])
            for i in range(hi - lo):
                out["bucket"].append(bucket[at[i] : at[i + 1]].tobytes())
                out["value"].append(value[at[i] : at[i + 1]].tobytes())
                out["dense"].append(dense[i].tobytes())
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.binary()) for c in out.values()), b.column(2).cast(pa.int32())], names=["bucket", "value", "dense", "y"])

    got = common.map_arrow(rows, extract, "bucket binary, value binary, dense binary, y int").toArrow()
    model = FactorisationMachine()
    model.v = np.zeros((BUCKETS + len(STATS), model.rank), np.float32)
    if not got.num_rows:
        return model
    got = got.sort_by([("dense", "ascending"), ("y", "ascending")])  # any order of tasks gives one model
    bucket = [np.frombuffer(x, np.int32) for x in got["bucket"].to_pylist()]
    at = np.concatenate([[0], np.cumsum([len(x) for x in bucket])])
    value = np.concatenate([np.frombuffer(x, np.float32) for x in got["value"].to_pylist()])
    dense = np.stack([np.frombuffer(x, np.float32) for x in got["dense"].to_pylist()])
    return model.fit(np.concatenate(bucket), value, at, dense, got["y"].to_numpy().astype(np.float32))


def score(docs: DataFrame, model: FactorisationMachine, column: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the score of the whole text (null: empty) added.

    A column of that name is replaced.  Repeated rows stay; an empty table stays
    empty; a table without ``n_chars`` is scored as one whose lengths are unknown.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c.lower() != column.lower()]
    base = docs.select(*map(common.col, keep))
    schema, at = common.with_field(base.schema, column, "double"), keep.index(common.named(keep, "text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, lengths = b.column(at).to_pylist(), b.column(len(keep)).to_pylist()
        out = [held.value.score(*features(texts[lo:hi], lengths[lo:hi])) for lo, hi in blocks(texts)]
        return pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.concatenate(out), pa.float64())], names=[*keep, column])

    return common.map_arrow(base.select(*map(common.col, keep), _stated(base).alias(common.fresh(base, "_stated"))), run, schema)


def accept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """Documents that the classifier keeps, with their columns, whatever their names; null texts are scored as empty ones."""
    column = common.fresh(docs, "_quality")
    return score(docs, train(docs, labels, max_rows), column).filter(F.col(column) >= threshold).select(*map(common.col, docs.columns))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = score(docs, train(docs, common.table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(common.remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
