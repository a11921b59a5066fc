"""Mergeable Greenwald-Khanna quantile summaries of weighted values, and the exact ranks of what they answer.

A summary is a row with the arrays v, g, d and e, by ascending distinct values v.  Of n values, at least g[0] + ... + g[i] are <= v[i], and at
most d[i] more; e[i] of them are known to be equal to v[i].  (e is what the usual tuples lack: without it, values that repeat, or a
merge of exact summaries, would count as uncertain.)  The summary has the error eps if g[i] - e[i] + d[i] <= 2 * eps * n for all i.

1. Rows are counted by key and value, so that no key's rows meet.  Each partition, sorted, makes a summary of each of its keys.
2. Summaries of a key are merged, at most FAN partitions' at a time, level by level, then those of the batches of a group. A value's
   bounds are its own summary's plus those of the other ones around it, so deltas grow by what the others leave open.
3. Beyond POINTS values a summary is compressed: a value goes into the next one if both stay within the error and its band, by its
   delta, is not higher.  Partitions, each level and the whole get equal shares of the error.
4. Exact ranks: answers and targets meet the counted rows of their group, are looked up by ``searchsorted`` and counted.  Only of groups with more than
   1/HOT of the rows, fewer than HOT, is anything broadcast: the cuts of their values into ranges, fewer than 2 * HOT in all.  Others are shuffled, as their number grows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkmill.llm import common

BATCHES = 16
WHOLE = -1
STEPS = 20
#: Least values of a summary that is asked.
LEAST = 20
EPS = 0.01
#: Values of a summary that is not compressed; and into how many, at least, a longer one is.
POINTS = 1024
KEEP = 256
#: Partitions whose summaries are merged at a time.
FAN = 16
HOT = 4096
#: Share of the error that is given out; the rest is for rounding.
GIVEN = 0.9
#: Sorted rows that a partition summarises at a time.
RUN_ROWS = 1 << 17
#: Rows that are looked up at a time, about: whole units.
LOOKUP_ROWS = 1 << 18

Summary = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_ARRAYS = ("v", "g", "d", "e")


def bands(d: np.ndarray, width: int) -> np.ndarray:
    """Band of each delta: 0 for those near ``width``, the newest, and higher ones, twice as wide each, for older."""
    left = np.maximum(width - d, 0)
    return np.where(left > 0, np.floor(np.log2(np.maximum(left, 1))).astype(np.int64) + 1, 0)


def _absorb(s: Summary, width: int, most: int, by_band: bool) -> Summary:
    v, g, d, e = (x.tolist() for x in s)
    band = bands(s[2], width).tolist()
    at = len(v) - 1
    heads, weights, taken = [at], [g[at]], 1
    for i in range(at - 1, -1, -1):
        if i and taken < most and g[i] + weights[-1] - e[at] + d[at] <= width and not (by_band and band[i] > band[at]):
            weights[-1] += g[i]
            taken += 1
        else:
            at = i
            heads.append(i)
            weights.append(g[i])
            taken = 1
    index = np.array(heads[::-1])
    return s[0][index], np.array(weights[::-1], np.int64), s[2][index], s[3][index]


def compress(s: Summary, error: float) -> Summary:
    """``s`` with the error ``error``, if it had a smaller one, in at most POINTS values or 1 / (share of the error) + 2 * KEEP.

    Values go into the next one by bands first; if too many are left, by weight alone.  The least and the greatest stay.
    None takes more than a KEEP-th of all, so at least KEEP/2 are left, whatever their weights.
    """
    if len(s[0]) <= POINTS:
        return s
    width = int(2 * error * int(s[1].sum()))
    most = max(2, -(-len(s[0]) // KEEP))
    out = _absorb(s, width, most, True)
    return out if len(out[0]) <= POINTS else _absorb(out, width, max(2, -(-len(out[0]) // KEEP)), False)


def merge(summaries: list[Summary]) -> Summary:
    """Of all values: bounds of a value are the sums of its bounds in every summary."""
    v = np.unique(np.concatenate([s[0] for s in summaries]))
    low, high, equal = (np.zeros(len(v), np.int64) for _ in range(3))
    for sv, g, d, e in summaries:
        rank = np.cumsum(g)
        at = np.searchsorted(sv, v, "right")  # how many of this summary's values are <= each
        own = np.zeros(len(v), bool)
        own[np.searchsorted(v, sv)] = True
        under = np.concatenate([[0], rank])[at]
        below_next = np.append(rank + d - e, rank[-1])[at]  # at most so many are less than its next value
        low += under
        high += np.where(own, under + np.append(0, d)[at], np.maximum(below_next, under))
        equal += np.where(own, np.append(0, e)[at], 0)
    return v, np.diff(low, prepend=0), high - low, equal


def query(s: Summary, targets: np.ndarray) -> np.ndarray:
    """For each rank the value whose rank is, at worst, nearest; values don't fall as ranks rise."""
    v, g, d, e = s
    upto = np.cumsum(g)
    first = np.minimum.accumulate((upto + d - e + 1)[::-1])[::-1]
    worst = np.maximum(first[None, :] - targets[:, None], targets[:, None] - upto[None, :])
    return v[np.argmin(worst, 1)]


def _starts(columns: list[pa.Array]) -> np.ndarray:
    """Where the keys of sorted rows change, 0 first."""
    n = len(columns[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for c in columns:
        if n > 1:
            change[1:] |= np.asarray(pc.fill_null(pc.not_equal(c[1:], c[:-1]), True))
    return np.flatnonzero(change)


def _column(t: pa.Table, i: int) -> pa.Array:
    c = t.column(i)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows, but for the last."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: int, rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about ``rows`` rows that end where a key ends, and where their keys start."""
    rest: pa.Table | None = None
    for t in _chunks(batches, rows):
        t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        starts = _starts([_column(t, i) for i in range(keys)])
        if len(starts) > 1:
            yield t.slice(0, starts[-1]), starts[:-1]
        rest = t.slice(starts[-1])
    if rest is not None:
        yield rest, np.zeros(1, np.int64)


def _lists(parts: list[np.ndarray], sizes: list[int]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int64)))


def _rows(keys: list[pa.Array], index: list[int], made: list[Summary], extra: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    """A row for each summary, with the keys of the rows ``index``."""
    sizes = [len(s[0]) for s in made]
    own = [k.take(pa.array(index)) for k in keys]
    arrays = [_lists([s[x] for s in made], sizes) for x in range(4)]
    more = extra or {}
    return pa.RecordBatch.from_arrays([*own, *more.values(), *arrays], names=[*(f"k{i}" for i in range(len(own))), *more, *_ARRAYS])


def _build(counted: DataFrame, keys: list[str], error: float) -> DataFrame:
    """Summaries (keys, part, v, g, d, e) of each partition of rows (keys, x, c).

    A key is summarised RUN_ROWS rows at a time, within half of the error; a partition's summaries of a key are then merged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), len(keys)
        open_key: list[pa.Array] | None = None  # the last key, which may go on
        held: list[Summary] = []

        def rows(own: list[pa.Array], index: list[int], made: list[Summary]) -> pa.RecordBatch:
            return _rows(own, index, made, {"part": pa.array(np.full(len(made), part, np.int32))})

        def closed() -> Iterator[pa.RecordBatch]:
            if held:
                yield rows(open_key, [0], [compress(merge(held), error) if len(held) > 1 else held[0]])
                held.clear()

        for t in _chunks(batches, RUN_ROWS):
            own = [_column(t, i) for i in range(k)]
            x, c = (_column(t, k + i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
            starts = _starts(own).tolist()
            made = [compress((x[lo:hi], c[lo:hi], np.zeros(hi - lo, np.int64), c[lo:hi]), error / 2) for lo, hi in zip(starts, [*starts[1:], len(x)])]
            if open_key is None or any(a[0] != o[0] for a, o in zip(own, open_key)):
                yield from closed()
            held.append(made[0])
            if len(made) > 1:
                open_key = open_key if len(held) > 1 else [a.slice(0, 1) for a in own]
                yield from closed()
                if len(made) > 2:
                    yield rows(own, starts[1:-1], made[1:-1])
                held.append(made[-1])
            open_key = [a.slice(starts[-1], 1) for a in own]
        yield from closed()
        common.release()

    plain = counted.select(*map(common.col, keys), "x", "c").sortWithinPartitions(*map(common.col, keys), "x")
    return _mapped(plain, run, keys, "part int, ")


def _mapped(df: DataFrame, run: Callable, keys: list[str], more: str = "") -> DataFrame:
    kinds = [f.dataType.simpleString() for f in df.select(*map(common.col, keys)).schema.fields]
    schema = ", ".join(f"k{i} {t}" for i, t in enumerate(kinds)) + f", {more}" + ", ".join(f"{a} array<bigint>" for a in _ARRAYS)
    out = common.small_batches(df).mapInArrow(run, schema)
    return out.toDF(*keys, *out.columns[len(keys) :])


def _merged(summaries: DataFrame, keys: list[str], error: float) -> DataFrame:
    """(keys, v, g, d, e): one summary of those of each key, with the error ``error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(keys)
        for t, starts in _whole_runs(batches, k, 1):
            own = [_column(t, i) for i in range(k)]
            lists = [_column(t, k + i) for i in range(4)]
            offsets = lists[0].offsets.to_numpy().astype(np.int64)
            v, g, d, e = (a.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] for a in lists)
            offsets = offsets - offsets[0]
            edges = offsets[np.append(starts, t.num_rows)]
            of = np.repeat(np.arange(len(starts)), np.diff(edges))
            open_keys = np.zeros(len(starts), bool)
            open_keys[of[(d != 0) | (g != e)]] = True
            made: dict[int, Summary] = {}
            for key in np.flatnonzero(open_keys).tolist():
                first, last = starts[key], starts[key + 1] if key + 1 < len(starts) else t.num_rows
                each = [tuple(a[offsets[r] : offsets[r + 1]] for a in (v, g, d, e)) for r in range(first, last)]
                made[key] = compress(merge(each), error) if len(each) > 1 else each[0]
            # all others are exact: their values are counted together
            plain = ~open_keys[of]
            order = np.lexsort((v[plain], of[plain]))
            pv, po, pe = v[plain][order], of[plain][order], e[plain][order]
            if len(pv):
                new = np.flatnonzero(np.append(True, (pv[1:] != pv[:-1]) | (po[1:] != po[:-1])))
                pv, po, pe = pv[new], po[new], np.add.reduceat(pe, new)
                ends = np.searchsorted(po, np.arange(len(starts) + 1))
                for key in np.flatnonzero((np.diff(ends) > POINTS) & ~open_keys).tolist():
                    lo, hi = ends[key], ends[key + 1]
                    made[key] = compress((pv[lo:hi], pe[lo:hi], np.zeros(hi - lo, np.int64), pe[lo:hi]), error)
                short = np.setdiff1d(np.flatnonzero(np.diff(ends)), np.fromiter(made, int, len(made)), assume_unique=True)
                if len(short):
                    use = np.isin(po, short)
                    sizes = np.diff(ends)[short].tolist()
                    arrays = [_lists([x[use]], sizes) for x in (pv, pe, np.zeros(len(pv), np.int64), pe)]
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(starts[short])) for c in own), *arrays], names=[*(f"k{i}" for i in range(k)), *_ARRAYS])
            if made:
                yield _rows(own, starts[list(made)].tolist(), list(made.values()))
        common.release()

    held = summaries.select(*map(common.col, keys), *_ARRAYS)
    return _mapped(held.repartition(*map(common.col, keys)).sortWithinPartitions(*map(common.col, keys)), run, keys)


def levels(partitions: int) -> int:
    """Merges, of FAN at a time, until one summary of a key is left."""
    n = 1
    while FAN**n < partitions:
        n += 1
    return n


def summarise(counted: DataFrame, groups: list[str], batch: str, eps: float = EPS) -> DataFrame:
    """(groups, batch, v, g, d, e): a summary of each batch of each group, and of each group's batches, with the batch WHOLE.

    ``counted`` has a row (groups, batch, x long, c long) for each distinct x of a batch; it should be a table.  All errors are below ``eps``.
    """
    keys = [*groups, batch]
    partitions = counted.rdd.getNumPartitions()
    n = levels(partitions)
    share = eps * GIVEN / (n + 2)
    now = _build(counted, keys, share)
    for level in range(1, n):
        now = _merged(now.withColumn("part", F.floor(F.col("part") / FAN).cast("int")), [*keys, "part"], share * (1 + level))
    batches = common.cut(_merged(now, keys, share * (1 + n)), "summaries")
    whole = _merged(batches, groups, share * (2 + n))
    return batches.unionByName(whole.withColumn(batch, F.lit(WHOLE).cast(batches.schema[batch].dataType)))


def ask(summaries: DataFrame, keys: list[str], steps: int = STEPS, least: int = LEAST) -> DataFrame:
    """(keys, i, n, target, points, answer): the ranks ceil(i*n/steps), 0 < i < steps, of each summary of at least ``least`` values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(keys)
        for b in batches:
            lists = [b.column(k + i) for i in range(4)]
            offsets = lists[0].offsets.to_numpy()
            flat = [a.values.to_numpy(zero_copy_only=False) for a in lists]
            index, numbers = [], []
            i = np.arange(1, steps)
            total = np.diff(np.concatenate([[0], np.cumsum(flat[1])])[offsets])
            for r in np.flatnonzero(total >= least).tolist():
                s = tuple(f[offsets[r] : offsets[r + 1]] for f in flat)
                target = -(-i * total[r] // steps)
                index.append(r)
                numbers.append(np.stack([i, np.full(steps - 1, total[r]), target, np.full(steps - 1, len(s[0])), query(s, target)]))
            if index:
                got = np.concatenate(numbers, 1)
                own = [b.column(x).take(pa.array(np.repeat(index, steps - 1))) for x in range(k)]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, got.astype(np.int64))], names=[*(f"k{x}" for x in range(k)), "i", "n", "target", "points", "answer"])

    held = common.small_batches(summaries.select(*map(common.col, keys), *_ARRAYS))
    kinds = [f.dataType.simpleString() for f in held.schema.fields[: len(keys)]]
    out = held.mapInArrow(run, ", ".join(f"k{i} {t}" for i, t in enumerate(kinds)) + ", i long, n long, target long, points long, answer long")
    return out.toDF(*keys, *out.columns[len(keys) :])


def lookup(unit: np.ndarray, x: np.ndarray, c: np.ndarray, asked: np.ndarray, target: np.ndarray, answer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For questions to the units ``asked``: the target-th least x, and how many are < and <= the answer.

    Rows (unit, x, c) are sorted by unit and x.  A target beyond a unit's rows gets some value of another one.
    """
    upto = np.cumsum(c)
    start = np.concatenate([[0], upto])[np.searchsorted(unit, asked, "left")]
    exact = x[np.minimum(np.searchsorted(upto, start + target, "left"), len(x) - 1)]
    codes, code = np.unique(np.concatenate([x, answer]), return_inverse=True)
    key = unit * len(codes) + code[: len(x)]
    wanted = asked * len(codes) + code[len(x) :]
    ranks = np.concatenate([[0], upto])
    return exact, ranks[np.searchsorted(key, wanted, "left")] - start, ranks[np.searchsorted(key, wanted, "right")] - start


def _ranked(mixed: DataFrame, keys: int) -> DataFrame:
    """Rows and questions (keys, r, b, x, c, i, n, target, points, answer, before, which), sorted by (keys, r, x), to the questions with exact, below, upto.

    Rows of batch b have no i; questions to all batches have the batch WHOLE.
    """
    kinds = [f.dataType.simpleString() for f in mixed.schema.fields[:keys]]
    names = [f"k{i}" for i in range(keys)]
    numbers = ["b", "i", "n", "target", "points", "answer", "before", "which"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _whole_runs(batches, keys + 1, LOOKUP_ROWS):
            unit = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, t.num_rows)))
            held = {n: _column(t, keys + 1 + j) for j, n in enumerate(["b", "x", "c", *numbers[1:]])}
            asks = np.asarray(pc.is_valid(held["i"]))
            if not asks.any() or asks.all():
                continue
            q = np.flatnonzero(asks)
            rows = np.flatnonzero(~asks)
            get = lambda n, at: held[n].take(pa.array(at)).to_numpy(zero_copy_only=False).astype(np.int64)
            b, x, c, unit_rows = get("b", rows), get("x", rows), get("c", rows), unit[rows]
            qb, target, answer, before = (get(n, q) for n in ("b", "target", "answer", "before"))
            exact, below, upto = (np.zeros(len(q), np.int64) for _ in range(3))
            whole = qb == WHOLE
            if whole.any():
                exact[whole], below[whole], upto[whole] = lookup(unit_rows, x, c, unit[q][whole], (target - before)[whole], answer[whole])
            if not whole.all():
                own, width = unit[q][~whole], int(max(b.max(), qb.max())) + 1
                wanted = np.unique(own * width + qb[~whole])
                at = unit_rows * width + b
                chosen = np.flatnonzero(np.isin(at, wanted))
                order = chosen[np.argsort(at[chosen], kind="stable")]
                if len(order):
                    exact[~whole], below[~whole], upto[~whole] = lookup(at[order], x[order], c[order], own * width + qb[~whole], (target - before)[~whole], answer[~whole])
            keyed = [_column(t, j).take(pa.array(q)) for j in range(keys)]
            out = [pa.array(get(n, q)) for n in numbers]
            yield pa.RecordBatch.from_arrays([*keyed, *out, *map(pa.array, (exact, below + before, upto + before))], names=[*names, *numbers, "exact", "below", "upto"])
        common.release()

    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds)) + "".join(f", {n} long" for n in [*numbers, "exact", "below", "upto"])
    return common.small_batches(mixed).mapInArrow(run, schema)


def exact_ranks(counted: DataFrame, summaries: DataFrame, questions: DataFrame, groups: list[str], batch: str, hot: int = HOT) -> DataFrame:
    """``questions`` of ``ask`` with exact_x, the target-th least x, and n_below and n_upto, how many are < and <= the answer.

    All three inputs should be tables.  Hot groups' rows are cut into ranges of x, at values of their summaries; the counts
    of the ranges below are added.
    """
    keys = [f"_k{i}" for i in range(len(groups))]
    named = lambda df: df.select(*(common.col(g).alias(k) for g, k in zip(groups, keys)), *(c for c in df.columns if c not in groups and c != batch), F.col(f"`{batch}`").cast("long").alias("b"))
    rows, points, asked = named(counted), named(summaries), named(questions)
    total = rows.count()
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > total / hot)
    cuts = F.ceil(F.col("rows") * hot / F.lit(max(1, total)))
    wide = points.filter(F.col("b") == WHOLE).join(F.broadcast(sizes), keys).filter(cuts > 1)
    at = F.transform(F.sequence(F.lit(1), cuts - 1), lambda j: F.get("v", F.floor(j * F.size("v") / cuts).cast("int")))
    bounds = common.cut(wide.select(*keys, F.array_distinct(at).alias("bounds")), "bounds")
    place = lambda x: F.coalesce(F.size(F.filter("bounds", lambda v: v < x)), F.lit(0)).cast("long")
    ranged = rows.join(F.broadcast(bounds), keys, "left").withColumn("r", F.when(F.col("bounds").isNull(), F.lit(0)).otherwise(place(F.col("x"))).cast("long"))
    split = ranged.filter("bounds is not null").groupBy(*keys, "b", "r").agg(F.sum("c").alias("m"))
    split = common.cut(split, "ranges")
    split = split.unionByName(split.groupBy(*keys, "r").agg(F.sum("m").alias("m")).withColumn("b", F.lit(WHOLE).cast("long")))
    upto = F.sum("m").over(Window.partitionBy(*keys, "b").orderBy("r"))
    offsets = split.select(*keys, "b", "r", (upto - F.col("m")).alias("before"), upto.alias("last"))
    asked = asked.join(F.broadcast(bounds), keys, "left")
    cold = asked.filter("bounds is null").withColumns({"r": F.lit(0).cast("long"), "before": F.lit(0).cast("long"), "which": F.lit(0).cast("long")})
    met = asked.filter("bounds is not null").withColumn("place", place(F.col("answer"))).join(offsets, [*keys, "b"])
    for_target = met.filter("before < target and target <= last").withColumn("which", F.lit(1).cast("long"))
    for_answer = met.filter("r = place").withColumn("which", F.lit(2).cast("long"))
    columns = ["i", "n", "target", "points", "answer", "before", "which"]
    order = [*keys, "r", "b", "x", "c", *columns]
    none = F.lit(None).cast("long")
    mixed = ranged.select(*keys, "r", "b", "x", "c", *(none.alias(c) for c in columns))
    for part in (cold, for_target, for_answer):
        mixed = mixed.unionByName(part.select(*keys, "r", "b", none.alias("x"), none.alias("c"), *(F.col(c).cast("long").alias(c) for c in columns)))
    done = _ranked(mixed.select(*order).repartition(*keys, "r").sortWithinPartitions(*keys, "r", "x"), len(keys))
    done = done.toDF(*keys, *done.columns[len(keys) :])
    picked = lambda c, w: F.max(F.when(F.col("which").isin(0, w), F.col(c)))
    found = done.groupBy(*keys, "b", "i", "n", "target", "points", "answer").agg(picked("exact", 1).alias("exact_x"), picked("below", 2).alias("n_below"), picked("upto", 2).alias("n_upto"))
    return found.select(*(F.col(k).alias(g) for k, g in zip(keys, groups)), F.col("b").cast("int").alias(batch), "i", "n", "target", "exact_x", "points", "answer", "n_below", "n_upto")


def batched(rows: DataFrame, item: Column, money: Column, batches: int = BATCHES) -> DataFrame:
    """``rows`` with batch, the crc32 of the id's decimal text mod ``batches`` (0 for no id), and x, the money in hundredths plus 1000 for each batch."""
    batch = F.coalesce(common.remainder(item, batches), F.lit(0)).cast("int")
    return rows.withColumn("batch", batch).withColumn("x", F.floor(100 * money + 0.5) + 1000 * F.col("batch"))


def _number(c: str) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < 9e15), F.col(c))


def streams(clicks: DataFrame, lines: DataFrame, items: DataFrame) -> DataFrame:
    """(stream, grp, batch, x, c): the counted values of both streams.

    Of clicks with one id the first counts, by arrival, then time, client and value; clicks without an id are each a row.  Of items with one
    id the first, by brand and price.  Rows without item, group or money go; so does money that is no finite number.
    Lines are counted by item and batch before they meet the items, so no item is hot.
    """
    named = clicks.filter("click_id is not null").groupBy("click_id").agg(F.min(F.struct("arrived_at", "ts", "client_id", "value")).alias("s"))
    unnamed = clicks.filter("click_id is null").select(F.lit(None).cast("long").alias("click_id"), "client_id", F.col("value").cast("double").alias("money"))
    value = named.select(F.col("click_id").cast("long").alias("click_id"), "s.client_id", F.col("s.value").cast("double").alias("money")).unionByName(unnamed)
    value = value.withColumn("money", _number("money")).filter("client_id is not null and money is not null")
    value = batched(value, F.col("click_id"), F.col("money")).select(F.lit("value").alias("stream"), F.col("client_id").cast("string").alias("grp"), "batch", "x", F.lit(1).cast("long").alias("c"))
    first = items.filter("item_id is not null").groupBy("item_id").agg(F.min(F.struct("brand", "price")).alias("s"))
    first = first.select("item_id", F.col("s.brand").cast("string").alias("grp"), F.col("s.price").cast("double").alias("money"))
    first = first.withColumn("money", _number("money")).filter("grp is not null and money is not null")
    sold = batched(lines.filter("item_id is not null"), F.col("vendor_id"), F.lit(0.0)).groupBy("item_id", "batch").agg(F.count("*").alias("c"))
    price = sold.join(first, "item_id").withColumn("x", F.floor(100 * F.col("money") + 0.5) + 1000 * F.col("batch"))
    both = value.unionByName(price.select(F.lit("price").alias("stream"), "grp", "batch", "x", "c"))
    return both.groupBy("stream", "grp", "batch", "x").agg(F.sum("c").alias("c"))


def quantiles(counted: DataFrame, groups: list[str], batch: str = "batch", eps: float = EPS, hot: int = HOT) -> DataFrame:
    """(groups, batch, i, n, target, exact_x, points, answer, n_below, n_upto, rank_error, within) of every summary of at least LEAST values.

    ``counted`` as in ``summarise``, with groups that aren't null; it is written as a table.  An empty table gives an empty one.
    """
    held = common.cut(counted.select(*map(common.col, groups), common.col(batch), F.col("x").cast("long").alias("x"), F.col("c").cast("long").alias("c")), "counted")
    made = common.cut(summarise(held, groups, batch, eps), "summaries")
    asked = common.cut(ask(made, [*groups, batch]), "questions")
    found = exact_ranks(held, made, asked, groups, batch, hot)
    error = F.greatest(F.lit(0).cast("long"), F.col("n_below") + 1 - F.col("target"), F.col("target") - F.col("n_upto"))
    thousandths = F.lit(round(1000 * eps))
    return found.withColumn("i", F.col("i").cast("int")).withColumn("rank_error", error).withColumn("within", 1000 * F.col("rank_error") <= thousandths * F.col("n"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = streams(*(common.table(spark, sf_dir, t) for t in ("clicks", "sale_lines", "items")))
    return quantiles(rows, ["stream", "grp"])
