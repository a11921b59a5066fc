"""SimHash near duplicates: 64-bit fingerprints, linked by vantage-point trees.

1. A fingerprint has the majority bits of the XXH64 hashes of a text's word shingles.  Equal fingerprints are one
   point; texts and copies never meet in pairs.
2. A vantage-point tree is fitted on a bounded sample of the points.  A node has a vantage v and a radius m.  Points with
   d(x, v) <= m go to its inner child, the others to its outer one.  By the triangle inequality two points on different sides are
   near only if both are within ``near`` of the radius, so those of both sides go to a third child as well, in which only pairs across
   the boundary count.  Every pair of near points meets in at least one leaf, a shard; pairs that the bounds exclude meet in none.
3. Points are shuffled to their shards.  A task goes on with vantage points of the shard's own until few are left, which are compared bit by bit.
4. A shard gives a link from each point to the first of its local component; components of links are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common
from inkmill.llm.components import connected_components

WORDS = 3
SEED = 42
NEAR = 2
#: Points that the tree is fitted on, about; it routes all of them.  More than SHARD points, as the sample tells, are split.
SAMPLE = 1 << 16
SHARD = 1 << 14
#: A node is split only if so many of the sample are there to tell where.
LEAST_SAMPLE = 32
#: Vantage points that are tried for a node; points of a leaf that are compared bit by bit.
TRIED = 6
LEAF = 512
#: Most tasks that search shards.
MAX_TASKS = 4096
_HASHED = 1 << 16
_KEPT_PAIRS = 1 << 20
INNER, OUTER, ACROSS, ACROSS_BACK = range(4)
BOTH = 2


def fingerprint(data: bytes, words: int = WORDS) -> int:
    """Of a text's UTF-8 bytes; 0 without words."""
    plain = b" ".join(data.lower().split())  # of bytes both mean ASCII alone
    if not plain:
        return 0
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(plain))
    k = min(words, len(starts))
    starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    votes = np.zeros(64, np.int64)
    for lo in range(0, len(starts), _HASHED):
        spans = zip(starts[lo : lo + _HASHED].tolist(), ends[lo : lo + _HASHED].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(plain[a:b], SEED) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, point): the fingerprint of each row's text as a signed long; a null text is empty."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t or b"", words) for t in b.column(1).to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "point"])

    return common.map_arrow(docs.select(common.as_long(docs, "doc_id"), F.col("text").cast("binary")), run, "doc_id long, point long")


def distances(points: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ v).astype(np.int64)


def parts(d: np.ndarray, side: np.ndarray, m: int, near: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Indices and sides of the points of each child of a node with the radius ``m``; ``d`` are their distances.

    A side is BOTH where all pairs count, else 0 or 1 and only pairs of unequal sides do.
    """
    within = d <= m
    children = [(i, side[i]) for i in (np.flatnonzero(within), np.flatnonzero(~within))]
    low, high = within & (d > m - near), ~within & (d <= m + near)
    if not len(side) or side[0] == BOTH:
        i = np.flatnonzero(low | high)
        return [*children, (i, high[i].astype(np.int8))]
    for one, other in ((low, high), (high, low)):
        i = np.flatnonzero(one & (side == 0) | other & (side == 1))
        children.append((i, side[i]))
    return children


def pairs_of(side: np.ndarray) -> float:
    """How many pairs of these points count, at most."""
    n = len(side)
    if not n or side[0] == BOTH:
        return n * (n - 1) / 2
    ones = float(np.count_nonzero(side))
    return ones * (n - ones)


def choose(points: np.ndarray, side: np.ndarray, near: int, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """The vantage point and radius with the fewest pairs in the children; None if none has a quarter less pairs than the node."""
    best, least = None, 0.75 * pairs_of(side)
    both = not len(side) or side[0] == BOTH
    for v in points[rng.integers(0, len(points), TRIED)]:
        d = distances(points, v)
        counts = [np.bincount(d[side == s], minlength=65).astype(float) for s in ((BOTH,) if both else (0, 1))]
        up = [np.concatenate([np.zeros(near), np.cumsum(c), np.full(near, c.sum())]) for c in counts]  # up[near + m]: within m
        at = near + np.arange(65)
        within = [u[at] for u in up]
        beyond = [u[-1] - w for u, w in zip(up, within)]
        low, high = [u[at] - u[at - near] for u in up], [u[at + near] - u[at] for u in up]
        if both:
            total = (within[0] ** 2 + beyond[0] ** 2) / 2 + low[0] * high[0]
        else:
            total = within[0] * within[1] + beyond[0] * beyond[1] + low[0] * high[1] + high[0] * low[1]
        m = int(np.argmin(total))
        if total[m] < least:
            best, least = (v, m), total[m]
    return best


@dataclass
class Tree:
    """Nodes in a list: vantage, radius and the numbers of the children, or None for a shard; the first is the root."""

    near: int = NEAR
    nodes: list[tuple[np.uint64, int, list[int]] | None] = field(default_factory=list)

    def grow(self, points: np.ndarray, side: np.ndarray, share: float, most: int, rng: np.random.Generator) -> int:
        """Add the node of these points of the sample, each of which stands for ``share`` points; its number."""
        number = len(self.nodes)
        self.nodes.append(None)
        found = choose(points, side, self.near, rng) if len(points) >= LEAST_SAMPLE and len(points) * share > most else None
        if found:
            v, m = found
            own = parts(distances(points, v), side, m, self.near)
            self.nodes[number] = v, m, [self.grow(points[i], s, share, most, rng) for i, s in own]
        return number

    def shards(self) -> int:
        return sum(n is None for n in self.nodes)

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, indices of its points, their sides) of every shard that any of these points belongs to."""
        open_nodes = [(0, np.arange(len(points)), np.full(len(points), BOTH, np.int8))]
        while open_nodes:
            number, index, side = open_nodes.pop()
            node = self.nodes[number]
            if node is None:
                yield number, index, side
                continue
            v, m, children = node
            for child, (i, s) in zip(children, parts(distances(points[index], v), side, m, self.near), strict=True):
                if len(i):
                    open_nodes.append((child, index[i], s))


def fit(sample: np.ndarray, total: int, near: int = NEAR, shard: int = SHARD) -> Tree:
    """The tree of a sample of ``total`` points; the same for the same sample, in any order."""
    tree = Tree(near)
    ordered = np.sort(sample.astype(np.uint64))
    tree.grow(ordered, np.full(len(ordered), BOTH, np.int8), total / max(1, len(ordered)), shard, np.random.default_rng(SEED))
    return tree


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least of the component of each of n points under the links i to j."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], least)
        np.minimum.at(root, root[j], least)
        root = root[root]
        if np.array_equal(root, before):
            return root


def search(points: np.ndarray, side: np.ndarray, near: int = NEAR, leaf: int = LEAF) -> np.ndarray:
    """The least index of each point's component under the near pairs that count."""
    rng, n = np.random.default_rng(SEED), len(points)
    found_i, found_j, kept = [], [], 0
    open_nodes = [(np.arange(n), side)]
    while open_nodes:
        index, own = open_nodes.pop()
        if len(index) < 2 or not pairs_of(own):
            continue
        at = choose(points[index], own, near, rng) if len(index) > leaf else None
        if at:
            open_nodes += [(index[i], s) for i, s in parts(distances(points[index], at[0]), own, at[1], near)]
            continue
        left, right = (index, index) if own[0] == BOTH else (index[own == 0], index[own == 1])
        for lo in range(0, len(left), leaf):
            for at_ in range(0, len(right), leaf):
                a, b = left[lo : lo + leaf], right[at_ : at_ + leaf]
                i, j = np.nonzero(np.bitwise_count(points[a][:, None] ^ points[b][None, :]) <= near)
                i, j = a[i], b[j]
                found_i.append(i[i < j] if own[0] == BOTH else i)
                found_j.append(j[i < j] if own[0] == BOTH else j)
                kept += len(found_i[-1])
                if kept > _KEPT_PAIRS:  # a forest says the same in fewer pairs
                    root = roots(n, np.concatenate(found_i), np.concatenate(found_j))
                    found_i, found_j = [np.flatnonzero(root < np.arange(n))], [root[root < np.arange(n)]]
                    kept = len(found_i[0])
    return roots(n, np.concatenate(found_i), np.concatenate(found_j)) if found_i else np.arange(n)


def _searched(shards: DataFrame, near: int) -> DataFrame:
    """(u, v) links of the points of rows (shard, side, point), sorted by shard in each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None

        def close() -> Iterator[pa.RecordBatch]:
            side, points = (np.concatenate(c) for c in zip(*held, strict=True))
            points = points.view(np.uint64)
            root = search(points, side, near)
            moved = np.flatnonzero(root != np.arange(len(root)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(points[x].view(np.int64)) for x in (moved, root[moved])], names=["u", "v"])

        for b in batches:
            shard, side, points = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for lo, hi in zip(edges, edges[1:]):
                if hi > lo:
                    if held and shard[lo] != last:
                        yield from close()
                        held.clear()
                    last = shard[lo]
                    held.append((side[lo:hi].astype(np.int8), points[lo:hi].astype(np.int64)))
        if held:
            yield from close()
        common.release()

    return common.small_batches(shards).mapInArrow(run, "u long, v long")


def near_links(points: DataFrame, near: int = NEAR, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """(u, v) links whose components are those of all pairs of the distinct points of ``points`` (point) at most ``near`` bits apart."""
    total = points.count()
    step = 1 << 40
    chosen = points.filter(F.pmod(F.xxhash64("point"), F.lit(step)) < F.lit(int(step * min(1.0, sample / max(1, total))))) if total > sample else points
    tree = fit(np.array([r["point"] for r in chosen.collect()], np.int64).view(np.uint64), total, near, shard)

    def route(b: pa.RecordBatch) -> pa.RecordBatch:
        own = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        dealt = [(np.full(len(i), k, np.int32), s, own[i]) for k, i, s in tree.route(own)]
        shards, sides, routed = (np.concatenate(c) for c in zip(*dealt, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(shards), pa.array(sides.astype(np.int8)), pa.array(routed.view(np.int64))], names=["shard", "side", "point"])

    routed = common.map_arrow(points, route, "shard int, side byte, point long", rows=10_000)
    return _searched(routed.repartition(min(tree.shards(), MAX_TASKS), "shard").sortWithinPartitions("shard"), near)


def near_classes(prints: DataFrame, near: int = NEAR, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """(doc_id, point, component_id) of each row of ``prints`` (doc_id long, point long).

    component_id is the least doc_id of the rows that links of at most ``near`` differing bits join.  Rows without a
    doc_id link like others; a component in which no row has one has a null component_id.  Repeated rows and ids stay.
    An empty table gives an empty table.
    """
    points = common.cut(prints.groupBy("point").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "points")
    classes = connected_components(near_links(points.select("point"), near, sample, shard))
    rooted = points.join(classes.withColumnRenamed("node", "point"), "point", "left").withColumn("component", F.coalesce("component", "point"))
    rooted = common.cut(rooted, "rooted")
    least = common.cut(rooted.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("c")), "components")
    by_point = common.cut(common.join_counted(rooted.select("point", "component", "copies"), least, ["component"], "c").select("point", "component_id", "copies"), "classes-by-point")
    return common.join_counted(prints, by_point, ["point"], "copies").select("doc_id", "point", "component_id")


def simhash(docs: DataFrame, words: int = WORDS, near: int = NEAR, **options: int) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs`` (doc_id, text, ...); other columns are not read.

    A bit of the fingerprint, 16 lowercase hex digits, is 1 if it is set in over half of the shingles' hashes, repeats
    included.  A text of fewer words is one shingle; a null or empty text, or one of white space, has the fingerprint 0 and links like any other.
    Long texts are hashed whole.  Ids are taken as longs; what isn't a number is a row without an id.  The rest is as in ``near_classes``.
    """
    prints = common.cut(fingerprints(docs, words), "fingerprints")
    found = near_classes(prints, near, **options)
    return found.select("doc_id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(common.table(spark, sf_dir, "documents"))
