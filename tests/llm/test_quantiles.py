"""Greenwald-Khanna summaries and exact ranks against sorted values."""

import bisect
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from inkmill.llm import quantiles
from tests.compare import SF


def exact(values):
    v, c = np.unique(np.array(values, np.int64), return_counts=True)
    return v, c, np.zeros(len(v), np.int64), c


def draw(kind, n, rng):
    return {
        "wide": lambda: [rng.randrange(10**9) for _ in range(n)],
        "ties": lambda: [rng.choice((5, 5, 5, 5, 900, rng.randrange(2000))) for _ in range(n)],
        "one": lambda: [42] * n,
        "heavy": lambda: [7] * (n - n // 100) + [rng.randrange(10**6) for _ in range(n // 100)],
        "rising": lambda: list(range(n)),
    }[kind]()


def holds(summary, values, eps, points):
    """Every bound is true, the error is kept, and so are the least and greatest value."""
    v, g, d, e = summary
    ordered = sorted(values)
    upto = np.cumsum(g)
    assert len(v) == len(set(v.tolist())) and upto[-1] == len(values) and v[0] == ordered[0] and v[-1] == ordered[-1]
    for x, low, more, own in zip(v.tolist(), upto.tolist(), d.tolist(), e.tolist()):
        true = bisect.bisect_right(ordered, x)
        assert low <= true <= low + more and own <= true - bisect.bisect_left(ordered, x)
    assert ((g - e + d) <= 2 * eps * len(values)).all()
    assert min(20, len(set(values))) <= len(v) <= min(len(values), points)


@pytest.mark.parametrize("kind", ["wide", "ties", "one", "heavy", "rising"])
def test_bounds_hold_through_merges(kind):
    rng = random.Random(3)
    shares = [draw(kind, n, rng) for n in (20_000, 5, 3000, 1, 12_000, 700, 9000)] * 3
    parts = [quantiles.compress(exact(x), 0.002) for x in shares]
    for x, s in zip(shares, parts):
        holds(s, x, 0.002, 1100)
    level = [quantiles.compress(quantiles.merge(parts[i : i + 7]), 0.004) for i in (0, 7, 14)]
    values = [v for x in shares for v in x]
    whole = quantiles.compress(quantiles.merge(level), 0.006)
    holds(whole, values, 0.006, 2000)
    n, ordered = len(values), sorted(values)
    targets = np.array(sorted({1, n, *(rng.randint(1, n) for _ in range(500))}))
    answers = quantiles.query(whole, targets).tolist()
    assert answers == sorted(answers)
    for t, a in zip(targets.tolist(), answers):
        assert max(0, bisect.bisect_left(ordered, a) + 1 - t, t - bisect.bisect_right(ordered, a)) <= 0.006 * n + 1


def test_exact_summaries_stay_exact():
    rng = random.Random(8)
    shares = [[rng.randrange(60) for _ in range(n)] for n in (1, 40, 200)]
    got = quantiles.merge([exact(x) for x in shares])
    want = exact([v for x in shares for v in x])
    assert all(np.array_equal(a, b) for a, b in zip(got, want))


def test_bands_are_of_older_and_newer_deltas():
    assert quantiles.bands(np.array([20, 19, 18, 17, 13, 0, 25]), 20).tolist() == [0, 1, 2, 2, 3, 5, 0]
    # a value with the higher band (older: less delta) doesn't go into one with a lower band
    s = tuple(np.array(x, np.int64) for x in ([1, 2, 3], [1, 1, 1], [0, 0, 8], [0, 0, 0]))
    assert quantiles._absorb(s, 10, 10, True)[0].tolist() == [1, 2, 3] and quantiles._absorb(s, 10, 10, False)[0].tolist() == [1, 3]


def plain(rows):
    """{(stream, grp, batch): sorted x} of rows (stream, grp, id, money)."""
    out = defaultdict(list)
    for stream, grp, number, money in rows:
        batch = zlib.crc32(str(number).encode()) % 16 if number is not None else 0
        x = math.floor(100 * money + 0.5) + 1000 * batch
        out[stream, grp, batch].append(x)
        out[stream, grp, -1].append(x)
    return {k: sorted(v) for k, v in out.items()}


def agrees(rows, want, groups=("stream", "grp")):
    asked = {k: v for k, v in want.items() if len(v) >= 20}
    assert len(rows) == 19 * len(asked)
    seen = defaultdict(list)
    for r in rows:
        own = asked[(*(r[g] for g in groups), r.batch)]
        n, lo, hi = len(own), bisect.bisect_left(own, r.answer), bisect.bisect_right(own, r.answer)
        target = -(-r.i * n // 20)
        assert (r.n, r.target, r.exact_x, r.n_below, r.n_upto) == (n, target, own[target - 1], lo, hi)
        assert r.rank_error == max(0, lo + 1 - target, target - hi) and r.within and 1000 * r.rank_error <= 10 * n
        assert own[0] <= r.answer <= own[-1] and min(20, len(set(own))) <= r.points <= min(n, 2000)
        seen[(*(r[g] for g in groups), r.batch)].append((r.i, r.answer))
    for pairs in seen.values():
        assert [a for _, a in sorted(pairs)] == sorted(a for _, a in pairs) and len(pairs) == 19


def test_query_equals_plain_version(spark):
    clicks, lines, items = (pd.read_parquet(f"{SF}/{t}.parquet") for t in ("clicks", "sale_lines", "items"))
    clicks = clicks.drop_duplicates("click_id").dropna(subset=["client_id", "value"])
    rows = [("value", str(int(c)), int(k), v) for c, k, v in zip(clicks.client_id, clicks.click_id, clicks.value)]
    sold = lines.dropna(subset=["item_id"]).merge(items.dropna(subset=["brand", "price"]), on="item_id")
    rows += [("price", b, int(v), p) for b, v, p in zip(sold.brand, sold.vendor_id, sold.price)]
    agrees(quantiles.op12(spark, SF).collect(), plain(rows))


@pytest.mark.parametrize("hot", [4096, 3])
def test_hot_groups_and_levels(spark, monkeypatch, hot):
    rng = random.Random(5)
    rows = [("s", "hot", i, rng.choice((3.0, rng.random() * 9000))) for i in range(60_000)] + [("s", f"g{rng.randrange(40)}", i, rng.random()) for i in range(5000)]
    rows += [("t", "hot", 4, 1.0)] * 30 + [("t", "few", 4, 1.0)] * 19
    frame = spark.createDataFrame(rows, "stream string, grp string, id long, money double").repartition(40)
    counted = quantiles.batched(frame, frame["id"], frame["money"]).groupBy("stream", "grp", "batch", "x").count().withColumnRenamed("count", "c")
    monkeypatch.setattr(quantiles, "levels", lambda n: 2)
    agrees(quantiles.quantiles(counted, ["stream", "grp"], hot=hot).collect(), plain(rows))


def test_edges(spark):
    clicks = spark.createDataFrame(
        [(1, "a", 7, 2.5)] * 3 + [(None, "b", 7, 1.0)] * 25 + [(2, "z", 7, 9.0), (2, "a", 7, 3.0), (3, "a", None, 1.0), (4, "a", 7, None), (5, "a", 7, float("nan")), (6, "a", 7, float("inf")), (8, None, 9, -0.004)],
        "click_id long, arrived_at string, client_id long, value double",
    ).selectExpr("*", "'t' ts", "1 x", "2 c", "3 batch", "4 v", "5 `k0`", "6 b", "7 bounds")
    items = spark.createDataFrame([(1, "B", 1.0), (1, "A", 2.0), (2, None, 1.0), (3, "C", None), (None, "D", 1.0)], "item_id long, brand string, price double")
    lines = spark.createDataFrame([(1, 5)] * 20 + [(1, None), (2, 5), (3, 5), (None, 5), (9, 5)], "item_id long, vendor_id long")
    got = quantiles.quantiles(quantiles.streams(clicks, lines, items), ["stream", "grp"]).collect()
    want = plain([("value", "7", 1, 2.5), ("value", "7", 2, 3.0), ("value", "9", 8, -0.004)] + [("value", "7", None, 1.0)] * 25 + [("price", "A", 5, 2.0)] * 20 + [("price", "A", None, 2.0)])
    agrees(got, want)
    assert quantiles.quantiles(quantiles.streams(clicks.limit(0), lines.limit(0), items.limit(0)), ["stream", "grp"]).collect() == []


def test_levels():
    assert [quantiles.levels(n) for n in (0, 1, 16, 17, 256, 257, 10**6)] == [1, 1, 1, 2, 2, 3, 5]
