"""SimHash fingerprints and links against plain versions of what they state."""

import random
import re

import numpy as np
import pytest
import xxhash

from inkmill.llm import simhash
from tests.compare import SF


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(points, near=2):
    """The least index of each one's component, by all pairs."""
    n = len(points)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= near:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "a b  c\td\x0b\x0ce", "a\x1cb c d e", "ÄÖ é ß 漢字 x y", "x " * 200_000, "Ab cD eF " * 7, "a b c a b c a b d"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


def planted(seed, n, chains=40, ball=60):
    """Random points, chains of points 1 to 3 bits apart, a dense ball and points beside zero."""
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(n)] + [0, 1, 7, (1 << 64) - 1]
    for _ in range(chains):
        p = rng.choice(points)
        for _ in range(rng.randint(1, 6)):
            for b in rng.sample(range(64), rng.choice((1, 2, 2, 3))):
                p ^= 1 << b
            points.append(p)
    centre = rng.getrandbits(64)
    points += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(ball)]
    return list(dict.fromkeys(points))


@pytest.mark.parametrize("near", [0, 1, 2, 4])
def test_search_finds_all_pairs(near):
    points = np.array(planted(near, 900), np.uint64)
    got = simhash.search(points, np.full(len(points), simhash.BOTH, np.int8), near, leaf=8)
    assert got.tolist() == plain_classes([int(p) for p in points], near)


@pytest.mark.parametrize("seed", range(3))
def test_every_near_pair_meets_in_a_shard(seed):
    points = np.array(planted(seed, 1200), np.uint64)
    tree = simhash.fit(points[::2], len(points), shard=50)  # the other half is not in the sample
    assert tree.shards() > 50
    met = set()
    routed = 0
    for _, index, side in tree.route(points):
        routed += len(index)
        own = [(int(i), int(s)) for i, s in zip(index, side)]
        for i, s in own:
            met |= {(i, j) for j, t in own if i < j and (s == simhash.BOTH or s != t)} | {(j, i) for j, t in own if j < i and s != simhash.BOTH and s != t}
    near = {(i, j) for i in range(len(points)) for j in range(i + 1, len(points)) if int(points[i] ^ points[j]).bit_count() <= 2}
    assert near and near <= met and len(met) < 0.1 * len(points) ** 2 / 2


@pytest.mark.parametrize("options", [{}, {"sample": 400, "shard": 60}])
def test_classes(spark, options):
    points = planted(5, 700)
    ids = random.Random(2).sample(range(10_000), len(points))
    rows = [(i, p) for i, p in zip(ids, points)] + [(20_000 + k, p) for k, p in enumerate(points[:30])] + [(None, points[0]), (None, 0x5555555555555555), (ids[3], points[3])]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in rows]
    got = simhash.near_classes(spark.createDataFrame(signed, "doc_id long, point long").repartition(5), **options).collect()
    root = plain_classes([p for _, p in rows])
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    assert sorted((str(r.doc_id), r.point, str(r.component_id)) for r in got) == sorted((str(i), p, str(least[r])) for (i, p), r in zip(signed, root))


def test_query_equals_plain_version(spark):
    rows = simhash.op13(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    order = sorted(texts)
    prints = {i: plain_fingerprint(texts[i]) for i in order}
    root = plain_classes([prints[i] for i in order])
    want = {i: order[r] for i, r in zip(order, root)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", want[i]) for i in order}


def test_edges(spark):
    schema = "doc_id long, text string, point string, component string, component_id string, copies string, least string, u long, `a.b` string"
    texts = [(1, None), (2, ""), (3, "one"), (None, "one"), (3, "one"), (4, "word " * 60_000), (5, "ONE"), (None, "alone here")]
    docs = spark.createDataFrame([(i, t, "p", "c", "d", "e", "l", 1, "x") for i, t in texts], schema)
    got = simhash.simhash(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == sorted(
        (str(i), f"{plain_fingerprint(t):016x}", {None: "1", "": "1", "one": "3", "ONE": "3"}.get(t, str(i))) for i, t in texts
    )
    assert simhash.simhash(docs.limit(0)).collect() == []
