import random
import re

import pytest
from pyspark.sql import functions as F

from inkmill.llm import decontamination as dc


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def shingles(t, k=5):
    w = words(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items, t=0.8):
    out = []
    for d, text in docs:
        own = shingles(text)
        for i, item in items:
            s = shingles(item)
            if s and len(s & own) >= t * len(s) - 1e-9:
                out.append((str(d), str(i), len(s & own), len(s)))
    return sorted(out)


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 5000)}" for _ in range(n))


def tables(spark, docs, items):
    return spark.createDataFrame([(i, t, "own", 1) for i, t in docs], "doc_id long, text string, key string, item int"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("broadcast_bytes", [1 << 30, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_all_containments_against_brute_force(spark, seed, broadcast_bytes):
    """Items of many sizes, lacking none to a third of their words, inside long documents."""
    rng = random.Random(seed)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 5, 6, 7, 9, 12, 15, 16, 17, 31, 40, 64, 100, 200])] + [(90, None), (91, ""), (92, "w1, W2; w3 w4. w5 w6")]
    items.append((93, items[5][1]))
    docs = [(None, None), (1, ""), (1, "a b c d e f"), (2, "W1 w2 w3 - w4 w5, w6!")]
    for i, text in items:
        w = words(text)
        for lacking in (0, 0.05, 0.1, 0.15, 0.2, 0.3):
            cut = w[int(len(w) * lacking) :]
            docs.append((100 + i, f"{prose(rng, 300)} {' '.join(cut).upper()} {prose(rng, 200)}"))
            docs.append((None, f"{' '.join(w[: len(w) - int(len(w) * lacking)])} {prose(rng, 30)}"))
    documents, benchmark = tables(spark, docs, items)
    want = brute(docs, items)
    got = sorted((str(r.doc_id), str(r.item_id), r.n_shared, r.n_shingles) for r in dc.find_leaks(documents, benchmark, broadcast_bytes=broadcast_bytes).collect())
    assert got == want and len(want) > 50
    kept = sorted(str(r.text) for r in dc.drop_leaks(documents, benchmark).collect())
    assert kept == sorted(str(t) for _, t in docs if not brute([(0, t)], items))


def test_a_sketch_can_not_miss(spark):
    """The worst lack: exactly the least hashes of an item."""
    rng = random.Random(3)
    items = dc.items_of(spark.createDataFrame([(i, prose(rng, n)) for i, n in enumerate([5, 8, 14, 15, 16, 30, 33, 70])], "item_id long, text string"))
    sizes = {r.item: r.n for r in items.select("item", F.size(F.array_distinct(dc.shingle_hashes("words"))).alias("n")).collect()}
    sketch = {}
    for r in dc.sketches(items).collect():
        sketch.setdefault(r.item, set()).add(r.h)
    for item, n in sizes.items():
        assert len(sketch[item]) >= min(n, int(0.2 * n + 1e-9) + 1)


def test_size_of_a_broadcast_is_checked(spark):
    t = spark.createDataFrame([("x" * 1000, 1)] * 10, "s string, n long")
    assert dc.fits(t, 10 * (1000 + dc.ROW_BYTES)) and not dc.fits(t, 10 * 1000) and dc.fits(t.limit(0), 0)


def test_main_path_is_native(spark):
    docs, bench = tables(spark, [(1, "a b c d e f g")], [(1, "a b c d e f")])
    plan = dc.find_leaks(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
