import hashlib
import random

import numpy as np
import pytest

from inkmill.llm import fingerprints as fp

NEED = "doc_id long, text string, fingerprint string, unit string, place int"


def prose(seed: int, n: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "own", "u", 7) for i, t in rows], NEED)


def kept_terms(texts, low, high):
    sets = [set((t or "").split()) for t in texts]
    out = []
    for s in sets:
        out.append({w for w in s if low <= np.log(len(sets) / sum(w in x for x in sets)) <= high} or s)
    return out


def test_fingerprints_follow_the_terms_in_the_band(spark):
    texts = ["the " + prose(i) for i in range(40)] + ["the " + prose(1), "the " + " ".join(reversed(prose(2).split())), prose(3) + " once", None, ""]
    docs = frame(spark, enumerate(texts))
    low, high = 1.0, 2.5
    got = [r.fingerprint for r in sorted(fp.fingerprint(docs, fp.lexicon_of(docs, low, high)).collect(), key=lambda r: r.doc_id)]
    kept = kept_terms(texts, low, high)
    for i in range(len(texts)):
        for j in range(i):
            assert (got[i] == got[j]) == (kept[i] == kept[j])


def test_sketch_counts_documents(spark):
    texts = [prose(i) for i in range(50)] + [None]
    sketch, n = fp.document_frequencies(frame(spark, enumerate(texts)))
    terms = sorted({w for t in texts if t for w in t.split()})
    least = sketch.reshape(-1)[fp.sketch_places(fp.words_of([" ".join(terms)])[0])].min(0)
    assert n == 51 and least.tolist() == [sum(w in (t or "").split() for t in texts) for w in terms]


def hashes_of(*terms):
    """Fingerprints of texts of these terms, all in the lexicon."""
    everything = fp.Lexicon(np.ones(fp.SKETCH_ROWS * fp.BUCKETS, bool), np.ones(fp.SKETCH_ROWS * fp.BUCKETS, bool))
    return everything.hashes([" ".join(t) for t in terms])


@pytest.mark.parametrize("n", [30, 100, 400])
def test_likeness_follows_the_share_of_terms(n):
    rng = random.Random(n)
    got = {}
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        own = []
        for k in range(60):
            both = [f"b{k}x{rng.random()}" for _ in range(round(share * n))]
            a, b = ([*both, *(f"{s}{k}x{rng.random()}" for _ in range(n - len(both)))] for s in "ab")
            h = hashes_of(a, b)
            own.append(fp.likeness(h[:1], h[1:])[0])
        got[share] = np.mean(own)
    jaccard = {s: s / (2 - s) for s in got}
    assert got[0.0] < 0.01 and got[1.0] == 1 and all(abs(got[s] - jaccard[s]) < 0.2 for s in got)
    assert got[0.2] < got[0.5] < got[0.8]


def test_likeness_of_few_or_no_terms():
    h = hashes_of(["a"], ["a"], ["b"], [])
    assert fp.likeness(h[:1], h[1:2]).tolist() == [1.0] and fp.likeness(h[:1], h[2:3]).tolist() == [0.0]
    assert fp.likeness(np.zeros((1, fp.HASHES)), np.zeros((1, fp.HASHES))).tolist() == [0.0]


ROWS = [(7, prose(1)), (3, prose(2)), (3, prose(3)), (3, prose(3)), (None, prose(4)), (None, None), (None, prose(5)), (-9, ""), (1 << 62, prose(6, 3000)), (0, "?!")]


@pytest.mark.parametrize("unit_chars", [50, 1 << 30])
@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], [(None, "a b"), (None, "a b"), (None, "c d")], [(i, prose(i, 20)) for i in range(300)], []])
def test_edits_against_brute_force(spark, rows, unit_chars):
    docs = frame(spark, rows).repartition(3) if rows else frame(spark, rows)
    lexicon = fp.lexicon_of(docs)
    got = sorted((str(r.doc_id), r.n_chars, r.edited, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in fp.compare_edits(docs, lexicon, unit_chars).collect())
    tie = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").selectExpr("t", "xxhash64(t) as h").collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        h = lexicon.hashes([text, edited, after])
        f = fp.as_text(h)
        want.append((str(i), len(text), edited, f[0], f[1], float(fp.likeness(h[:1], h[1:2])[0]), float(fp.likeness(h[:1], h[2:])[0])))
    assert got == sorted(want)


def test_fingerprint_hash_is_of_code_points():
    lexicon = fp.Lexicon.of(np.zeros((fp.SKETCH_ROWS, fp.BUCKETS), np.int64), 0)
    one = lexicon.hashes(["", "?!"])
    assert one[0, 0] == int.from_bytes(hashlib.blake2b(b"", digest_size=4).digest(), "big") | 1 and (one[:, 1:] == 0).all()
