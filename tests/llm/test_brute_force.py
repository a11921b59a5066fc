"""Operators against plain versions of what they state."""

import hashlib
import random
import re

import numpy as np
import pytest

from inkmill.llm import common, language, lines, near, quality, scoring, substrings
from inkmill.llm.components import connected_components

#: Names that the operators use inside, or add; a table may have them already.
CLASH = ["_row", "_ROW_", "_at", "_slot", "_among", "_of", "_drop", "_lines", "_spans", "_shared", "_quality", "count", "key", "node", "block", "bands", "a.b", "n`x"]


def table(spark, rows, extra=CLASH):
    schema = "doc_id long, text string" + "".join(f", `{c.replace('`', '``')}` string" for c in extra)
    return spark.createDataFrame([(i, t, *(f"{c}{k}" for c in extra)) for k, (i, t) in enumerate(rows)], schema)


def own_columns(row, extra=CLASH):
    k = row[extra[0]].removeprefix(extra[0])
    return all(row[c] == f"{c}{k}" for c in extra) and int(k)


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def prose(seed, n=60, vocabulary=100_000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randint(0, vocabulary)}" for _ in range(n))


def changed(text, share, seed):
    rng = random.Random(seed)
    w = text.split()
    for i in rng.sample(range(len(w)), int(share * len(w))):
        w[i] = f"x{rng.randint(0, 10**6)}"
    return " ".join(w)


# ---- near duplicates


def jaccard_links(texts, t=0.8, k=5):
    def grams(text):
        w = words(text)
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else {("", text or "")}

    sets = [grams(x) for x in texts]
    return [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]) - 1e-9]


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in links:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"block_texts": 3, "block_shingles": 200, "most_blocks": 1}])
def test_near_links_and_classes(spark, options):
    base = [prose(s, 200) for s in range(6)]
    texts = [x for s, b in enumerate(base) for x in [b, *(changed(b, share, 100 * s + k) for k, share in enumerate((0.005, 0.01, 0.015, 0.02, 0.05)))]]
    boiler = prose(77, 120)
    texts += [boiler + " " + prose(500 + i, 60) for i in range(12)]  # alike, but not enough
    texts += [None, "", "?!", "a b", "a b", base[0].upper()]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near.jaccard_classes(table(spark, rows), **options).collect()}
    links = jaccard_links(texts)
    counts = np.bincount(np.array(links, int).reshape(-1), minlength=len(texts)).tolist()
    assert got == {i: (c, n) for i, (c, n) in enumerate(zip(groups(len(texts), links), counts))}
    kept = near.keep_one(table(spark, rows), **options).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(groups(len(texts), links)))
    assert all(rows[own_columns(r)][0] == r.doc_id for r in kept)


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 80
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(60)] + [(0, i) for i in range(60, 75)] + [(i, i + 1) for i in range(20, 40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges + edges[:5] + [(3, 3)], "u long, v long")).collect()}
    want = groups(n, edges)
    touched = {x for u, v in edges if u != v for x in (u, v)}
    assert got == {i: want[i] for i in touched}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_hot_keys_are_joined_whole(spark):
    rows = spark.createDataFrame([(1, i) for i in range(3000)] + [(k, k) for k in range(2, 50)], "k long, x long")
    held = common.cut(rows, "rows")
    sizes = common.cut(held.groupBy("k").count().withColumnRenamed("count", "n"), "sizes")
    got = common.join_counted(held, sizes, ["k"], "n")
    assert sorted(map(tuple, got.select("k", "x", "n").collect())) == sorted([(1, i, 3000) for i in range(3000)] + [(k, k, 1) for k in range(2, 50)])


# ---- lines


def plain_lines(rows):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    left = {}
    for k in order:
        raw = (rows[k][1] or "").split("\n")
        drop = set()
        for i in range(len(raw) - 2):
            w = tuple(x.strip(" ") for x in raw[i : i + 3])
            if any(w):
                if w in seen:
                    drop |= {i, i + 1, i + 2}
                seen.add(w)
        left[k] = None if rows[k][1] is None else "\n".join(x for i, x in enumerate(raw) if i not in drop)
    for k in range(len(rows)):
        out.append(left[k])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_lines(spark, seed):
    rng = random.Random(seed)

    def text():
        return "\n".join(rng.choice(["a", "b ", " c", "", "d e", f"own {rng.randint(0, 999)}"]) for _ in range(rng.randint(1, 12)))

    rows = [(rng.choice([None, *range(12)]), rng.choice([text(), text(), text(), None, ""])) for _ in range(40)]
    got = lines.dedup_lines(table(spark, rows).coalesce(1)).collect()
    assert [(r.doc_id, r.text) for r in sorted(got, key=own_columns)] == [(i, t) for (i, _), t in zip(rows, plain_lines(rows))]


# ---- substrings


def test_every_column_survives_substrings(spark):
    shared = prose(9, 60)
    rows = [(1, prose(1) + " " + shared), (2, prose(2) + " " + shared + " end"), (None, None), (3, ""), (None, shared), (None, shared)]
    got = substrings.dedup_substrings(table(spark, rows)).collect()
    by_row = {own_columns(r): r for r in got}
    assert sorted(by_row) == list(range(len(rows))) and by_row[0].text == rows[0][1] and shared not in by_row[1].text and by_row[2].text is None


# ---- language


TONGUES = {"de": "der die und das nicht ein ich sie mit auf", "en": "the and that not one you with have this from", "fr": "le les des une est pas que dans pour avec"}


def tongue(lang, seed, n=60):
    rng = random.Random(f"{lang}{seed}")
    common_words = TONGUES[lang].split()
    return " ".join(rng.choice(common_words) + (f" {lang}{rng.randint(0, 300)}{lang}" if rng.random() < 0.3 else "") for _ in range(n))


def test_language_by_sizes(spark):
    rows = [(i, tongue(lang, i), lang) for i, lang in enumerate(sorted(TONGUES) * 30)] + [(900, None, "en"), (901, "12 34", "de"), (None, tongue("fr", 5), None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, SCORE string")
    model = language.learn(docs)
    assert sorted(model) == sorted(TONGUES) and all(len(d) <= language.MAX_DOCS * (language.FRAGMENT + 1) * 2 for d in model.values())
    tests = [(k, tongue(lang, f"t{k}", n), lang) for k, (lang, n) in enumerate((lang, n) for lang in sorted(TONGUES) for n in (3, 4, 5, 8, 20, 400))]
    held = spark.createDataFrame([*tests, (None, None, None), (98, "", None), (99, "1 2 ?", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(held, model).collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (None, 98, 99))
    assert all(got[k].lang_pred == lang and 0 < got[k].score <= 1 for k, _, lang in tests)
    c = language.Classifier(model)
    for k, text, _ in tests:
        sizes = c.sizes(text)
        if (sizes == sizes.min()).sum() == 1:
            assert list(model)[int(sizes.argmin())] == got[k].lang_pred
    assert language.identify(held, {}).filter("lang_pred <> 'und'").collect() == []


def test_sample_of_a_language_is_bounded(spark):
    rows = [(None, "same text again", "en")] * 300 + [(i, f"text number {i} of many", "en") for i in range(300)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_docs=20)
    assert 0 < len(model["en"]) <= 20 * (language.FRAGMENT + 1)


# ---- quality


def test_interactions_against_all_pairs():
    rng = np.random.default_rng(1)
    m = quality.FactorisationMachine(rank=4)
    m.w = rng.normal(size=m.w.shape).astype(np.float32)
    m.v = rng.normal(size=(len(m.w), 4)).astype(np.float32)
    m.w0 = 0.3
    bucket = np.array([5, 9, 700, 3], np.int32)
    value = np.array([0.5, 0.2, 0.8, 1.0], np.float32)
    at = np.array([0, 3, 3, 4])
    dense = rng.normal(size=(3, len(quality.STATS))).astype(np.float32)
    got = m.score(bucket, value, at, dense)
    for row in range(3):
        x = np.zeros(len(m.w))
        x[bucket[at[row] : at[row + 1]]] = value[at[row] : at[row + 1]]
        x[quality.BUCKETS :] = np.clip((dense[row] - m.mean) / m.scale, -4, 4)
        used = np.flatnonzero(x)
        z = m.w0 + m.w @ x + sum(float(m.v[i] @ m.v[j]) * x[i] * x[j] for a, i in enumerate(used) for j in used[:a])
        assert got[row] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-4)


def test_fit_learns_an_interaction_only():
    """Labels that no single word tells, only two together."""
    rng = np.random.default_rng(2)
    pairs = [(a, b) for a in (1, 2) for b in (3, 4)]
    rows = [pairs[i] for i in rng.integers(0, 4, 1500)]
    bucket = np.array([x for r in rows for x in r], np.int32)
    value = np.full(len(bucket), 0.7, np.float32)
    at = np.arange(0, len(bucket) + 1, 2)
    dense = np.zeros((len(rows), len(quality.STATS)), np.float32)
    y = np.array([float((a == 1) == (b == 3)) for a, b in rows], np.float32)
    m = quality.FactorisationMachine().fit(bucket, value, at, dense, y, epochs=40, rate=0.1)
    assert ((m.score(bucket, value, at, dense) > 0.5) == (y > 0.5)).mean() > 0.95


def test_accept_keeps_columns_and_labels_may_be_odd(spark):
    rows = [(i, ("good plain prose " * 20 if i % 2 else "### $$$ %%% " * 20) + str(i)) for i in range(200)] + [(None, None), (7, "good plain prose " * 20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(7, 1), (7, 0), (None, 1), (5, None), (6, 9)], "doc_id long, quality int")
    docs = table(spark, rows)
    kept = quality.accept(docs, labels).collect()
    assert {r.doc_id for r in kept if r.doc_id is not None} == {i for i in range(200) if i % 2} and all(rows[own_columns(r)][0] == r.doc_id for r in kept)
    assert quality.train(docs, labels, max_rows=10).v.any()
    flat = quality.score(docs, quality.train(docs, labels.limit(0))).select("score").distinct().collect()
    assert [r.score for r in flat] == [0.5]


# ---- language model


def backoff_scores(texts, order=3, alpha=0.4):
    docs = [words(t) for t in texts]
    grams = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    count = {}
    for w in docs:
        for k in range(1, order + 1):
            for g in grams(w, k):
                count[g] = count.get(g, 0) + 1
    total = sum(map(len, docs))
    out = []
    for w in docs:
        own = {}
        for k in range(1, order + 1):
            for g in grams(w, k):
                own[g] = own.get(g, 0) + 1
        other = lambda g: count[g] - own[g]

        def log(g):
            if len(g) == 1:
                return np.log(max(1, other(g)) / max(1, total - len(w)))
            if other(g) > 0:
                return np.log(other(g) / max(1, other(g[:-1])))
            return np.log(alpha) + log(g[1:])

        out.append((len(w), sum(log(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w)))))
    return out


@pytest.mark.parametrize(("order", "block_chars"), [(1, 100), (2, 10**7), (3, 100), (3, 10**7), (4, 1000)])
def test_backoff(spark, order, block_chars):
    texts = [prose(s, 40, 30) for s in range(20)] + [prose(3, 40, 30)] * 2 + ["one", "one one one", None, "", "?!"]
    rows = [(k if k % 4 else None, t) for k, t in enumerate(texts)]
    got = scoring.score(table(spark, rows), order=order, block_chars=block_chars).collect()
    show = lambda rows: sorted((str(i), n, f"{s:.6f}") for i, n, s in rows)
    assert show((r.doc_id, r.n_words, r.log_score + 0.0) for r in got) == show((i, n, s + 0.0) for (i, _), (n, s) in zip(rows, backoff_scores(texts, order)))


def test_digest_of_words():
    assert near.digest(np.array([], np.uint64), "a") != near.digest(np.array([], np.uint64), "b")
    assert hashlib.blake2b(b"", digest_size=16).digest() != near.digest(np.array([1], np.uint64), "")


def test_gear_hash_rolls():
    codes = np.array([ord(c) for c in "the quick brown fox jumps over the lazy dog, the quick brown fox jumps over"], np.uint32)
    g = substrings.mix(codes.astype(np.uint64) + np.uint64(0x6A09E667F3BCC909))
    got = substrings.gear_hashes(codes, 8)
    for i in range(len(codes) - 8):
        h = 0
        for j in range(i + 8, i, -1):  # the usual recurrence, from the last character to the first
            h = ((h << 1) + int(g[j - 1])) & (2**64 - 1)
        assert int(got[i]) == h
    assert got[0] == got[45] and codes[:8].tolist() == codes[45:53].tolist()


def plain_repeats(texts, chars, min_words):
    """Characters of each text that an earlier text covers by a passage, by trying all."""
    def passages(t):
        starts, ends, count = substrings.units_of(substrings.code_points(t or ""))
        for i in range(len(starts)):
            for j in range(i, len(ends)):
                if ends[j] - starts[i] >= chars or count[j + 1] - count[i] >= min_words:
                    yield int(starts[i]), int(ends[j])

    seen, out = {}, []
    for k, t in enumerate(texts):
        covered = set()
        own = {}
        for s, e in passages(t):
            p = t[s:e]
            if p in seen or p in own and s >= own[p]:
                covered |= set(range(s, e))
            own.setdefault(p, e)
        for p in own:
            seen.setdefault(p, k)
        out.append("".join(c for i, c in enumerate(t or "") if i not in covered))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_substrings_against_all_passages(spark, seed):
    """Passages of 70 characters, or of 9 words."""
    rng = random.Random(seed)
    vocabulary = ["alphabetical", "bears", "codes", "dancing", "elephants", "from", "gardens", "hidden", "in", "jungles"]
    base = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(3)]
    texts = []
    for _ in range(12):
        b = rng.choice(base)
        i = rng.randrange(0, 100)
        texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 8))) + rng.choice(["", ". ", " - "]) + b[i : i + rng.randint(40, 160)] + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 8))))
    rows = list(enumerate(texts))
    for chars, least in ((70, 1000), (1000, 9)):
        got = {r.doc_id: r.text for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), chars, least).collect()}
        assert [got[i] for i in range(len(texts))] == plain_repeats(texts, chars, least)
