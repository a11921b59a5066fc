"""Phrases against a plain version: all n-grams in a dictionary."""

import itertools
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from inkmill.llm import collocations


def plain(rows, least, words=5, share=100, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(words, len(w) - i) + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = {p[i : i + k] for p in often for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * often[p] >= share * counts[p[i : i + k]]}
        found = []
        for p, a in often.items():
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            if p not in covered:
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, n[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus(seed, docs=120):
    rng = random.Random(seed)
    fixed = ["New York", "rote Grütze mit Sahne", "a\x01b a", "漢 字 漢 字 漢", "the of the", "\x00 z"]
    rows = []
    for i in range(docs):
        text = []
        for _ in range(rng.randint(0, 80)):
            text.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice("the the the of and a cat dog x\x02 É".split(" ")))
            text.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!", "\x0b", ", "]))
        rows.append((rng.choice(["en", "de", None, "", "x\ny"]), "".join(text)))
    return rows + [rows[0]] * 5 + [(None, None), ("en", None), ("none", " .,\n"), ("en", "the cat " * 30_000)]


def result(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, lang, 1, 2, "p") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, f long, part long, phrase string")
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(docs.repartition(5), **options).collect())


@pytest.mark.parametrize(("least", "share", "top", "words"), [(12, 100, 2000, 5), (3, 60, 7, 4)])
def test_phrases(spark, least, share, top, words):
    rows = corpus(least)
    want = plain(rows, least, words, share, top)
    assert len({r[0] for r in want}) >= 4 and result(spark, rows, least=least, share=share, top=top, words=words) == want


@pytest.mark.parametrize("hot", [2, 40])
def test_salting_changes_nothing(spark, monkeypatch, hot):
    rows = corpus(4) + [("en", f"hot pair w{i % 40} end. hot w{i % 30}") for i in range(900)]
    want = plain(rows, 10)
    monkeypatch.setattr(collocations, "HOT", hot)
    assert result(spark, rows, least=10) == want


def test_stack_counts_prefixes():
    suffixes = sorted([(b"en\na b c ", 2), (b"en\na b ", 1), (b"en\na\x01 b ", 5), (b"en\na ", 1), (b"de\na b ", 4), (b"en\nab c ", 3)], reverse=True)
    got = dict(collocations.count_prefixes(((s, 0, c) for s, c in suffixes), 2))
    assert got == {b"en\na b c": 2, b"en\na b": 3, b"en\na": 4, b"en\na\x01 b": 5, b"en\na\x01": 5, b"de\na b": 4, b"de\na": 4, b"en\nab c": 3, b"en\nab": 3}


def test_split_prefixes_are_returned_in_parts():
    rows = [(b"en\nh p x ", 5, 1), (b"en\nh p ", 5, 1), (b"en\nh q ", 1, 1), (b"en\nh r s ", 1, 3)]
    got = dict(collocations.count_prefixes(iter(sorted(rows, reverse=True)), 3))
    assert got == {b"en\nh r s": 3, b"en\nh": 6, b"en\nh r": 3, b"en\nh p x": 1, b"en\nh p": 2}


def test_products_beyond_64_bits(spark):
    many = "wide apart " * 10
    docs = spark.createDataFrame([("en", many)] * 100, "lang string, text string")
    totals, phrases = collocations.phrase_counts(docs)
    assert {r.phrase: r.f for r in phrases.filter("size < 3").collect()} == {"wide": 1000, "apart": 1000, "wide apart": 1000, "apart wide": 900}
    big = spark.range(1).selectExpr("cast(4000000000000 as bigint) a", "cast(9000000000000 as bigint) n", "cast(7000000000001 as bigint) l", "cast(5000000000003 as bigint) r")
    from pyspark.sql import functions as F

    score = F.call_function("div", F.lit(1000).cast("decimal(38,0)") * collocations._exact("a") * collocations._exact("n"), collocations._exact(collocations._exact("l") * collocations._exact("r")))
    assert big.select(score).first()[0] == 1000 * 4 * 10**12 * 9 * 10**12 // (7000000000001 * 5000000000003)


def test_empty_table(spark):
    assert result(spark, [], least=1) == []
    assert result(spark, [(None, None), ("en", "")], least=1) == []


def every_run():
    return collocations.Frequent({c: b"\xff" * (collocations._CHUNK // 8) for c in range(collocations.SLOTS // collocations._CHUNK)})


def test_equal_suffixes_of_a_task_are_one_row(spark):
    """Two texts of more than a block, and languages in turn."""
    rows = [(lang, "a b. c d e f. ") for _ in range(40) for lang in ("en", "de")] + [("en", "a b. " * (collocations.BLOCK // 4))] * 2
    docs = spark.createDataFrame([(lang, bytearray(t.encode())) for lang, t in rows], "lang string, text binary").coalesce(1)
    found = collocations._suffixes(docs, [every_run()] * 2, [{}, {}], 5).collect()
    assert {bytes(r.suffix): r.c for r in found if r.suffix.startswith(b"de")} == {b"de\n" + s: 40 for s in (b"a b ", b"b ", b"c d e f ", b"d e f ", b"e f ", b"f ")}
    assert len(found) == len({bytes(r.suffix) for r in found}) == 12
    assert sum(r.c for r in found) == 80 * 6 + 2 * 2 * (collocations.BLOCK // 4)


@pytest.mark.parametrize(("rows", "size"), [(1, 10**9), (5, 10**9), (10**6, 100), (10**6, 10**9)])
def test_combined_suffixes_keep_their_counts(rows, size):
    rng = random.Random(rows)
    blocks = [[(rng.randrange(3), rng.randrange(4), rng.randrange(1, 9)) for _ in range(rng.randrange(6))] for _ in range(30)]
    table = lambda block: pa.table({"part": pa.array([p for p, _, _ in block], pa.int64()), "suffix": pa.array([b"en\n%d " % s for _, s, _ in block], pa.binary()), "split": pa.array([0] * len(block), pa.int32()), "c": pa.array([c for *_, c in block], pa.int64())})
    want = Counter()
    for p, s, c in itertools.chain(*blocks):
        want[p, b"en\n%d " % s] += c
    got = Counter()
    for found in collocations.combined((table(b) for b in blocks), rows, size):
        assert found.schema.equals(table([]).schema)
        for r in found.to_pylist():
            got[r["part"], r["suffix"]] += r["c"]
    assert got == want


def test_suffixes_are_only_cut_for_longer_phrases(spark, monkeypatch):
    """Words, pairs and triples are spelled from the table of words: no task returns them, however many tasks have them."""
    made, real = [], collocations._suffixes
    monkeypatch.setattr(collocations, "_suffixes", lambda *args, **more: made.append(real(*args, **more)) or made[-1])
    rows = [("en", f"a{i} b{i} c{i}. " * 3 + "l m n o p. ") for i in range(30)] * 8
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    _, phrases = collocations.phrase_counts(docs, least=20)
    assert phrases.count() == 30 * 6 + 15 and {r.f for r in phrases.collect()} == {24, 240}
    assert {bytes(r.suffix) for r in made[0].collect()} == {b"en\nl m n o p ", b"en\nm n o p "}


def test_long_words_of_one_polynomial_hash(spark):
    """Thue-Morse words and their complements agree modulo 2**64 for every base."""
    bits = "".join(str(i.bit_count() % 2) for i in range(4096))
    one, other = bits.translate({48: "a", 49: "b"}), bits.translate({48: "b", 49: "a"})
    rows = [("en", f"{one} x. {other} y. {one} x. ")] * 30
    assert result(spark, rows, least=20) == plain(rows, 20)


def test_words_that_share_a_hash_are_hashed_anew(spark, monkeypatch):
    seeds, real = [], collocations._words

    def words(docs, seed=0):
        seeds.append(seed)
        found = real(docs, seed)
        return found if seed else found.selectExpr("if(h is null, null, 7) as h", "lang", "word", "c")

    monkeypatch.setattr(collocations, "_words", words)
    rows = [("en", "one two three. ")] * 30 + [("de", "one two. ")] * 25
    assert result(spark, rows, least=20) == plain(rows, 20) and seeds == [0, 1]
