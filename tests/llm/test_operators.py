import hashlib
import zlib

import pytest

from inkmill.llm import decontamination, fingerprints, html, language, lines, near, packing, quality, scoring, substrings
from inkmill.llm.queries import ORACLES, QUERIES
from tests.compare import SF, rows_of, rows_of_sql

PROSE = "the quick brown fox jumps over the lazy dog while seven old sailors watch a silver moon rise above quiet hills".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert rows_of(QUERIES[name](spark, SF)) == rows_of_sql(ORACLES[name])


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_fingerprints_of_edits(spark, documents):
    rows = QUERIES["op3_fingerprints"](spark, SF).collect()
    order = sorted(documents, reverse=True)
    follows = dict(zip(order, order[1:] + order[:1]))
    prints = {r.doc_id: r.fingerprint for r in rows}
    for r in rows:
        text, other = documents[r.doc_id].text or "", documents[follows[r.doc_id]].text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if documents[follows[r.doc_id]].text == text:
            assert r.near_next == 1 and prints[r.doc_id] == prints[follows[r.doc_id]]


def test_language_held_out(spark, documents):
    rows = [r for r in QUERIES["op4_language_id"](spark, SF).collect() if r.held_out and len((documents[r.doc_id].text or "").split()) > 20]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.lang_pred == documents[r.doc_id].lang for r in rows) >= 0.95 * len(rows) > 0


def test_quality_held_out(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in QUERIES["op7_quality_fm"](spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in rows) >= 0.85 * len(rows) > 0


def test_packing_holds_every_id_once(spark, documents):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces, sequences = {}, {}
    for r in packing.pack(docs).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, d in documents.items():
        ids = np.frombuffer(b"".join(x for _, x in sorted(pieces[i])), "<u4").tolist()
        assert ids == [*t.encode(d.text or "", add_special_tokens=False).ids, 2]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_substrings_keep_the_first_and_shift(spark):
    def prose(seed: int) -> str:
        return " ".join(hashlib.sha256(f"{seed}-{i}".encode()).hexdigest()[:7] for i in range(90))

    shared = prose(1)
    rows = [(1, prose(2) + " " + shared), (2, prose(3) + " x " + shared + " " + prose(4)), (3, prose(5)), (4, None), (5, "")]
    got = {r.doc_id: r for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == got[3].n_removed == got[4].n_removed == got[5].n_removed == 0 and got[1].text == rows[0][1]
    assert got[2].n_removed > 0.7 * len(shared) and got[4].text is None and got[5].text == ""
    text, kept, at = rows[1][1], "", 0
    for s in got[2].removed:
        kept, at = kept + text[at : s.start], s.end
        assert text[s.start : s.end] in rows[0][1]
    assert kept + text[at:] == got[2].text


def test_substrings_find_every_passage_over_50_words(spark):
    def prose(seed: str, n: int) -> str:
        return " ".join(hashlib.sha256(f"{seed}-{i}".encode()).hexdigest()[: 2 + i * 7 % 8] for i in range(n))

    passages = {(n, i): prose(f"p{n}-{i}", n) for n in range(51, 61) for i in range(10)}
    rows = [(j, prose(f"a{j}", 40 + j % 9) + ", " + p + " " + prose(f"b{j}", 30)) for j, p in enumerate(passages.values())]
    rows += [(1000 + j, prose(f"c{j}", 35 + j % 7) + " " + p + ". " + prose(f"d{j}", 45)) for j, p in enumerate(passages.values())]
    rows += [(2000, "a b c " * 17 + prose("e", 60)), (2001, prose("f", 60) + " x " + "a b c " * 17), (None, rows[0][1] + " own words"), (None, prose("g", 60)), (None, prose("g", 60))]
    out = substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: r for r in out if r.doc_id is not None}
    for j, p in enumerate(passages.values()):
        assert got[j].n_removed == 0 and p not in got[1000 + j].text and got[1000 + j].n_removed == len(p)
    assert got[2001].n_removed >= 99 and got[2000].n_removed == 0
    assert sorted(r.text for r in out if r.doc_id is None) == sorted([" own words", "", prose("g", 60)])


def test_lines_go_by_row_not_by_doc_id(spark):
    def text(*names: str) -> str:
        return "\n".join(f"{n} line {i}" for n in names for i in range(3))

    rows = [(None, text("s", "a")), (None, text("b", "s", "c")), (None, text("d", "e", "f")), (None, text("s")), (7, text("g", "h")), (7, text("i", "s")), (7, text("g", "j")), (8, text("k"))]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    want = [text("s", "a"), text("b", "c"), text("d", "e", "f"), "", text("g", "h"), text("i"), text("j"), text("k")]
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for (i, _), t in zip(rows, want))


def test_near_copies_are_told_by_row(spark):
    def prose(seed: str, *more: str) -> str:
        return " ".join([hashlib.sha256(f"{seed}-{i}".encode()).hexdigest()[:7] for i in range(80)] + list(more))

    rows = [(1, prose("a")), (1, prose("b")), (2, prose("b", "x")), (None, prose("c")), (None, prose("c", "y")), (None, prose("c")), (3, prose("a", "z"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    kept = sorted((str(r.doc_id), r.text) for r in near.keep_one(docs).collect())
    assert kept == sorted([("1", rows[0][1]), ("1", rows[1][1]), ("None", rows[3][1])])
    links = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in near.jaccard_classes(docs).collect())
    assert links == [("1", "1", 1), ("1", "1", 1), ("2", "1", 1), ("3", "1", 1)] + [("None", "None", 2)] * 3



EDGE = [(1, None, None), (2, "", "en"), (None, " ".join(PROSE), None), (3, " ".join(PROSE), "en"), (3, " ".join(PROSE), "en"), (4, "a\nb\nc\na\nb\nc", None), (5, "word " * 60_000, "en"), (6, "?!", None)]
NEED = "doc_id long, text string, lang string, source string, n_chars long, n_removed string, node long, key string, score string"


def _apply(spark, name, docs):
    labels = spark.createDataFrame([(3, 1, 0), (2, 0, 0), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(PROSE[:12])), (2, None), (3, "too short")], "item_id long, text string")
    return {
        "near": lambda: near.jaccard_classes(docs),
        "keep_one": lambda: near.keep_one(docs),
        "leaks": lambda: decontamination.find_leaks(docs, bench),
        "drop_leaks": lambda: decontamination.drop_leaks(docs, bench),
        "fingerprint": lambda: fingerprints.fingerprint(docs, fingerprints.lexicon_of(docs)),
        "language": lambda: language.identify(docs, language.learn(docs)),
        "lines": lambda: lines.dedup_lines(docs),
        "substrings": lambda: substrings.dedup_substrings(docs),
        "quality": lambda: quality.score(docs, quality.train(docs, labels)),
        "pack": lambda: packing.pack(docs),
        "scores": lambda: scoring.score(docs),
    }[name]()


SAME_ROWS = {"near", "fingerprint", "language", "lines", "substrings", "quality", "scores"}
NAMES = ["near", "keep_one", "leaks", "drop_leaks", "fingerprint", "language", "lines", "substrings", "quality", "pack", "scores"]


@pytest.mark.parametrize("name", NAMES)
def test_edges(spark, name):
    docs = spark.createDataFrame([(i, t, lang, None, None, "own", 7, "k", "s") for i, t, lang in EDGE], NEED)
    rows = _apply(spark, name, docs).collect()
    assert len(rows) == len(EDGE) if name in SAME_ROWS else rows
    if name == "leaks":
        assert sorted(str(r.doc_id) for r in rows) == ["3", "3", "None"]
    if name == "drop_leaks":
        assert sorted(r.doc_id for r in rows) == [1, 2, 4, 5, 6]
    if name == "keep_one":
        assert sum(r.text == " ".join(PROSE) for r in rows) == 2  # rows without an id stay
    if name == "lines":
        assert {r.doc_id: r.text for r in rows}[4] == "a\nb\nc"


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert _apply(spark, name, spark.createDataFrame([], NEED)).collect() == []


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = {r.doc_id for r in p.quality_classifier(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.9 * len(good) and sum(i in kept for i, q in labels.items() if q == 0) <= 0.2 * (len(labels) - len(good))
    assert [n for n, _ in p.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard", "decontamination", "packing"]
    for stage in (p.line_dedup, p.ngram_jaccard, p.decontaminate):
        assert stage(spark, docs, "/root/testdata/sf0.01").columns == docs.columns


@pytest.mark.parametrize("name", NAMES)
def test_names_in_any_case_and_ids_as_text(spark, name):
    """A column TEXT is the text, n_chars may hold anything, and ids may be text; the result is the same."""
    plain = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in EDGE if i != 5], "doc_id long, text string, lang string, source string, n_chars long")
    other = plain.selectExpr("doc_id", "text TEXT", "lang Lang", "source", "array('x') n_chars")
    if name not in ("pack", "leaks", "drop_leaks", "fingerprint", "language"):
        other = other.selectExpr("cast(doc_id as string) doc_id", "TEXT", "Lang", "source", "n_chars")
    compared = [c for c in _apply(spark, name, plain).columns if c.lower() not in ("n_chars",)]
    rows = [sorted(str([r[[c.lower() for c in df.columns].index(x.lower())] for x in compared if x != "doc_id"] + [str(r.doc_id)]) for r in df.collect()) for df in (_apply(spark, name, plain), _apply(spark, name, other))]
    assert rows[0] == rows[1] and rows[0]
