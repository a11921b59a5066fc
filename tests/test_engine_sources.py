"""The data source of files, the table function of units, the search index, rules as a table and observed counters."""

import os
import random

import pytest
from pyspark.sql import functions as F

from inkmill.operators import counters, grams, keyrules, search
from inkmill.sources import contained, datasource, files
from inkmill.sources.shared import cut
from tests.test_sources import _zip, by_key, put, sha


def folder(tmp_path):
    put(tmp_path, a_DOT_pdf="1", d__e__f__b_DOT_pdf="22", d__c_DOT_md="333", _DOT_hidden__x="4", d___DOT_y="5", out__z_DOT_md="6", wide__w_DOT_txt="7")
    for i in range(200):
        (tmp_path / f"wide/{i}.txt").write_text(str(i))
    return tmp_path.as_uri()


def test_files_of_a_uri(spark, tmp_path):
    uri = folder(tmp_path)
    got = by_key(datasource.source_files(spark, uri, omit="out"), "rel")
    want = {"a.pdf": b"1", "d/e/f/b.pdf": b"22", "d/c.md": b"333", "wide/w.txt": b"7", **{f"wide/{i}.txt": str(i).encode() for i in range(200)}}
    assert {r: (x.size, x.source_sha256) for r, x in got.items()} == {r: (len(b), sha(b)) for r, b in want.items()}
    whole = by_key(datasource.source_files(spark, uri, datasource.SCHEMA).filter("rel like 'd/%'"), "rel")
    assert {r: bytes(x.content) for r, x in whole.items()} == {"d/c.md": b"333", "d/e/f/b.pdf": b"22"} and all(x.error is None for x in whole.values())
    assert datasource.source_files(spark, str(tmp_path), "rel string").count() == 205  # a path without a scheme, and with the folder


class Opened:
    def __init__(self, monkeypatch):
        self.files, self.folders = [], []
        rows, below = datasource.FilesReader._row, datasource._below

        def row(reader, system, rel, info):
            self.files.append(rel)
            return rows(reader, system, rel, info)

        def listed(system, root, at):
            self.folders.append(at)
            return below(system, root, at)

        monkeypatch.setattr(datasource.FilesReader, "_row", row)
        monkeypatch.setattr(datasource, "_below", listed)


def read(uri, schema, *filters):
    from pyspark.sql import types as T

    r = datasource.FilesReader(uri, T.StructType.fromDDL(schema), None)
    left = list(r.pushFilters(list(filters)))
    return left, [row for p in r.partitions() for b in r.read(p) for row in b.to_pylist()]


def test_filters_reach_the_tasks(tmp_path, monkeypatch):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringEndsWith, StringStartsWith

    uri, seen = folder(tmp_path), Opened(monkeypatch)
    rel = ("rel",)
    left, rows = read(uri, datasource.SCHEMA, StringStartsWith(rel, "d/"), StringEndsWith(rel, ".pdf"), GreaterThan(("size",), 1))
    assert [r["rel"] for r in rows] == ["d/e/f/b.pdf"] == seen.files and "wide" not in seen.folders and left == [GreaterThan(("size",), 1)]
    for f, want in ((EqualTo(rel, "wide/7.txt"), ["wide/7.txt"]), (In(rel, ("a.pdf", "no", "wide/w.txt")), ["a.pdf", "wide/w.txt"])):
        assert sorted(r["rel"] for r in read(uri, "rel string", f)[1]) == want
    assert len(read(uri, "rel string, size long")[1]) == 205


def test_a_listing_opens_no_file(tmp_path, monkeypatch):
    uri = folder(tmp_path)
    monkeypatch.setattr(datasource.hashlib, "sha256", lambda *a: pytest.fail("a file was read"))
    assert {r["rel"]: r["size"] for r in read(uri, "rel string, size long")[1]}["d/c.md"] == 3


def test_large_files_are_hashed_in_chunks(tmp_path, monkeypatch):
    with open(tmp_path / "big", "wb") as f:
        f.truncate(300 << 20)
    import resource

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    rows = read(tmp_path.as_uri(), "rel string, source_sha256 string")[1]
    assert contained.digest(str(tmp_path), "big") == (rows[0]["source_sha256"], 300 << 20)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100 << 10  # kilobytes


def test_a_file_that_changes_is_an_error(tmp_path, monkeypatch):
    (tmp_path / "f").write_bytes(b"x" * 10)
    monkeypatch.setattr(datasource, "CHUNK", 5)
    real = datasource.hashlib.sha256

    def growing(*a):
        with open(tmp_path / "f", "ab") as f:
            f.write(b"more")
        return real(*a)

    monkeypatch.setattr(datasource.hashlib, "sha256", growing)
    row = read(tmp_path.as_uri(), datasource.SCHEMA)[1][0]
    assert row["source_sha256"] is None and row["content"] is None and "changed" in row["error"]


BOOK = {"b.xhtml": "<p>two &lt;x&gt;</p>", "a.HTM": "<style>s</style>one<script>unclosed", "img.png": "<p>no</p>", "c.html": "three</script>   x"}


def test_units_join_to_the_same_text(spark, tmp_path):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    word = f"<w:document xmlns:w='{w}'><w:body><w:p><w:r><w:t>one</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"
    put(tmp_path, b_DOT_epub=_zip(BOOK), d__t_DOT_docx=_zip({"word/document.xml": word}), bad_DOT_epub="no zip", large_DOT_epub=_zip({f"{i:03}.html": f"<p>chapter {i}</p>" for i in range(50)}), x_DOT_txt="none")
    source = datasource.source_files(spark, tmp_path.as_uri(), datasource.SCHEMA)
    want = by_key(files.extract_content(source), "rel")
    assert {r: x.text for r, x in want.items()} == {r: x.text for r, x in by_key(files.extract(source.select("rel"), str(tmp_path)), "rel").items()}
    own = cut(files.units(source), "units")
    assert own.groupBy("rel").count().filter("rel = 'large.epub'").first()["count"] == 50
    got = by_key(files.joined_units(own), "rel")
    assert {r: x.text for r, x in got.items()} == {r: x.text for r, x in want.items()} and set(got) == {"b.epub", "d/t.docx", "bad.epub", "large.epub"}
    assert got["bad.epub"].error and got["bad.epub"].text is None and got["large.epub"]["count"] == 50
    source.createOrReplaceTempView("sources")
    first = spark.sql("SELECT u.part FROM sources s, LATERAL document_units(s.rel, s.content) u WHERE s.rel = 'b.epub' ORDER BY unit_no LIMIT 1").first()
    assert first.part == BOOK["a.HTM"]


# ---- the index


def corpus(spark, n=60, seed=1):
    rng = random.Random(seed)
    words = ["aa", "aaa", "Plan", "plan", "方案", "营销方案", "x", "ab", "ba", "Über", "", "İx", "ς"]
    text = lambda k: " ".join(rng.choice(words) for _ in range(rng.randint(0, k)))
    rows = [(f"{rng.choice(['a', 'b/c', '营销策划'])}/{i}.md" if i % 9 else f"{i}.md", text(3), text(4), text(5), text(2), text(40) if i % 7 else None, "文字型") for i in range(n)]
    return spark.createDataFrame(rows, "path string, title string, tags string, excerpt string, source string, body string, quality string")


def hits(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("keywords", [["plan"], ["aa"], ["aaa", "方案"], ["营销方案", "none such", "aba"], ["über", "plan", "plan"], ["x"], [" a"]])
def test_index_finds_what_the_scan_finds(spark, tmp_path, keywords):
    docs = cut(corpus(spark), "corpus")
    root = str(tmp_path / "index")
    grams.add(docs, root)
    for category in (None, "营销策划", "b"):
        assert hits(grams.find(docs, root, keywords, category)) == hits(search.search(docs, keywords, category))


def test_index_is_kept_for_changed_documents(spark, tmp_path):
    root = str(tmp_path / "index")
    assert grams.find(corpus(spark), root, ["plan"]).collect() == []
    old, new = cut(corpus(spark, seed=1), "old"), cut(corpus(spark, seed=1).filter("not path like 'a/%'").unionByName(corpus(spark, seed=2).filter("path like 'a/%'")), "new")
    last = new.dropDuplicates(["path"])
    assert grams.add(old, root) == 1
    removed = old.join(last, "path", "left_anti").select("path")
    assert grams.add(last.filter("path like 'a/%'"), root, removed) == 2
    assert hits(grams.find(last, root, ["plan", "方案"])) == hits(search.search(last, ["plan", "方案"]))
    os.makedirs(f"{root}/.gen-3")
    assert grams.generations(spark, root) == [1, 2]


def test_keywords_read_their_buckets(spark, tmp_path, capsys):
    root = str(tmp_path / "index")
    grams.add(corpus(spark), root)
    everything = spark.read.parquet(f"{root}/gen-1/postings")
    for word in ("方案", "plan"):
        pairs = [word[i : i + 2] for i in range(len(word) - 1)]
        own = grams.postings(spark, root, pairs)
        own.explain("formatted")
        plan = capsys.readouterr().out
        assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [" in plan
        there = everything.filter(F.col("pair").isin(pairs))
        assert own.count() == there.count() > 0 and there.select("bucket").distinct().count() <= len(pairs)


# ---- rules


@pytest.mark.parametrize("most_bytes", [1 << 20, 0])
def test_rules_of_a_table(spark, most_bytes):
    rng = random.Random(4)
    rules = [(rng.randint(0, 30), "".join(rng.choice("abcÄ方") for _ in range(rng.randint(1, 4)))) for _ in range(60)] + [(2, None), (None, "a"), (40, "")]
    texts = ["".join(rng.choice("abcdÄä方案 ") for _ in range(rng.randint(0, 12))) for _ in range(80)] + [None, ""]

    def plain(t):
        return None if t is None else min((p for p, w in rules if w is not None and p is not None and w.lower() in t.lower()), default=None)

    rows = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "id long, text string, word int")
    table = spark.createDataFrame(rules, "position int, keyword string")
    for some in (table, table.filter("keyword <> ''")):
        got = {r.id: r["first rule"] for r in keyrules.first_rule(rows, some, "text", "first rule", most_bytes).collect()}
        empty = some is table
        assert got == {i: plain(t) if empty else (None if plain(t) == 40 else plain(t)) for i, t in enumerate(texts)}
    named = table.withColumn("category", F.concat(F.lit("c"), F.col("position").cast("string")))
    assert {r.id: r.category for r in keyrules.classify(rows, named, "text", "none", most_bytes).collect()} == {i: "none" if plain(t) is None else f"c{plain(t)}" for i, t in enumerate(texts)}
    assert {r.p for r in keyrules.first_rule(rows, table.limit(0), "text", "p", most_bytes).collect()} == {None}


def test_fixed_rules_as_a_table(spark):
    from inkmill.functions import rules
    from inkmill.plans import fixtures as fx
    from tests.compare import SF

    table = spark.createDataFrame([(i, c, w) for i, (c, ws) in enumerate(rules.CATEGORIES.items()) for w in ws], "position int, category string, keyword string")
    names = fx.files(spark, SF).select("doc_id", "name")
    want = {r.doc_id: r.category for r in names.select("doc_id", rules.classify(F.col("name")).alias("category")).collect()}
    assert {r.doc_id: r.category for r in keyrules.classify(names, table, "name", rules.OTHER).collect()} == want


def test_a_hundred_thousand_keywords(spark):
    table = spark.range(100_000).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("position"), F.concat(F.lit("key-"), F.col("id").cast("string"), F.lit("!")).alias("keyword"))
    rows = spark.createDataFrame([("see key-99999! and key-7!",), ("key-100000!",)], "text string")
    want = table.filter("keyword in ('key-99999!', 'key-7!')").agg(F.min("position")).first()[0]
    assert [r.position for r in keyrules.first_rule(rows, table, "text").collect()] == [want, None]


# ---- counters


def test_counters_come_with_the_pass(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(1000, numPartitions=5).select(F.udf(lambda i: seen.add(1) or i, "long")("id").alias("id"))
    table, counts = counters.counted(rows, "test", {"n": F.count("*"), "even": F.count_if(F.col("id") % 2 == 0), "any": F.max("id") > 998})
    assert table.count() == 1000 and counts.collect() == [(1000, 500, True)] and seen.value == 1000
    _, none = counters.counted(rows.limit(0), "test", {"n": F.count("*"), "most": F.max("id")})
    assert none.collect() == [(0, None)]
