import pytest

from inkmill.operators import audit, library, search
from inkmill.sources import tools
from tests.test_sources import records, sha


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_consistency_of_nested_categories(spark):
    m = records(spark, {"manifest_pos": 0, "name": "a.pdf", "rel": "a.pdf", "quality": "text", "category": "x/y"}, {"manifest_pos": 1, "name": "b.pdf", "rel": "b.pdf", "quality": "image"})
    held = paths(spark, "x/y/a.pdf.md", "x/y/z/more.md", "x/own.md", "xy/no.md", "其他/old.md", "x/y/picture.png", "INDEX.md")
    assert sorted(r.path for r in audit.orphans(m, held).collect()) == ["x/y/z/more.md", "其他/old.md"]
    assert tuple(audit.consistency(m, held).first()) == (True, 0, 2)
    assert tuple(audit.consistency(m, paths(spark, "x/own.md", "INDEX.md")).first()) == (False, None, None)
    assert [r.path for r in audit.shown(held, 2).collect()] == ["INDEX.md", "x/own.md"]
    assert tuple(audit.at_stake(m).first()) == (1, 0)


def test_records_that_share_a_key_all_have_a_decision(spark):
    good = {"name": "a.pdf", "rel": "a.pdf", "quality": "text", "raw": "_raw/all/a.txt", "raw_sha256": sha("long enough text"), "source_sha256": sha("A")}
    m = records(spark, {"manifest_pos": 0, **good, "source_sha256": sha("B")}, {"manifest_pos": 1, **good}, {"manifest_pos": 2, "name": "a.mobi", "rel": "a.mobi", "quality": "skip_duplicate", "duplicate_of": "a.pdf", "source_sha256": sha("M")})
    sources = spark.createDataFrame([("a.pdf", 1, sha("A")), ("a.mobi", 1, sha("M"))], "rel string, size long, source_sha256 string")
    texts = spark.createDataFrame([("_raw/all/a.txt", "long enough text")], "raw string, text string")
    assert {r.manifest_pos: r.decision for r in audit.removal_plan(m, sources, texts).collect()} == {0: "no_archive", 1: "delete", 2: "delete"}


def test_notes_are_searched(spark):
    m = records(spark, {"manifest_pos": 0, "name": "a.pdf", "rel": "a.pdf", "quality": "text", "ocr": True, "raw": "r"}, {"manifest_pos": 1, "name": "b.pdf", "rel": "b.pdf", "quality": "text", "raw": "s"})
    texts = spark.createDataFrame([("r", "body"), ("s", "body")], "raw string, text string")
    corpus = search.searchable(library.documents(m, texts))
    assert [(r.path, r.score) for r in search.search(corpus, ["OCR"]).collect()] == [("其他/a.pdf.md", 1)]
    with pytest.raises(ValueError):
        search.search(corpus, [""])


def test_absent_tools_are_named(monkeypatch):
    monkeypatch.setattr(tools.shutil, "which", lambda c: None)
    monkeypatch.setattr(tools.os.path, "isfile", lambda p: False)
    with pytest.raises(RuntimeError, match="libreoffice"):
        tools.need("libreoffice")
    monkeypatch.setattr(tools.shutil, "which", lambda c: f"/bin/{c}")
    assert tools.need("tesseract") == "/bin/tesseract"
