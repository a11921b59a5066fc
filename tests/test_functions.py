import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from inkmill.functions import han, names, rules, text
from inkmill.sources import files, manifests


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("column", "expected"),
    [
        (lambda: text.clean(F.lit(None).cast("string")), ""),
        (lambda: text.clean(F.lit("a\r\nb")), "a\nb"),
        (lambda: text.clean(F.lit("x\x7f")), "x\x7f"),
        (lambda: rules.judge(F.lit(799), F.lit(10)), "sparse"),
        (lambda: rules.judge(F.lit(100), F.lit(0)), "image"),
        (lambda: rules.judge(F.lit(120), F.lit(10), "pptx"), "sparse"),
        (lambda: rules.classify(F.lit("Apple 报告.pdf")), "文案珍藏"),
        (lambda: rules.classify(F.lit("readme.txt")), "其他"),
        (lambda: text.size_label(F.lit(12500)), "1.2万字"),
        (lambda: text.size_label(F.lit(9999)), "9999字"),
        (lambda: han.fold_radicals(F.lit("⽂，")), "文，"),
        (lambda: han.single_repeats(F.lit("理理 理理 理理")), "理 理 理"),
        (lambda: han.single_repeats(F.lit("慢慢")), "慢慢"),
        (lambda: F.round(han.repeat_rate(F.lit("理\n理")), 3), 0.5),
        (lambda: names.safe(F.lit("z\\..\\o")), False),
        (lambda: names.safe(F.lit("C:\\o")), False),
        (lambda: names.safe(F.lit("nested\\category")), True),
        (lambda: names.md_name(F.lit("a.pdf"), F.lit("a.pdf")), "a.pdf.md"),
        (lambda: names.raw_name(F.lit("book.epub")), "book.epub.txt"),
        (lambda: F.octet_length(names.raw_name(F.lit("长" * 200 + ".pdf"))) <= 220, True),
        (lambda: text.excerpt(F.lit("12 34\n  ab\n eight  letters here ")), "eight letters here"),
        (lambda: han.keywords(F.lit("")), []),
        (lambda: han.keywords(F.lit("甲乙丙" * 5)), ["甲乙"]),
    ],
)
def test_literal(spark, column, expected):
    assert value(spark, column()) == expected


def _zip(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, body in parts.items():
            z.writestr(n.replace("__", "/"), body)
    return out.getvalue()


def test_extraction(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    para = "<w:p><w:r><w:t>{}</w:t></w:r></w:p>"
    body = para.format("first") + "<w:tbl><w:tr><w:tc>" + para.format("a") + "</w:tc><w:tc>" + para.format("b") + "</w:tc></w:tr></w:tbl>" + para.format("last")
    os.makedirs(tmp_path / "d")
    (tmp_path / "d" / "x.docx").write_bytes(_zip(**{"word__document.xml": f"<w:document {w}><w:body>{body}</w:body></w:document>"}))
    (tmp_path / "b.epub").write_bytes(_zip(**{"2.xhtml": "<p>two</p>", "1.html": "&lt;code&gt; &#x4E2D; <script>evil()</script>"}))
    (tmp_path / "bad.epub").write_bytes(b"no archive")
    (tmp_path / "n.txt").write_bytes(b"")
    (tmp_path / ".hidden.epub").write_bytes(b"")
    found = files.scan(spark, str(tmp_path))
    assert [r.rel for r in found.collect()] == ["b.epub", "bad.epub", "d/x.docx", "n.txt"]
    assert {r.rel: r.size for r in files.listing(found, str(tmp_path)).collect()}["n.txt"] == 0
    got = {r.rel: r for r in files.extract(found, str(tmp_path)).collect()}
    assert got["d/x.docx"].text == "first\nlast\na\tb" and got["d/x.docx"]["count"] == 2 and got["d/x.docx"].quality == "sparse"
    assert "<code> 中" in got["b.epub"].text and "evil" not in got["b.epub"].text and got["b.epub"].unit == "chapters"
    assert got["bad.epub"].error.startswith("BadZipFile") and got["bad.epub"].text is None
    assert set(got) == {"b.epub", "bad.epub", "d/x.docx"}


def test_markdown_files(spark, tmp_path):
    docs = spark.createDataFrame([("c/a.md", '---\ntitle: "x: y"\nk: 1\n---\n\nbody\n---\nmore'), ("../b.md", "plain")], "path string, markdown string")
    done = {r.path: r.error for r in manifests.write_markdown(docs, str(tmp_path)).collect()}
    assert done == {"c/a.md": None, "../b.md": "unsafe path: ../b.md"} and (tmp_path / "c" / "a.md").exists()
    got = {r.path: r for r in manifests.parse_markdown(docs).collect()}
    assert got["c/a.md"].fields == {"title": "x: y", "k": "1"} and got["c/a.md"].body == "\n\nbody\nmore"
    assert got["../b.md"].fields == {} and got["../b.md"].body == "plain"


def test_report_lists_every_record(spark):
    from pyspark.sql import functions as F

    from inkmill.operators import library

    rows = spark.range(1005).select(F.col("id").alias("manifest_pos"), F.format_string("f%d", "id").alias("name"), F.lit("failed").alias("quality"), F.lit(None).cast("string").alias("category"), F.col("id").cast("int").alias("chars"))
    listed = [x for x in library.report_text(rows).split("\n") if x.startswith("- [")]
    assert listed == [f"- [{i}字] [?] f{i}" for i in range(1004, -1, -1)]
