import hashlib
import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from inkmill.functions import names
from inkmill.operators import audit, incremental, library, ocr, recovery, search
from inkmill.plans import fixtures
from inkmill.plans.schemas import LISTING, MANIFEST
from inkmill.sources import archive, builder, files, manifests, removal
from inkmill.streaming import ingest
from tests.compare import SF


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def records(spark, *rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in MANIFEST.fields) for r in rows], MANIFEST)


def by_key(df, key="manifest_pos"):
    return {r[key]: r for r in df.collect()}


def put(folder, **contents):
    for name, data in contents.items():
        path = folder / name.replace("__", "/").replace("_DOT_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_scan_by_levels(spark, tmp_path):
    put(tmp_path, a_DOT_pdf="1", d__e__f__b_DOT_pdf="2", out__c_DOT_md="3", d___x_DOT_pdf="4", _DOT_h__y="5")
    os.symlink(tmp_path / "d", tmp_path / "link")
    got = sorted(r.rel for r in files.scan(spark, str(tmp_path), str(tmp_path / "out")).collect())
    assert got == ["a.pdf", "d/_x.pdf", "d/e/f/b.pdf", "link"]
    empty = tmp_path / "none"
    empty.mkdir()
    assert files.scan(spark, str(empty)).collect() == []


def _zip(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, body in parts.items():
            z.writestr(n, body)
    return out.getvalue()


def test_epub_chapters(spark, tmp_path):
    body = {"b.xhtml": "<p>two &lt;x&gt;</p>", "a.HTM": "<style>s</style>one<script>unclosed", "img.png": "<p>no</p>", "c.html": "three</script>   x"}
    put(tmp_path, b_DOT_epub=_zip(body))
    row = files.extract(spark.createDataFrame([("b.epub",)], "rel string"), str(tmp_path)).first()
    assert row.text.split() == ["one", "unclosed", "two", "<x>", "three", "x"] and row["count"] == 3 and row.quality == "text" and "   " not in row.text


def test_pptx_slides(spark, tmp_path):
    p, a, r = "http://schemas.openxmlformats.org/presentationml/2006/main", "http://schemas.openxmlformats.org/drawingml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    rel = "http://schemas.openxmlformats.org/package/2006/relationships"
    para = "<a:p><a:r><a:t>{}</a:t></a:r></a:p>"
    cell = "<a:tc><a:txBody>" + para + "</a:txBody></a:tc>"
    table = f"<p:graphicFrame><a:graphic><a:graphicData><a:tbl><a:tr>{cell.format('x')}{cell.format('y')}</a:tr></a:tbl></a:graphicData></a:graphic></p:graphicFrame>"
    slide = f"<p:sld xmlns:p='{p}' xmlns:a='{a}'><p:cSld><p:spTree><p:sp><p:txBody>{para.format('hello')}</p:txBody></p:sp>{table}</p:spTree></p:cSld></p:sld>"
    notes = f"<p:notes xmlns:p='{p}' xmlns:a='{a}'><p:cSld><p:spTree><p:sp><p:nvSpPr><p:nvPr><p:ph type='body'/></p:nvPr></p:nvSpPr><p:txBody>{para.format('said')}</p:txBody></p:sp></p:spTree></p:cSld></p:notes>"
    rels = "<Relationships xmlns='" + rel + "'><Relationship Id='{}' Type='x/{}' Target='{}'/></Relationships>"
    deck = {
        "ppt/presentation.xml": f"<p:presentation xmlns:p='{p}' xmlns:r='{r}'><p:sldIdLst><p:sldId r:id='r1'/></p:sldIdLst></p:presentation>",
        "ppt/_rels/presentation.xml.rels": rels.format("r1", "slide", "slides/slide1.xml"), "ppt/slides/slide1.xml": slide,
        "ppt/slides/_rels/slide1.xml.rels": rels.format("n1", "notesSlide", "../notesSlides/n1.xml"), "ppt/notesSlides/n1.xml": notes,
    }
    put(tmp_path, s_DOT_pptx=_zip(deck))
    row = files.extract(spark.createDataFrame([("s.pptx",)], "rel string"), str(tmp_path)).first()
    assert row.text == "hello\nx\ty\n[备注] said" and (row["count"], row.unit, row.error) == (1, "slides", None)
    assert files.pptx(_zip(deck), notes=False)[0] == ["hello", "x\ty"]


BOOK = "字" * 200


def _pages(content: bytes) -> int:
    if content == b"broken":
        raise ValueError("broken")
    return int(content.split(b":")[0])


def _page(content: bytes, i: int) -> str:
    return content.split(b":")[1].decode() * 1 + f" {i} "


def test_recognition_to_the_manifest(spark, tmp_path):
    put(tmp_path, src__book_DOT_pdf=f"7:{BOOK}", src__poster_DOT_pdf="3:x", src__bad_DOT_pdf="broken", src__none_DOT_pdf="0:x", src__moving_DOT_pdf=f"2:{BOOK}")
    root = str(tmp_path / "src")

    def read(rel: str) -> bytes:
        path = os.path.join(root, rel)
        with open(path, "rb") as f:
            data = f.read()
        if rel == "moving.pdf" and data.startswith(b"2"):
            with open(path, "wb") as f:
                f.write(b"2:" + data[2:] + b"!" if data.count(b"!") < 3 else data)
        return data

    kinds = ["book", "poster", "bad", "none", "moving"]
    manifest = records(spark, *({"manifest_pos": i, "name": f"{k}.pdf", "rel": f"{k}.pdf", "ext": ".pdf", "quality": "image", "category": "其他"} for i, k in enumerate(kinds)), {"manifest_pos": 9, "name": "t.pdf", "rel": "t.pdf", "ext": ".pdf", "quality": "text"})
    candidates = ocr.candidates(manifest)
    assert candidates.count() == 5
    done = ocr.recognise(candidates.select("rel"), read, _pages, _page).cache()
    found = by_key(done, "rel")
    assert set(found) == {"book.pdf", "bad.pdf", "moving.pdf"} and found["bad.pdf"].error == "ValueError: broken" and "changed" in found["moving.pdf"].error
    book = found["book.pdf"]
    assert book.text == "\n\n".join(f"{BOOK} {i} " for i in range(7)) and book["count"] == 7 and book.source_sha256 == sha(f"7:{BOOK}")
    assert book.chars == len(book.text.replace("\n", "").strip())
    after = by_key(recovery.recognised(manifest, done, candidates))
    assert (after[0].quality, after[0].ocr, after[0].raw, after[0].raw_sha256, after[0].source_sha256) == ("text", True, "_raw/all/book.pdf.txt", sha(book.text), sha(f"7:{BOOK}"))
    assert [after[i].quality for i in (1, 2, 3, 4, 9)] == ["image"] * 4 + ["text"] and after[2].error is None
    assert [r.raw for r in recovery.archived_texts(done).collect()] == ["_raw/all/book.pdf.txt"]


def test_conversion_to_the_manifest(spark, tmp_path):
    manifest = records(spark, *({"manifest_pos": i, "name": f"{k}.ppt", "rel": f"d/{k}.ppt", "ext": ".ppt", "quality": "needs_conversion", "error": "old"} for i, k in enumerate("ab")), {"manifest_pos": 2, "name": "x.ppt", "rel": "x.ppt", "ext": ".ppt", "quality": "text"})
    put(tmp_path, d__a_DOT_ppt="some slides", d__b_DOT_ppt="bad")

    def convert(content: bytes):
        if content == b"bad":
            raise RuntimeError("no file")
        return ["t" * 90], 1

    done = files.extract(recovery.conversion_candidates(manifest).select("rel"), str(tmp_path), {".ppt": convert})
    after = by_key(recovery.converted(manifest, done))
    a, b = after[0], after[1]
    assert (a.quality, a.unit, a["count"], a.chars, a.converted, a.error, a.raw_sha256, a.source_sha256) == ("text", "slides", 1, 90, True, None, sha("t" * 90), sha("some slides"))
    assert (b.quality, b.error, b.raw) == ("failed", "RuntimeError: no file", None) and after[2].quality == "text"


def test_archive_then_manifest(spark, tmp_path):
    root = str(tmp_path)
    assert manifests.load(spark, root).collect() == [] and manifests.read_json(spark, f"{root}/none.json").collect() == []
    texts = spark.createDataFrame([("_raw/all/a.txt", "甲"), ("_raw/all/b.txt", ""), ("../c.txt", "out")], "raw string, text string")
    manifest = records(spark, *({"manifest_pos": i, "name": n, "raw": raw, "raw_sha256": sha(t), "quality": "text"} for i, (n, raw, t) in enumerate([("a", "_raw/all/a.txt", "甲"), ("b", "_raw/all/b.txt", ""), ("c", "../c.txt", "out"), ("d", "_raw/all/gone.txt", "x")])))
    assert [tuple(r) for r in archive.publish(manifest, texts, root).collect()] == [("../c.txt", "unsafe path: ../c.txt")]
    got = by_key(manifests.load(spark, root))
    assert got[0].raw_sha256 == sha("甲") and got[1].raw_sha256 == sha("") and got[2].raw_sha256 is None and not (tmp_path.parent / "c.txt").exists()
    assert {r.raw: r.text for r in archive.read(manifests.load(spark, root), root).collect()} == {"_raw/all/a.txt": "甲", "_raw/all/b.txt": ""}
    os.symlink(tmp_path / "_raw/all/a.txt", tmp_path / "_raw/all/gone.txt")
    assert archive.read(manifest, root).filter("raw like '%gone%'").collect() == []
    for n in (2, 3):
        assert manifests.commit(manifests.load(spark, root).withColumn("note", F.lit(str(n))), root) == n
    assert {r.note for r in manifests.load(spark, root).collect()} == {"3"}
    assert sorted(x for x in os.listdir(root) if x.startswith("manifest-")) == ["manifest-2", "manifest-3"]
    (tmp_path / "m.json").write_text(json.dumps([{"name": "x", "chars": 3, "other": 1}, {"name": "y"}]))
    assert [(r.manifest_pos, r.name, r.chars) for r in manifests.read_json(spark, f"{root}/m.json").collect()] == [(0, "x", 3), (1, "y", None)]


def test_library_is_rebuilt_and_searched(spark, tmp_path):
    root = str(tmp_path)
    put(tmp_path, 其他__old_DOT_md="stale", 手工__own_DOT_md="方案 by hand", _raw__x_DOT_md="方案")
    manifest = records(
        spark,
        {"manifest_pos": 0, "name": "A+b 方案.pdf", "rel": "A+b 方案.pdf", "ext": ".pdf", "quality": "text", "category": "营销策划", "unit": "pages", "count": 1, "chars": 9, "raw": "_raw/all/a.txt"},
        {"manifest_pos": 1, "name": "p.pdf", "rel": "p.pdf", "ext": ".pdf", "quality": "sparse", "chars": 5, "raw": "_raw/all/p.txt"},
        {"manifest_pos": 2, "name": "i.pdf", "rel": "i.pdf", "ext": ".pdf", "quality": "image", "category": "其他", "chars": 1},
    )
    texts = spark.createDataFrame([("_raw/all/a.txt", "正文 plan plan\nsecond readable line"), ("_raw/all/p.txt", "plan")], "raw string, text string")
    written = builder.rebuild(manifest, texts, root)
    assert sorted(r.path for r in written.collect()) == sorted(r.path for r in audit.expected(manifest).collect())
    assert not (tmp_path / "其他/old.md").exists() and (tmp_path / "手工/own.md").exists()
    catalogue = (tmp_path / builder.CATALOGUE).read_text().splitlines()
    assert [x for x in catalogue if x.startswith("- ")] == [r.line for r in library.in_order(library.catalogue(library.documents(manifest, texts))).collect()]
    assert all((tmp_path / n).exists() for n in builder.GENERATED)
    corpus = search.library_files(spark, root)
    assert sorted(r.path for r in corpus.collect()) == sorted([*(r.path for r in written.collect()), "手工/own.md"])
    hits = {r.path: r for r in search.search(corpus, ["plan", "方案"]).collect()}
    mine = next(p for p in hits if "A+b" in p)
    assert "正文×2" in hits[mine].why and hits[mine].quality == "文字型" and "手工/own.md" in hits
    assert [r.path for r in search.search(corpus, ["方案"], "手工").collect()] == ["手工/own.md"]
    assert search.search(corpus, ["方案"], "手工/own").collect() == []
    again = builder.rebuild(manifest, texts, root)
    assert again.count() == 2
    with pytest.raises(ValueError):
        builder.rebuild(records(spark, {"manifest_pos": 0, "name": "x", "category": "../up", "quality": "text"}), texts, root)
    with pytest.raises(ValueError):
        builder.rebuild(records(spark), texts, root)
    assert (tmp_path / mine).exists()


def test_unsafe_records(spark):
    m = records(spark, *({"manifest_pos": i, "name": "n", "rel": rel, "category": c, "raw": raw} for i, (rel, c, raw) in enumerate([("a", "c", "_raw/a"), ("../a", "c", None), ("a", "_RAW/x", None), ("a", "c", "/etc/x"), ("a", None, "")])))
    assert sorted(r.manifest_pos for r in library.unsafe(m).collect()) == [2, 3]
    assert sorted(r.manifest_pos for r in audit.safe_rows(m).collect()) == [0, 2, 3, 4]


def test_removal_is_checked_again(spark, tmp_path):
    put(tmp_path, src__a_DOT_pdf="A", src__b_DOT_epub="B", src__b_DOT_mobi="M", src__c_DOT_pdf="C", src__d_DOT_epub="D", src__d_DOT_mobi="N", src__i_DOT_pdf="I")
    text = "long enough text"
    put(tmp_path, out___raw__all__a_DOT_txt=text, out___raw__all__b_DOT_txt=text, out___raw__all__c_DOT_txt=text, out___raw__all__d_DOT_txt="changed, but long")

    def record(pos, name, quality="text", **more):
        raw = {"raw": f"_raw/all/{name[0]}.txt", "raw_sha256": sha(text)} if quality == "text" else {}
        return {"manifest_pos": pos, "name": name, "rel": name, "ext": name[1:], "quality": quality, **raw, **more}

    manifest = records(
        spark, record(0, "a.pdf", source_sha256=sha("A")), record(1, "b.epub", source_sha256=sha("B")), record(2, "b.mobi", "skip_duplicate", source_sha256=sha("M"), duplicate_of="b.epub"),
        record(3, "c.pdf", source_sha256=sha("other")), record(4, "d.epub", source_sha256=sha("D")), record(5, "d.mobi", "skip_duplicate", source_sha256=sha("N"), duplicate_of="d.epub"), record(6, "i.pdf", "image"),
    )
    plan = manifest.select("manifest_pos", "quality", F.lit("delete").alias("decision"))
    assert [r.manifest_pos for r in audit.removal_order(plan).collect()] == [2, 5, 0, 1, 3, 4, 6]
    marked, done = removal.apply(manifest, plan, str(tmp_path / "src"), str(tmp_path / "out"))
    got = by_key(done)
    assert {p: r.deleted for p, r in got.items()} == {0: True, 1: True, 2: True, 3: False, 4: False, 5: False, 6: True} and got[3].error
    assert sorted(os.listdir(tmp_path / "src")) == ["c.pdf", "d.epub", "d.mobi"]
    assert {p: r.original_deleted for p, r in by_key(marked).items()} == {0: True, 1: True, 2: True, 3: None, 4: None, 5: None, 6: True}
    again = by_key(removal.apply(manifest, plan, str(tmp_path / "src"), str(tmp_path / "out"))[1])
    assert again[0].deleted and not again[3].deleted


def test_streaming_equals_batch(spark, tmp_path):
    listing = fixtures.listing(spark, SF)
    prior, texts, extracted = fixtures.prior(spark, SF), fixtures.archive(spark, SF), fixtures.extracted(spark, SF)
    listing.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(LISTING).parquet(str(tmp_path / "in"))
    kept = {}

    def commit(manifest, done, number):
        kept[number] = [tuple(r) for r in manifest.select("rel", "quality", "manifest_pos", "raw_sha256").collect()]

    writer = ingest.ingest(stream, lambda: (prior, texts), lambda rows: extracted.join(rows.select("rel"), "rel", "left_semi"), commit)
    writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    want = incremental.merge(fixtures.planned(spark, SF), prior, extracted).select("rel", "quality", "manifest_pos", "raw_sha256")
    key = lambda rows: sorted(map(str, rows))
    assert [key(v) for v in kept.values()] == [key(tuple(r) for r in want.collect())]


def test_nested_names_stay_below_the_bound(spark):
    long = spark.createDataFrame([("d/" + "长" * 300 + ".pdf",)], "rel string").select(names.md_name(F.col("rel"), F.col("rel")).alias("md"), names.raw_name(F.col("rel")).alias("raw")).first()
    assert len(long.md.encode()) <= 220 and len(long.raw.encode()) <= 220 and long.md.endswith(".md")
