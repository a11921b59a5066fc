"""Files are published whole, stay below their root, and survive runs that are cut off."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from inkmill.operators import audit, changes, library
from inkmill.plans import fixtures as fx
from inkmill.plans.schemas import MANIFEST
from inkmill.sources import archive, builder, contained, log, manifests, removal, repair, textfile
from inkmill.sources.shared import cut
from tests.compare import SF
from tests.test_sources import by_key, put, records, sha


class Killed(BaseException):
    """The process ends: nothing that comes after it in the program runs."""


def tree(root):
    out = {}
    for folder, folders, names in os.walk(root):
        for n in names:
            path = os.path.join(folder, n)
            out[os.path.relpath(path, root)] = os.readlink(path) if os.path.islink(path) else open(path, "rb").read()
        out.update({os.path.relpath(os.path.join(folder, n), root): None for n in folders})
    return {k: v for k, v in out.items() if not k.startswith(builder.STAGING)}


def one(pos, category, name="x.pdf", **more):
    return {"manifest_pos": pos, "name": name, "rel": name, "ext": ".pdf", "quality": "text", "category": category, "chars": 9, "raw": f"_raw/all/{pos}.txt", **more}


def texts(spark, n=5):
    return spark.createDataFrame([(f"_raw/all/{i}.txt", f"text {i}") for i in range(n)], "raw string, text string")


# ---- containment


@pytest.mark.parametrize("path", ["", "/x", "a//b", "a/../b", "..", ".", "a/", "C:x", "c:/x", "a\0b", "\\x", "a\\..\\b"])
def test_unsafe_paths_are_refused(spark, tmp_path, path):
    from inkmill.functions import names

    with pytest.raises(contained.Unsafe):
        contained.write(str(tmp_path), path, b"")
    assert not spark.createDataFrame([(path,)], "p string").select(names.safe(F.col("p"))).first()[0]
    assert os.listdir(tmp_path) == []


def test_links_are_not_followed(tmp_path):
    root, out = tmp_path / "root", tmp_path / "out"
    root.mkdir(), out.mkdir()
    (out / "f").write_text("theirs")
    os.symlink(out, root / "d")
    os.symlink(out / "f", root / "f")
    at = str(root)
    for act in (lambda: contained.write(at, "d/new", b"x"), lambda: contained.read(at, "d/f"), lambda: contained.read(at, "f"), lambda: contained.unlink(at, "d/f"), lambda: contained.kind(at, "d/f"), lambda: contained.move(at, "d/f", "g"), lambda: contained.remove_tree(at, "d"), lambda: contained.digest(at, "f")):
        with pytest.raises(contained.Unsafe):
            act()
    contained.write(at, "f", b"mine")  # takes the link's place, not its target's
    assert (out / "f").read_text() == "theirs" and (root / "f").read_text() == "mine" and not (root / "f").is_symlink()
    os.makedirs(root / "t/u")
    os.symlink(out, root / "t/u/l")
    contained.remove_tree(at, "t")
    assert (out / "f").exists() and not (root / "t").exists()


def test_half_a_file_is_never_seen(tmp_path):
    contained.write(str(tmp_path), "a", b"old")
    with pytest.raises(Killed), contained.writer(str(tmp_path), "a") as f:
        f.write(b"new")
        raise Killed
    assert contained.read(str(tmp_path), "a") == b"old" and os.listdir(tmp_path) == ["a"]


def test_digest_in_chunks(tmp_path, monkeypatch):
    monkeypatch.setattr(contained, "CHUNK", 7)
    contained.write(str(tmp_path), "a", b"0123456789" * 10)
    assert contained.digest(str(tmp_path), "a") == (sha(b"0123456789" * 10), 100)


# ---- rebuild


def test_rebuild_refuses_a_linked_parent(spark, tmp_path):
    put(tmp_path, other__y__f_DOT_txt="theirs", root__a__old_DOT_md="old")
    os.symlink(tmp_path / "other", tmp_path / "root/x")
    before = tree(tmp_path)
    for manifest in (records(spark, one(0, "a"), one(1, "x/y")), records(spark, one(0, "a"), one(1, "x"))):
        with pytest.raises(ValueError, match="link"):
            builder.rebuild(manifest, texts(spark), str(tmp_path / "root"))
    assert {k: v for k, v in tree(tmp_path).items() if ".rebuild" not in k} == before


def test_rebuild_checks_all_folders_before_any_is_touched(spark, tmp_path):
    put(tmp_path, root__a__1_DOT_md="1", root__z__2_DOT_md="2", elsewhere__3_DOT_md="3")
    os.symlink(tmp_path / "elsewhere", tmp_path / "root/b")
    before = tree(tmp_path / "root")
    with pytest.raises(ValueError):
        builder.rebuild(records(spark, *(one(i, c) for i, c in enumerate("azb"))), texts(spark), str(tmp_path / "root"))
    assert tree(tmp_path / "root") == before
    os.unlink(tmp_path / "root/b")
    (tmp_path / "root/b").write_text("a file in place of a folder")
    before = tree(tmp_path / "root")
    with pytest.raises(ValueError):
        builder.rebuild(records(spark, *(one(i, c) for i, c in enumerate("azb"))), texts(spark), str(tmp_path / "root"))
    assert tree(tmp_path / "root") == before


def test_rebuild_refuses_a_linked_archive(spark, tmp_path):
    put(tmp_path, root__a__1_DOT_md="1", theirs__all__0_DOT_txt="x")
    os.symlink(tmp_path / "theirs", tmp_path / "root/_raw")
    with pytest.raises(ValueError, match="link"):
        builder.rebuild(records(spark, one(0, "a")), texts(spark), str(tmp_path / "root"))
    assert (tmp_path / "root/a/1.md").read_text() == "1"


def test_writes_through_links_are_errors(spark, tmp_path):
    out, root = tmp_path / "out", tmp_path / "root"
    out.mkdir(), root.mkdir()
    os.symlink(out, root / "_raw")
    os.symlink(out, root / "cat")
    got = archive.write(texts(spark, 2), str(root)).collect()
    assert [r.raw_sha256 for r in got] == [None, None] and all("link" in r.error for r in got)
    got = manifests.write_markdown(spark.createDataFrame([("cat/a.md", "x"), ("ok/a.md", "y")], "path string, markdown string"), str(root)).collect()
    assert {r.path: bool(r.error) for r in got} == {"cat/a.md": True, "ok/a.md": False} and os.listdir(out) == []


@pytest.fixture(scope="module")
def library_of(spark):
    manifest = records(spark, one(0, "a"), one(1, "b/c"), one(2, "b/c/d"), one(3, "n"), one(4, None))
    return manifest, cut(texts(spark), "texts")


def old_library(root):
    put(root, a__old_DOT_md="a", b__c__old_DOT_md="c", b__c__d__e__old_DOT_md="e", b__own_DOT_md="own", INDEX_DOT_md="index", 手工__x_DOT_md="hand")
    return tree(root)


def test_a_cut_off_swap_is_taken_back(spark, tmp_path, monkeypatch, library_of):
    first = tmp_path / "first"
    first.mkdir()
    before = old_library(first)
    staged = []
    with monkeypatch.context() as m:
        m.setattr(builder, "_swap", lambda root, stage, units: staged.append((stage, units)) or (_ for _ in ()).throw(Killed()))
        m.setattr(builder, "_recover", lambda root: [])
        with pytest.raises(Killed):
            builder.rebuild(*library_of, str(first))
    assert tree(first) == before
    done, k = False, 0
    while not done:
        root = tmp_path / f"r{k}"
        shutil.copytree(first, root)
        left = [k]

        def move(at, a, b, left=left, real=contained.move):
            if not left[0]:
                raise Killed
            left[0] -= 1
            real(at, a, b)

        with monkeypatch.context() as m:
            m.setattr(contained, "move", move)
            try:
                builder._swap(str(root), *staged[0])
                done = True
            except Killed:
                pass
        assert builder.recover(str(root)) == (["done"] if done else ["swapping"])
        assert done or tree(root) == before
        k += 1
    whole = tree(root)
    assert whole["b/own.md"] == b"own" and whole["手工/x.md"] == b"hand" and "a/old.md" not in whole and "b/c/d/e/old.md" not in whole and whole["n/x.pdf.md"]
    assert k > 8 and builder.recover(str(first)) == ["staged"] and tree(first) == before


def test_a_document_that_is_not_written_leaves_the_old_library(spark, tmp_path, monkeypatch, library_of):
    before = old_library(tmp_path)
    monkeypatch.setattr(manifests, "write_markdown", lambda texts, root, below="": texts.limit(1).selectExpr("path", "0L bytes", "'no' error"))
    with pytest.raises(RuntimeError, match="not written"):
        builder.rebuild(*library_of, str(tmp_path))
    assert tree(tmp_path) == before


def test_one_rebuild_at_a_time(spark, tmp_path, library_of):
    with contained.locked(str(tmp_path), f"{builder.STAGING}/lock"), pytest.raises(RuntimeError, match="another process"):
        builder.rebuild(*library_of, str(tmp_path))


# ---- ordered files


@pytest.mark.parametrize("apart", [False, True])
def test_ordered_file(spark, tmp_path, apart):
    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("pos"), F.concat(F.lit("行 "), (F.col("id") * 31 % 11).cast("string")).alias("line")).repartition(9)
    ordered = rows.orderBy(F.desc("k"), "pos")
    n = textfile.write_ordered(ordered, str(tmp_path), "x/out.md", "head\n\n", apart)
    want = sorted(((-(i % 7), i, f"行 {i * 31 % 11}") for i in range(5000)))
    assert (tmp_path / "x/out.md").read_text() == "head\n\n" + "\n" * apart + "\n".join(x for *_, x in want) and n == os.path.getsize(tmp_path / "x/out.md")
    assert textfile.write_ordered(rows.limit(0), str(tmp_path), "x/out.md", "only") == 4 and (tmp_path / "x/out.md").read_text() == "only"
    assert os.listdir(tmp_path / "x") == ["out.md"]


def test_catalogue_and_report_keep_their_order(spark, tmp_path):
    manifest = fx.fresh(spark, SF).withColumn("chars", F.when(F.col("manifest_pos") % 3 == 0, 7).otherwise(F.col("chars")))  # ties
    manifest = cut(manifest.withColumn("quality", F.when(F.col("manifest_pos") % 5 == 1, "image").otherwise(F.col("quality"))), "manifest")
    rows = [r.asDict() for r in manifest.collect()]
    textfile.write_ordered(library.report_lines(manifest), str(tmp_path), "report.md", library.report_head(manifest), apart=True)
    lines = (tmp_path / "report.md").read_text().split("\n")
    want = []
    for q, title in library.SECTIONS.items():
        own = sorted((r for r in rows if r["quality"] == q), key=lambda r: (-(r["chars"] or 0), r["manifest_pos"]))
        want += [f"## {title} ({len(own)})", *(f"- [{'?' if r['chars'] is None else r['chars']}字] [{r['category']}] {r['name']}" for r in own)] if own else []
    assert [x for x in lines if x.startswith(("## ", "- "))] == want and "\n".join(lines) == library.report_text(manifest)
    docs = library.documents(manifest, fx.fresh_archive(spark, SF), ordered=True)
    textfile.write_ordered(library.in_order(library.catalogue(docs)), str(tmp_path), "catalogue.md")
    paths = [x.rpartition(" | ")[2] for x in (tmp_path / "catalogue.md").read_text().split("\n")]
    place = {r.path: (r.loc, -(r.chars or 0), r.manifest_pos) for r in library.located(library.usable(manifest)).collect()}
    assert paths == sorted(place, key=place.__getitem__)


# ---- the log


def test_log_of_changes(spark, tmp_path):
    root = str(tmp_path)
    assert log.read(spark, root).collect() == []
    first = records(spark, *(one(i, "a") for i in range(6)))
    assert log.append(changes.between(log.read(spark, root), first), root, "ingest", 0)
    second = first.filter("manifest_pos < 4").withColumn("note", F.when(F.col("manifest_pos") == 1, "new")).select(*MANIFEST.fieldNames())
    delta = changes.between(log.read(spark, root), second)
    assert sorted((r.op, r.manifest_pos) for r in delta.collect()) == [("drop", 4), ("drop", 5), ("put", 1)]
    assert log.append(delta, root, "ingest", 1)
    state = sorted(map(str, log.read(spark, root).collect()))
    assert state == sorted(map(str, second.collect()))
    # a batch that is run again changes nothing, whatever it has now
    assert not log.append(records(spark, one(9, "late")).withColumn("op", F.lit("put")), root, "ingest", 1)
    assert sorted(map(str, log.read(spark, root).collect())) == state
    os.makedirs(tmp_path / log.LOG / ".left-by-a-killed-run")
    assert log.compact(spark, root) == 2 and log.compact(spark, root) == 2
    assert sorted(map(str, log.read(spark, root).collect())) == state
    assert not log.append(delta, root, "ingest", 1)  # known after the deltas have gone into a base
    assert log.append(records(spark, one(9, "b")).withColumn("op", F.lit("put")), root, "removal")
    assert log.compact(spark, root) == 3
    assert not any(".ingest." in n for n in os.listdir(tmp_path / log.LOG)) and log.state(spark, root).last == {"ingest": 1, "removal": 0}
    assert log.read(spark, root).count() == 5


def test_a_killed_append_leaves_the_log(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = records(spark, one(0, "a")).withColumn("op", F.lit("put"))
    with monkeypatch.context() as m:
        m.setattr(log, "_publish", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            log.append(rows, root, "ingest", 0)
    assert log.read(spark, root).collect() == []
    assert log.append(rows, root, "ingest", 0) and log.read(spark, root).count() == 1


# ---- removal


def removable(spark, tmp_path, n=8):
    text = "long enough text"
    put(tmp_path, **{f"src__{i}_DOT_pdf": f"S{i}" for i in range(n)}, **{f"out___raw__all__{i}_DOT_txt": text for i in range(n)})
    manifest = records(spark, *(one(i, "a", f"{i}.pdf", raw_sha256=sha(text), source_sha256=sha(f"S{i}")) for i in range(n)))
    root, sources = str(tmp_path / "out"), str(tmp_path / "src")
    log.append(manifest.withColumn("op", F.lit("put")), root, "ingest")
    return manifest.select("manifest_pos", F.lit("delete").alias("decision")), root, sources


def test_an_interrupted_removal_is_settled(spark, tmp_path, monkeypatch):
    plan, root, sources = removable(spark, tmp_path)
    real = removal._unlinked

    def half(rows, *where):
        real(rows.filter("manifest_pos < 4"), *where)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(removal, "_unlinked", half)
        with pytest.raises(Killed):
            removal.remove(spark, root, plan, sources)
    assert sorted(os.listdir(sources)) == [f"{i}.pdf" for i in range(4, 8)] and not any(r.original_deleted for r in log.read(spark, root).collect())
    assert removal.recover(spark, root, sources) == 1 and removal.recover(spark, root, sources) == 0
    assert {p: r.original_deleted for p, r in by_key(log.read(spark, root)).items()} == {i: i < 4 or None for i in range(8)}
    assert all(r.deleted for r in removal.remove(spark, root, plan, sources).collect())  # goes on where it was
    assert os.listdir(sources) == [] and all(r.original_deleted for r in log.read(spark, root).collect())
    assert os.listdir(f"{root}/{removal.INTENTS}") == []


def test_removal_refuses_before_the_first_file_goes(spark, tmp_path):
    plan, root, sources = removable(spark, tmp_path)
    (tmp_path / "theirs").mkdir()
    (tmp_path / "theirs/x.pdf").write_text("theirs")
    os.symlink(tmp_path / "theirs", tmp_path / "src/d")
    for bad in ("../theirs/x.pdf", "d/x.pdf"):
        log.append(records(spark, {"manifest_pos": 20, "name": "x.pdf", "rel": bad, "quality": "image"}).withColumn("op", F.lit("put")), root, "ingest")
        more = plan.union(plan.limit(1).select(F.lit(20).cast("long"), "decision"))
        with pytest.raises(ValueError, match="nothing is removed"):
            removal.remove(spark, root, more, sources)
        assert len(os.listdir(sources)) == 9 and (tmp_path / "theirs/x.pdf").exists()


def test_recovered_marks_what_is_gone(spark):
    manifest = records(spark, *(one(i, "a", f"{i}.pdf") for i in range(4)))
    intents = spark.createDataFrame([(0, "0.pdf"), (1, "1.pdf")], "manifest_pos long, key string")
    listing = spark.createDataFrame([("1.pdf",), ("2.pdf",)], "rel string")
    assert {p: r.original_deleted for p, r in by_key(audit.recovered(manifest, intents, listing)).items()} == {0: True, 1: None, 2: None, 3: None}


# ---- repair


GARBLED = "⽂⽂⼈⼈⼤⼤" * 30 + "文字内容" * 20


def garbled(spark, tmp_path):
    bodies = {0: GARBLED, 1: "清楚的文字" * 30, 2: GARBLED + "二", 3: GARBLED + "三"}
    root = str(tmp_path)
    put(tmp_path, **{f"_raw__all__{i}_DOT_txt": t for i, t in bodies.items()})
    log.append(records(spark, *(one(i, "a", f"{i}.pdf", raw_sha256=sha(t) if i != 3 else "0" * 64) for i, t in bodies.items())).withColumn("op", F.lit("put")), root, "ingest")
    return root, bodies


def verified(spark, root):
    out = {}
    for p, r in by_key(log.read(spark, root)).items():
        out[p] = (contained.digest(root, r.raw)[0] == r.raw_sha256, r.garble_fixed)
    return out


def test_repair_changes_text_and_record(spark, tmp_path):
    root, bodies = garbled(spark, tmp_path)
    assert sorted((r.raw, r.state) for r in repair.apply(spark, root).collect()) == [("_raw/all/0.txt", "done"), ("_raw/all/2.txt", "done")]
    assert verified(spark, root) == {0: (True, True), 1: (True, None), 2: (True, True), 3: (False, None)}
    assert contained.read(root, "_raw/all/3.txt").decode() == bodies[3] and contained.read(root, "_raw/all/0.txt").decode() != bodies[0]
    row = by_key(log.read(spark, root))[0]
    assert row.chars == len(contained.read(root, "_raw/all/0.txt").decode().strip())
    assert contained.entries(root, repair.STAGING) == [] and repair.recover(spark, root) == []


@pytest.mark.parametrize("moment", ["before the commit", "after the commit", "within the swap"])
def test_an_interrupted_repair(spark, tmp_path, monkeypatch, moment):
    root, bodies = garbled(spark, tmp_path)

    def stop(*a, **k):
        raise Killed

    with monkeypatch.context() as m:
        if moment == "before the commit":
            m.setattr(log, "append", stop)
        elif moment == "after the commit":
            m.setattr(repair, "_finish", stop)
        else:
            real = repair._install
            m.setattr(repair, "_install", lambda swaps, *a: cut(real(swaps.filter("raw like '%0.txt'"), *a), "x") and stop())
        with pytest.raises(Killed):
            repair.apply(spark, root)
    if moment == "before the commit":
        assert verified(spark, root)[0] == (True, None) and contained.read(root, "_raw/all/0.txt").decode() == bodies[0]
    assert not any(fixed and fits is None for fits, fixed in verified(spark, root).values())
    assert repair.recover(spark, root) == ["forgotten" if moment == "before the commit" else "finished"]
    if moment == "before the commit":
        repair.apply(spark, root)
    assert verified(spark, root) == {0: (True, True), 1: (True, None), 2: (True, True), 3: (False, None)}


def test_repair_does_not_replace_another_text(spark, tmp_path, monkeypatch):
    root, _ = garbled(spark, tmp_path)
    real = repair._finish
    monkeypatch.setattr(repair, "_finish", lambda s, r, stage: contained.write(r, "_raw/all/0.txt", "新的文字".encode()) or real(s, r, stage))
    assert dict(sorted((r.raw, r.state) for r in repair.apply(spark, root).collect())) == {"_raw/all/0.txt": "conflict", "_raw/all/2.txt": "done"}
    assert contained.read(root, "_raw/all/0.txt").decode() == "新的文字"
    assert verified(spark, root) == {0: (False, None), 1: (True, None), 2: (True, True), 3: (False, None)}  # unverified, so its source stays


def test_shared_archive_paths_are_left_alone(spark, tmp_path):
    root, _ = garbled(spark, tmp_path)
    log.append(records(spark, one(7, "a", raw="_raw/all/0.txt", raw_sha256=sha(GARBLED))).withColumn("op", F.lit("put")), root, "ingest")
    assert [r.raw for r in repair.apply(spark, root).collect()] == ["_raw/all/2.txt"]


def test_archived_bytes_are_read_strictly(spark, tmp_path):
    put(tmp_path, _raw__all__0_DOT_txt=b"good", _raw__all__1_DOT_txt=b"bad \xff\xfe")
    got = by_key(archive.read(records(spark, one(0, "a"), one(1, "a"), one(2, "a")), str(tmp_path)), "raw")
    assert got["_raw/all/0.txt"].text == "good" and got["_raw/all/0.txt"].error is None
    assert got["_raw/all/1.txt"].text is None and "UnicodeDecodeError" in got["_raw/all/1.txt"].error and len(got) == 2
