"""A library as files: documents, catalogue, index, protocol and report, published as a whole.

A rebuild has two phases.  All files are first written and verified in a folder of their own, STAGING; the library is not touched. Then
folders and generated files are swapped by renames, the old ones kept until all is done.  A plan, written before the first rename, tells a later run
how to take back a swap that was cut off.  The files of a library are derived; the archive that they are made of is never moved.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.functions import rules
from inkmill.operators import library
from inkmill.sources import contained, manifests, textfile
from inkmill.sources.shared import cut

#: Generated files (fixed values); a search leaves them out.
CATALOGUE, INDEX, PROTOCOL, REPORT = "CATALOG.md", "INDEX.md", "SOIL.md", "提取质量报告.md"
GENERATED = (CATALOGUE, INDEX, PROTOCOL, REPORT)
CATALOGUE_HEAD = "# 目录\n\n每个文档一行: `标题 | 类目 | 字数 | 关键词 | 摘要 | 路径`。\n\n"
STAGING = ".rebuild"


def _categories(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.coalesce("category", F.lit(rules.OTHER)).alias("path")).distinct()


def check(manifest: DataFrame, root: str) -> None:
    """ValueError, before anything is touched, for an empty manifest, unsafe records, or paths that lead through a link.

    The workers look at every category's folder and every archived text's, part by part.
    """
    if not manifest.limit(1).count():
        raise ValueError("the manifest is empty")
    bad = library.unsafe(manifest).select("name").limit(5).collect()
    if bad:
        raise ValueError(f"unsafe paths: {', '.join(str(r['name']) for r in bad)}")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for path, wanted in zip(frame["path"], frame["wanted"]):
                try:
                    held = contained.kind(root, path)
                    if held and held != wanted:
                        found.append((path, f"not a {wanted}: {path}"))
                except contained.Unsafe as e:
                    found.append((path, str(e)))
            yield pd.DataFrame(found, columns=["path", "error"])

    paths = _categories(manifest).withColumn("wanted", F.lit("folder"))
    paths = paths.union(manifest.filter("raw <> ''").select("raw", F.lit("file")).distinct())
    bad = paths.mapInPandas(run, "path string, error string").limit(5).collect()
    if bad:
        raise ValueError("; ".join(r["error"] for r in bad))


def _units(manifest: DataFrame) -> list[str]:
    """What is swapped: the topmost folders of categories, of which there are few, and the generated files."""
    folders = sorted(r["path"].replace("\\", "/") for r in _categories(manifest).collect())
    top: list[str] = []
    for f in folders:
        if not any(f == t or f.startswith(f"{t}/") for t in top):
            top.append(f)
    return [*top, *GENERATED]


def _swap(root: str, stage: str, units: list[str]) -> None:
    plan = [{"unit": u, "old": contained.kind(root, u) is not None, "new": contained.kind(root, f"{stage}/new/{u}") is not None} for u in units]
    contained.write(root, f"{stage}/plan.json", json.dumps(plan).encode())
    try:
        for p in plan:
            if p["old"]:
                contained.move(root, p["unit"], f"{stage}/old/{p['unit']}")
            if p["new"]:
                contained.move(root, f"{stage}/new/{p['unit']}", p["unit"])
        contained.write(root, f"{stage}/done", b"")
    except Exception:
        _take_back(root, stage)
        raise


def _take_back(root: str, stage: str) -> None:
    """Put back what a swap has moved, the last first; each step may have been done before."""
    for p in reversed(json.loads(contained.read(root, f"{stage}/plan.json"))):
        unit, new, old = p["unit"], f"{stage}/new/{p['unit']}", f"{stage}/old/{p['unit']}"
        moved = p["new"] and contained.kind(root, new) is None
        if moved and contained.kind(root, unit) is not None and (not p["old"] or contained.kind(root, old) is not None):
            contained.move(root, unit, new)
        if p["old"] and contained.kind(root, old) is not None:
            contained.move(root, old, unit)


def recover(root: str) -> list[str]:
    """Bring a library back to a whole state after runs that were cut off; what was found: ``staged``, ``swapping`` or ``done`` for each."""
    with contained.locked(root, f"{STAGING}/lock"):
        return _recover(root)


def _recover(root: str) -> list[str]:
    found = []
    for name in contained.entries(root, STAGING):
        stage = f"{STAGING}/{name}"
        if contained.kind(root, stage) == "folder":
            state = "done" if contained.kind(root, f"{stage}/done") else "swapping" if contained.kind(root, f"{stage}/plan.json") else "staged"
            if state == "swapping":
                _take_back(root, stage)
            contained.remove_tree(root, stage)
            found.append(state)
    return found


def rebuild(manifest: DataFrame, archive: DataFrame, root: str, keep_image: bool = False, extra: str = "") -> DataFrame:
    """(path, bytes, error) of the documents written below ``root``, a folder that driver and workers share.

    Folders of the manifest's categories are replaced with all that is in them; other folders stay.  ``check`` comes first, and raises ValueError.
    A document that can't be written or doesn't read back as it was written raises RuntimeError and leaves the library as it
    was, as does a run that ends before its swap; one that is cut off within it is taken back by the next run, or by ``recover``.  A second
    run at the same time raises RuntimeError.  Catalogue and report are written by the workers, whatever their length.
    """
    with contained.locked(root, f"{STAGING}/lock"):
        _recover(root)
        check(manifest, root)
        stage = f"{STAGING}/{uuid.uuid4().hex}"
        new = f"{stage}/new"
        try:
            docs = cut(library.documents(manifest, archive, keep_image, ordered=True), "library")
            texts = library.markdown(docs)
            written = cut(manifests.write_markdown(texts, root, new), "written")
            broken = manifests.unlike(texts, root, new).limit(5).collect()
            if broken:
                raise RuntimeError("documents were not written: " + "; ".join(f"{r['path']}: {r['error']}" for r in broken))
            textfile.write_ordered(library.in_order(library.catalogue(docs)), root, f"{new}/{CATALOGUE}", CATALOGUE_HEAD)
            textfile.write_ordered(library.report_lines(manifest), root, f"{new}/{REPORT}", library.report_head(manifest), apart=True)
            contained.write(root, f"{new}/{PROTOCOL}", library.protocol_text(manifest, keep_image).encode())
            contained.write(root, f"{new}/{INDEX}", library.index_text(manifest, keep_image, extra).encode())
            _swap(root, stage, _units(manifest))
        finally:
            _recover(root)
        return written
