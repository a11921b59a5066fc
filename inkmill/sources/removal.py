"""Removal of archived sources: what a plan allows, checked again file by file, with intents that outlive the driver.

What is to be removed is written down before the first file goes.  A run that is cut off is found by the next one, which tells by the folder
what had been removed and marks it in the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import names
from inkmill.operators import audit, changes
from inkmill.sources import contained, log
from inkmill.sources.shared import cut, file_system

INTENTS = ".removal"
WRITER = "removal"


def _digest(root: str, path: str | None) -> tuple[str | None, int]:
    try:
        return contained.digest(root, path) if path else (None, 0)
    except (FileNotFoundError, contained.Unsafe):
        return None, 0


def _remove(rows: DataFrame, sources: str, archive: str) -> DataFrame:
    """Rows of ``intents`` to (manifest_pos, deleted, error)."""

    def proven(source: str, wanted: str | None, raw: str | None, raw_wanted: str | None) -> bool:
        found, size = _digest(archive, raw)
        return bool(wanted) and _digest(sources, source)[0] == wanted and bool(raw_wanted) and found == raw_wanted and size > audit.LEAST_BYTES

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples():
                error = None
                try:
                    if contained.kind(sources, r.key) is not None:  # else an earlier attempt of this task removed it
                        own = not r.twin or _digest(sources, r.key)[0] == r.source_sha256
                        if r.checked and not (own and proven(r.book, r.book_sha256, r.raw, r.raw_sha256)):
                            error = "the source changed, or its archived text is not as recorded"
                        else:
                            contained.unlink(sources, r.key)
                except (OSError, contained.Unsafe) as e:
                    error = f"{type(e).__name__}: {e}"
                out.append((r.manifest_pos, error is None, error))
            yield pd.DataFrame(out, columns=["manifest_pos", "deleted", "error"])

    return rows.mapInPandas(run, "manifest_pos long, deleted boolean, error string")


def intents(manifest: DataFrame, plan: DataFrame) -> DataFrame:
    """(manifest_pos, key, twin, checked, source_sha256, book, book_sha256, raw, raw_sha256) of what ``plan`` decided to delete.

    What is checked are the fingerprints of the source and of the archived text, for a duplicate also those of the book that it
    duplicates.  Images and failed sources, which are in the plan only on demand, have nothing to check.
    """
    records = manifest.withColumn("key", names.key(F.col("rel"), F.col("name")))
    books = records.select(F.col("key").alias("book"), F.col("source_sha256").alias("book_sha256"), F.col("raw").alias("book_raw"), F.col("raw_sha256").alias("book_raw_sha256"))
    rows = plan.filter("decision = 'delete'").select("manifest_pos").join(records, "manifest_pos")
    twin = F.col("quality") == "skip_duplicate"
    return rows.join(books, F.when(twin, F.col("duplicate_of")) == F.col("book"), "left").select(
        "manifest_pos", "key", twin.alias("twin"), (~F.col("quality").isin("image", "failed")).alias("checked"), "source_sha256",
        F.coalesce("book", "key").alias("book"), F.when(twin, F.col("book_sha256")).otherwise(F.col("source_sha256")).alias("book_sha256"),
        F.when(twin, F.col("book_raw")).otherwise(F.col("raw")).alias("raw"), F.when(twin, F.col("book_raw_sha256")).otherwise(F.col("raw_sha256")).alias("raw_sha256"),
    )


def _kinds(rows: DataFrame, sources: str) -> DataFrame:
    """(manifest_pos, there, error): whether the file of each (manifest_pos, key) is there; paths that may not be used are an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for pos, key in zip(frame["manifest_pos"], frame["key"]):
                try:
                    out.append((pos, contained.kind(sources, key or "") is not None, None))
                except (OSError, contained.Unsafe) as e:
                    out.append((pos, True, str(e)))
            yield pd.DataFrame(out, columns=["manifest_pos", "there", "error"])

    return rows.select("manifest_pos", "key").mapInPandas(run, "manifest_pos long, there boolean, error string")


def _refuse(rows: DataFrame, sources: str) -> None:
    bad = _kinds(rows, sources).filter("error is not null").limit(5).collect()
    if bad:
        raise ValueError("nothing is removed: " + "; ".join(r["error"] for r in bad))


def _unlinked(rows: DataFrame, sources: str, archive: str) -> DataFrame:
    first = cut(_remove(rows.filter("twin"), sources, archive), "removed")  # while their books are there
    return first.union(cut(_remove(rows.filter("not twin"), sources, archive), "removed"))


def apply(manifest: DataFrame, plan: DataFrame, sources: str, archive: str) -> tuple[DataFrame, DataFrame]:
    """Remove what ``plan`` decided to delete; the manifest with ``original_deleted`` set, and (manifest_pos, deleted, error).

    All paths are looked at first: one that may leave ``sources``, or leads through a link, raises ValueError and nothing is
    removed.  Then each file is checked once more right before; one that fails stays, with its error, and others go on.  Duplicates go first.
    ``sources`` and ``archive`` are folders that the workers share.  ``remove`` also keeps the state in the manifest's log.
    """
    rows = cut(intents(manifest, plan), "to-remove")
    _refuse(rows, sources)
    done = _unlinked(rows, sources, archive)
    return audit.marked(manifest, done.filter("deleted")), done


def remove(spark: SparkSession, root: str, plan: DataFrame, sources: str) -> DataFrame:
    """As ``apply``, for the manifest in the log at ``root``, which also has the archive; (manifest_pos, deleted, error).

    The intents are written before the first file goes and stay until the log has what became of them.
    """
    recover(spark, root, sources)
    manifest = log.read(spark, root)
    rows = cut(intents(manifest, plan), "to-remove")
    _refuse(rows, sources)
    run = f"{root}/{INTENTS}/{uuid.uuid4().hex}"
    fs, where = file_system(spark, run)
    rows.write.parquet(f"{run}.part")
    fs.rename(file_system(spark, f"{run}.part")[1], where)
    done = _unlinked(spark.read.schema(rows.schema).parquet(run), sources, root)
    _close(spark, root, run, manifest, done.filter("deleted"))
    return done


def _close(spark: SparkSession, root: str, run: str, manifest: DataFrame, gone: DataFrame) -> None:
    log.append(changes.between(manifest, audit.marked(manifest, gone)), root, WRITER)
    fs, where = file_system(spark, run)
    fs.delete(where, True)


def recover(spark: SparkSession, root: str, sources: str) -> int:
    """Settle runs that were cut off: their sources that are gone are marked in the log; how many runs there were.

    Sources that are still there stay.  Intents that were not written to their end never led to a removal.
    """
    fs, where = file_system(spark, f"{root}/{INTENTS}")
    found = sorted(x.getPath().getName() for x in fs.listStatus(where)) if fs.exists(where) else []
    for name in found:
        path = f"{root}/{INTENTS}/{name}"
        if name.endswith(".part"):
            fs.delete(file_system(spark, path)[1], True)
            continue
        rows = spark.read.parquet(path)
        gone = cut(_kinds(rows, sources).filter("not there"), "gone")
        _close(spark, root, path, log.read(spark, root), gone)
    return sum(not n.endswith(".part") for n in found)
