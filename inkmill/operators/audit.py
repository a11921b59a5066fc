"""Audits of the archive and the library, and the plan for removing archived sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.functions import han, names, rules, text
from inkmill.operators import counters, incremental, library
from inkmill.sources.shared import cut

SHORT_BODY, SHORT_BOOK_PAGES, SHORT_BOOK_CHARS = 30, 20, 50
LEAST_BYTES = 10


def archive_status(manifest: DataFrame, archive: DataFrame) -> DataFrame:
    """(manifest_pos, name, status, short_book) of usable records.

    The first of noraw, unverified, empty and garbled that holds, else ok; a short
    scanned book is ok and marked.
    """
    rows = manifest.filter(F.col("quality").isin(*rules.USABLE)).join(archive, "raw", "left")
    known = F.coalesce((F.col("raw_sha256") != "") & (text.text_sha256(F.col("text")) == F.col("raw_sha256")), F.lit(False))
    status = (
        F.when(F.col("text").isNull(), "noraw")
        .when(~known, "unverified")
        .when(text.chars(F.col("text")) < SHORT_BODY, "empty")
        .when(han.garbled(F.col("text")), "garbled")
        .otherwise("ok")
    )
    pages = F.coalesce("count", F.lit(0))
    short = F.coalesce("ocr", F.lit(False)) & (pages >= SHORT_BOOK_PAGES) & (F.coalesce("chars", F.lit(0)) < pages * SHORT_BOOK_CHARS)
    return rows.select("manifest_pos", "name", status.alias("status"), (short & (status == "ok")).alias("short_book"))


#: Counters of ``archive_status``, in the order of a summary.
STATUS_COUNTS = {
    "checked": lambda: F.count_if(F.col("status") != "noraw"),
    **{s: (lambda s=s: F.count_if(F.col("status") == s)) for s in ("ok", "empty", "garbled", "noraw", "unverified")},
    "short_book": lambda: F.count_if("short_book"),
    "healthy": lambda: F.count_if((F.col("status") != "ok") | F.col("short_book")) == 0,
}


def status_counts(status: DataFrame) -> DataFrame:
    return status.agg(*(c().alias(n) for n, c in STATUS_COUNTS.items()))


def verified(manifest: DataFrame, archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``archive_status`` as a table, and ``status_counts``, counted while it is written."""
    return counters.counted(archive_status(manifest, archive), "status", {n: c() for n, c in STATUS_COUNTS.items()})


def expected(manifest: DataFrame) -> DataFrame:
    """(path, name) that the library should have, images left out."""
    return library.located(library.usable(manifest)).select("path", "name")


def missing(manifest: DataFrame, paths: DataFrame) -> DataFrame:
    """Expected documents that the library (path) lacks."""
    return expected(manifest).join(paths.select("path"), "path", "left_anti")


def _within(manifest: DataFrame, paths: DataFrame) -> DataFrame:
    """Paths below a category's folder, at any depth."""
    folders = F.slice(F.split("path", "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(0)))
    above = F.transform(folders, lambda x, i: F.array_join(F.slice(folders, F.lit(1), i + 1), "/"))
    cats = manifest.select(F.coalesce("category", F.lit(rules.OTHER)).alias("_cat")).distinct()
    return paths.select("path", F.explode(above).alias("_cat")).join(cats, "_cat", "left_semi").select("path").distinct()


def orphans(manifest: DataFrame, paths: DataFrame) -> DataFrame:
    """Library documents in the manifest's categories that no record expects."""
    own = _within(manifest, paths.filter(F.col("path").endswith(".md")))
    return own.join(expected(manifest).select("path"), "path", "left_anti")


def consistency(manifest: DataFrame, paths: DataFrame) -> DataFrame:
    """One row: whether the library is built, and how many documents it lacks and has too many; null if it isn't built."""
    built = _within(manifest, paths).agg((F.count("*") > 0).alias("built"))
    counts = missing(manifest, paths).agg(F.count("*").alias("n_missing")).crossJoin(F.broadcast(orphans(manifest, paths).agg(F.count("*").alias("n_orphans"))))  # one row each
    return built.crossJoin(F.broadcast(counts)).select("built", *(F.when(F.col("built"), F.col(c)).alias(c) for c in ("n_missing", "n_orphans")))


def shown(rows: DataFrame, most: int = 10) -> DataFrame:
    """What a summary lists: the first rows by path; counts are never taken from it."""
    return rows.orderBy("path").limit(most)


def at_stake(manifest: DataFrame) -> DataFrame:
    """One row: images and failed sources, whose content no archive has."""
    return manifest.agg(F.count_if(F.col("quality") == "image").alias("n_images"), F.count_if(F.col("quality") == "failed").alias("n_failed"))


def removal_plan(manifest: DataFrame, sources: DataFrame, archive: DataFrame, delete_image: bool = False) -> DataFrame:
    """(manifest_pos, key, name, quality, size, decision): delete, keep or no_archive for each record whose source is there.

    A text may be deleted if its source and its archived text still have the recorded fingerprints; a
    duplicate if that holds for the book that it duplicates (the last record of that key) and for itself.
    """
    keyed = manifest.withColumn("key", names.key(F.col("rel"), F.col("name")))
    m = keyed.join(incremental.digests(archive), "raw", "left")
    m = m.join(sources.select(F.col("rel").alias("key"), F.col("size").alias("now_size"), F.col("source_sha256").alias("now_sha256")), "key", "left")
    same_source = F.coalesce((F.col("source_sha256") != "") & (F.col("source_sha256") == F.col("now_sha256")), F.lit(False))
    archived = F.col("quality").isin(*rules.USABLE) & (F.length("raw_sha256") == 64) & (F.col("archive_bytes") > LEAST_BYTES) & (F.col("archive_sha256") == F.col("raw_sha256"))
    m = m.withColumn("same", same_source).withColumn("proven", same_source & F.coalesce(archived, F.lit(False)))
    books = m.groupBy(F.col("key").alias("duplicate_of")).agg(F.max_by("proven", "manifest_pos").alias("book_proven"))
    rows = m.filter("now_size is not null").join(books, "duplicate_of", "left")
    twin = F.col("quality") == "skip_duplicate"
    verified = F.when(twin, F.col("same") & F.coalesce("book_proven", F.lit(False))).otherwise(F.col("proven"))
    decision = (
        F.when(twin | F.col("quality").isin(*rules.USABLE), F.when(verified, "delete").otherwise("no_archive"))
        .when(F.col("quality").isin("image", "failed"), "delete" if delete_image else "keep")
        .otherwise("keep")
    )
    return rows.select("manifest_pos", "key", "name", "quality", F.col("now_size").alias("size"), decision.alias("decision"))


def removal_order(plan: DataFrame) -> DataFrame:
    """Rows to delete, duplicates first: their books must still be there to be checked again."""
    return plan.filter("decision = 'delete'").orderBy((F.col("quality") != "skip_duplicate").cast("int"), "manifest_pos")


def removal_bytes(plan: DataFrame) -> DataFrame:
    out = plan.groupBy("decision").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    return out.withColumn("label", text.bytes_label(F.col("bytes")))


def garbled_records(manifest: DataFrame, archive: DataFrame, radicals: float = han.MAX_RADICALS, repeats: float = han.MAX_REPEATS) -> DataFrame:
    """Usable records whose archived text is as recorded and garbled, with the text."""
    rows = manifest.filter(F.col("quality").isin(*rules.USABLE)).join(archive, "raw")
    return rows.filter((text.text_sha256(F.col("text")) == F.col("raw_sha256")) & han.garbled(F.col("text"), radicals, repeats))


def repaired(manifest: DataFrame, archive: DataFrame, radicals: float = han.MAX_RADICALS, repeats: float = han.MAX_REPEATS) -> DataFrame:
    """``garbled_records`` after the repair: text, chars, fingerprint and garble_fixed are new."""
    fixed = garbled_records(manifest, archive, radicals, repeats).withColumn("text", han.repair(F.col("text")))
    return fixed.withColumns({"chars": text.chars(F.col("text")), "raw_sha256": text.text_sha256(F.col("text")), "garble_fixed": F.lit(True)})


def safe_rows(manifest: DataFrame) -> DataFrame:
    return manifest.filter(names.safe(names.key(F.col("rel"), F.col("name"))))


def marked(manifest: DataFrame, gone: DataFrame) -> DataFrame:
    """The manifest with ``original_deleted`` for the records of ``gone`` (manifest_pos)."""
    pos = gone.select(F.col("manifest_pos").alias("_pos")).distinct()
    rows = manifest.join(pos, F.col("manifest_pos") == F.col("_pos"), "left")
    return rows.withColumn("original_deleted", F.when(F.col("_pos").isNotNull(), True).otherwise(F.col("original_deleted"))).select(*manifest.columns)


def recovered(manifest: DataFrame, intents: DataFrame, sources: DataFrame) -> DataFrame:
    """The manifest after a removal that was cut off: records with an intent (manifest_pos, key) are marked if their source (rel) is gone."""
    return marked(manifest, intents.join(sources.select(F.col("rel").alias("key")), "key", "left_anti"))


def swapped(manifest: DataFrame, archive: DataFrame, repaired: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manifest and archive after ``repaired`` (MANIFEST fields, text) is committed: a text and its record change together, or not at all.

    They change only if the archive still has the text that the record names, and no other record names it.
    """
    holders = manifest.filter("raw <> ''").groupBy("raw").agg(F.count("*").alias("_holders"))
    now = manifest.select("manifest_pos", F.col("raw_sha256").alias("_known")).join(repaired.withColumn("_new", F.col("text")).drop("text"), "manifest_pos")
    now = now.join(archive.select("raw", F.col("text").alias("_old")), "raw").join(holders, "raw")
    good = cut(now.filter((text.text_sha256(F.col("_old")) == F.col("_known")) & (F.col("_holders") == 1)), "swapped")  # read four times
    records = manifest.join(good.select("manifest_pos"), "manifest_pos", "left_anti").select(*manifest.columns).unionByName(good.select(*manifest.columns))
    texts = archive.join(good.select("raw"), "raw", "left_anti").select("raw", "text").unionByName(good.select("raw", F.col("_new").alias("text")))
    return records, texts
