"""Incremental merge of found sources into the manifest.

``plan`` decides for each source what to do without reading it again; only rows
that are to be extracted reach the extractors; ``merge`` makes the new manifest.
All steps are equi-joins on keys; nothing is collected.  What several steps read is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions import names, rules, text
from inkmill.operators import counters
from inkmill.plans.schemas import MANIFEST
from inkmill.sources.shared import cut

EXTRACTABLE = (".pdf", ".pptx", ".docx", ".doc", ".epub")
PPT_NOTE = "老格式PPT,需LibreOffice转换"
DUPLICATE_NOTE = "与epub同书"
MOBI_NOTE = "mobi无epub版,未提取"


def digests(archive: DataFrame) -> DataFrame:
    """(raw, archive_sha256, archive_bytes) of an archive (raw, text)."""
    return archive.select("raw", text.text_sha256(F.col("text")).alias("archive_sha256"), F.octet_length("text").alias("archive_bytes"))


def current(manifest: DataFrame) -> DataFrame:
    """One record per key, the last."""
    last = Window.partitionBy("key").orderBy(F.desc("manifest_pos"))
    keyed = manifest.withColumn("key", names.key(F.col("rel"), F.col("name")))
    return keyed.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def settled(quality: Column, raw: Column, raw_sha256: Column, archive_sha256: Column, archive_bytes: Column) -> Column:
    """Whether a record needs no new extraction: its text is there, and unchanged if that can be told."""
    there = raw.isNotNull() & (raw != "") & (F.coalesce(archive_bytes, F.lit(0)) > 0)
    unchanged = F.coalesce(raw_sha256 == "", F.lit(True)) | (archive_sha256 == raw_sha256)
    state = F.when(quality.isNull() | quality.isin(*rules.RETRYABLE), False).when(quality.isin(*rules.USABLE), there & unchanged)
    return F.coalesce(state.otherwise(True), F.lit(False))


def shared_raws(manifest: DataFrame) -> DataFrame:
    """Archive paths that more than one record has."""
    return manifest.filter("raw is not null and raw <> ''").groupBy("raw").agg(F.count("*").alias("n_raw")).filter("n_raw > 1")


def with_books(listing: DataFrame) -> DataFrame:
    """``duplicate_of``: the EPUB of the same path and stem, for MOBI files."""
    rel = F.col("rel")
    stemmed = listing.withColumn("_stem", names.stem(rel)).withColumn("_ext", names.extension(names.base_name(rel)))
    books = stemmed.filter("_ext = '.epub'").groupBy("_stem").agg(F.max("rel").alias("_book"))
    joined = stemmed.join(books, "_stem", "left")
    return joined.withColumn("duplicate_of", F.when(F.col("_ext") == ".mobi", F.col("_book"))).drop("_stem", "_ext", "_book")


def plan(listing: DataFrame, manifest: DataFrame, archive_digests: DataFrame, force: bool = False) -> DataFrame:
    """A row for each found source: what to do, and the record that it continues.

    ``action`` is keep or extract; ``counter`` is kept, retried, new or null (extracted
    anew for another reason).  A record is that of the same relative path or, for
    records from before paths were kept, that of the same name, suffix and size.
    """
    old = current(manifest).join(shared_raws(manifest), "raw", "left").join(archive_digests, "raw", "left")
    old = old.select(F.col("key").alias("o_key"), F.struct(*[c for c in old.columns if c != "key"]).alias("old"))
    found = with_books(listing).select(
        "rel", names.base_name(F.col("rel")).alias("name"), names.extension(names.base_name(F.col("rel"))).alias("ext"), "size", "source_sha256", "duplicate_of"
    )
    by_path = found.join(old.withColumnRenamed("old", "by_path"), F.col("rel") == F.col("o_key"), "left").drop("o_key")
    bare = old.filter("old.rel is null").select(F.col("o_key"), F.col("old").alias("by_name"))
    same = (F.col("name") == F.col("o_key")) & F.col("by_path").isNull() & (F.col("by_name.ext") == F.col("ext")) & (F.col("by_name.size") == F.col("size"))
    bound = by_path.join(bare, same, "left").withColumn("old", F.coalesce("by_path", "by_name")).drop("by_path", "by_name", "o_key")
    o = lambda c: F.col(f"old.{c}")
    has_raw = F.coalesce(o("raw") != "", F.lit(False))
    refresh = has_raw & (o("n_raw").isNotNull() | (o("raw") != names.raw_path(F.col("rel"))))
    changed = F.coalesce(o("source_sha256") != "", F.lit(False)) & ~F.coalesce(o("source_sha256") == F.col("source_sha256"), F.lit(False))
    done = settled(o("quality"), o("raw"), o("raw_sha256"), o("archive_sha256"), o("archive_bytes"))
    keep = F.col("old").isNotNull() & ~refresh & ~changed & ~F.coalesce(o("quality") == "skip_duplicate", F.lit(False)) & done & ~F.lit(force)
    retried = F.col("old").isNotNull() & (F.coalesce(o("quality").isin(*rules.RETRYABLE), F.lit(False)) | refresh)
    return bound.withColumns({
        "refresh_raw": F.col("old").isNotNull() & refresh,
        "action": F.when(keep, "keep").otherwise("extract"),
        "counter": F.when(F.col("old").isNull(), "new").when(keep, "kept").when(retried, "retried"),
    })


def failed(planned: DataFrame, extracted: DataFrame) -> DataFrame:
    """(rel, error) of the sources of this run that could not be extracted."""
    tried = planned.filter((F.col("action") == "extract") & F.col("ext").isin(*EXTRACTABLE)).select("rel")
    return extracted.filter("error is not null").select("rel", "error").join(tried, "rel", "left_semi")


#: Counters of a plan: new, kept and retried sources, and those extracted anew for another reason.
COUNTS = {
    **{f"n_{c}": (lambda c=c: F.count_if(F.col("counter") == c)) for c in ("new", "kept", "retried")},
    "n_again": lambda: F.count_if(F.col("counter").isNull()),
    "n_sources": lambda: F.count("*"),
}


def counts(planned: DataFrame) -> DataFrame:
    """One row with COUNTS."""
    return planned.agg(*(c().alias(n) for n, c in COUNTS.items()))


def counted(planned: DataFrame, extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The plan as a table, with the error of each source that could not be extracted; and COUNTS and n_failed, counted while it is written."""
    errors = extracted.filter("error is not null").groupBy("rel").agg(F.min("error").alias("failure"))
    tried = (F.col("action") == "extract") & F.col("ext").isin(*EXTRACTABLE)
    rows = planned.join(errors, "rel", "left").withColumn("failure", F.when(tried, F.col("failure")))
    return counters.counted(rows, "planned", {**{n: c() for n, c in COUNTS.items()}, "n_failed": F.count("failure")})


def merge(planned: DataFrame, manifest: DataFrame, extracted: DataFrame) -> DataFrame:
    """The new manifest: kept, extracted, then records whose source was not found, unchanged.

    ``extracted`` has a row for each source with an extractor that was to be
    extracted; an error there makes the record failed, and it keeps its
    old archive path but no fingerprints.  New records follow the old ones in order of path.
    """
    digest = text.text_sha256(F.col("text")).alias("sha256")  # before the join, so that no text is shuffled
    e = extracted.select("rel", F.struct(*[c for c in extracted.columns if c not in ("rel", "text")], digest).alias("new"))
    p = planned.join(e, "rel", "left")
    o = lambda c: F.col(f"old.{c}")
    n = lambda c: F.col(f"new.{c}")
    kept = F.col("action") == "keep"
    extractable = F.col("ext").isin(*EXTRACTABLE)
    failed = extractable & n("error").isNotNull()
    good = extractable & n("error").isNull() & F.col("new").isNotNull()
    twin = (F.col("ext") == ".mobi") & F.col("duplicate_of").isNotNull()
    ppt = F.col("ext") == ".ppt"
    changed = {
        "name": F.col("name"), "rel": F.col("rel"), "ext": F.col("ext"),
        "category": F.coalesce(o("category"), rules.classify(F.col("name"))),
        "size": F.col("size"),
        "quality": F.when(ppt, "needs_conversion").when(twin, "skip_duplicate").when(failed, "failed").when(good, n("quality")).otherwise("unsupported"),
        "unit": F.when(good, n("unit")).otherwise(o("unit")),
        "count": F.when(good, n("count")).otherwise(o("count")),
        "chars": F.when(good, n("chars")).otherwise(o("chars")),
        "raw": F.when(good, names.raw_path(F.col("rel"))).when(ppt & F.col("refresh_raw"), None).otherwise(o("raw")),
        "raw_sha256": F.when(good, n("sha256")),
        "source_sha256": F.when(good | twin, F.col("source_sha256")),
        "note": F.when(ppt, PPT_NOTE).when(twin, DUPLICATE_NOTE).when(F.col("ext") == ".mobi", MOBI_NOTE).otherwise(o("note")),
        "error": F.when(failed, n("error")).when(~good, o("error")),
        "duplicate_of": F.when(twin, F.col("duplicate_of")).otherwise(o("duplicate_of")),
        "ocr": F.when(~good, o("ocr")), "converted": F.when(~(ppt & F.col("refresh_raw")), o("converted")),
        "garble_fixed": F.when(~good, o("garble_fixed")), "original_deleted": o("original_deleted"),
    }
    fields = []
    for f in MANIFEST.fields:
        if f.name == "manifest_pos":
            value = o("manifest_pos")
        elif f.name == "rel":
            value = F.col("rel")
        else:
            value = F.when(kept, o(f.name)).otherwise(changed[f.name])
        fields.append(value.cast(f.dataType).alias(f.name))
    touched = cut(p.select(*fields, o("manifest_pos").alias("_old_pos"), F.col("old").isNull().alias("_new")), "touched")  # read three times
    base = manifest.agg(F.coalesce(F.max("manifest_pos") + 1, F.lit(0)).alias("_base"))
    fresh = numbered(touched.filter("_new").drop("_new", "_old_pos"), "rel").crossJoin(F.broadcast(base)).withColumn("manifest_pos", F.col("_base") + F.col("_rank")).drop("_base", "_rank")  # one row
    continued = touched.filter("not _new")
    gone = manifest.join(continued.select("_old_pos").filter("_old_pos is not null").distinct(), F.col("manifest_pos") == F.col("_old_pos"), "left_anti")
    cols = [f.name for f in MANIFEST.fields]
    return continued.select(*cols).unionByName(fresh.select(*cols)).unionByName(gone.select(*cols))


def numbered(df: DataFrame, by: str) -> DataFrame:
    """``_rank`` from 0 in the order of ``by``, without a single task for all rows.

    The rows are sorted by range into a table, once: ranges come from samples, which another evaluation may draw
    differently.  Each partition's count, of which there are few, shifts the next ones.
    """
    part = F.shiftright(F.col("_id"), 33)
    ranged = cut(df.repartitionByRange(by).sortWithinPartitions(by).withColumn("_id", F.monotonically_increasing_id()), "ranged")
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    shifts = sizes.withColumn("_shift", F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))  # a row for each partition
    placed = ranged.withColumn("_part", part).join(F.broadcast(shifts.select("_part", F.coalesce("_shift", F.lit(0)).alias("_shift"))), "_part")
    return placed.withColumn("_rank", F.col("_shift") + F.col("_id") - F.shiftleft(F.col("_part"), 33)).drop("_id", "_part", "_shift")
