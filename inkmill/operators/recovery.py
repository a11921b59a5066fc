"""Records that become usable later: recognised scanned books and converted old slides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions import names, text
from inkmill.plans.schemas import MANIFEST


def conversion_candidates(manifest: DataFrame) -> DataFrame:
    """Old slides that wait for their conversion."""
    return manifest.filter("quality = 'needs_conversion'")


def _updated(manifest: DataFrame, done: DataFrame, candidates: DataFrame, good: dict[str, Column], bad: dict[str, Column]) -> DataFrame:
    """The manifest with the fields of ``good`` or ``bad`` where ``done`` has a text or an error for a candidate's key."""
    tried = done.select(F.col("rel").alias("_key"), F.struct(*[c for c in done.columns if c != "rel"]).alias("new"))
    rows = candidates.select(names.key(F.col("rel"), F.col("name")).alias("_key"), F.col("manifest_pos").alias("_pos")).join(tried, "_key")
    joined = manifest.join(rows, F.col("manifest_pos") == F.col("_pos"), "left")
    failed = F.col("new.error").isNotNull()
    read = ~failed & F.col("new.text").isNotNull()

    def value(f) -> Column:
        own = F.col(f.name)
        own = F.when(F.coalesce(read, F.lit(False)), good[f.name].cast(f.dataType)).otherwise(own) if f.name in good else own
        return (F.when(failed, bad[f.name].cast(f.dataType)).otherwise(own) if f.name in bad else own).alias(f.name)

    return joined.select(*map(value, MANIFEST.fields))


def _archived() -> dict[str, Column]:
    """Place and fingerprints of a text that is archived under its source's key."""
    return {
        "raw": names.raw_path(F.col("_key")),
        "raw_sha256": text.text_sha256(F.col("new.text")),
        "source_sha256": F.col("new.source_sha256"),
        "count": F.col("new.count"),
        "chars": F.col("new.chars"),
    }


def recognised(manifest: DataFrame, done: DataFrame, candidates: DataFrame) -> DataFrame:
    """The manifest after OCR: ``done`` (rel, text, chars, count, error, source_sha256) makes candidates texts.

    A book that could not be read, or whose source changed meanwhile, stays as it is and can be tried again.
    """
    return _updated(manifest, done, candidates, {**_archived(), "quality": F.lit("text"), "ocr": F.lit(True)}, {})


def converted(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """The manifest after conversion: ``done`` as the extractors return it; what failed is failed, with its error."""
    good = {**_archived(), "quality": F.col("new.quality"), "unit": F.lit("slides"), "converted": F.lit(True), "error": F.lit(None)}
    return _updated(manifest, done, conversion_candidates(manifest), good, {"quality": F.lit("failed"), "error": F.col("new.error")})


def archived_texts(done: DataFrame) -> DataFrame:
    """(raw, text) to archive of ``done``."""
    return done.filter("error is null and text is not null").select(names.raw_path(F.col("rel")).alias("raw"), "text")
