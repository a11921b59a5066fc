"""Repair of garbled archived texts: archive and manifest change by one commit, and only where the recorded text still is.

1. Repaired texts are written beside the archive, with the fingerprints before and after.
2. One append to the manifest's log commits them all.  Until then nothing has changed; after it, a run that was cut off is finished by the next.
3. Each text is put in place if the archive still has the one that was repaired.  Where it doesn't, the record gets back what it had.

At every moment a record's fingerprint is that of its text, or its text is one that no audit takes as verified, so its source is never removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import han
from inkmill.operators import audit, changes
from inkmill.plans.schemas import MANIFEST
from inkmill.sources import archive, contained, log
from inkmill.sources.shared import cut

STAGING = ".repair"
WRITER = "repair"
_SWAPS = "raw string, old_sha256 string, new_sha256 string"


def _install(swaps: DataFrame, root: str, stage: str) -> DataFrame:
    """(raw, state) of each (raw, old_sha256, new_sha256): ``done``, or ``conflict`` where the archive has another text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for raw, old, new in zip(frame["raw"], frame["old_sha256"], frame["new_sha256"]):
                state = "conflict"
                try:
                    now = contained.digest(root, raw)[0]
                    if now == old != new:
                        if contained.digest(root, f"{stage}/texts/{raw}")[0] == new:
                            contained.move(root, f"{stage}/texts/{raw}", raw)
                            state = "done"
                    elif now == new:  # an earlier attempt put it there
                        state = "done"
                except (FileNotFoundError, contained.Unsafe):
                    pass
                out.append((raw, state))
            yield pd.DataFrame(out, columns=["raw", "state"])

    return swaps.mapInPandas(run, "raw string, state string")


def _finish(spark: SparkSession, root: str, stage: str) -> DataFrame:
    """Put committed texts in place, give records in conflict back what they had; (raw, state)."""
    done = cut(_install(spark.read.schema(_SWAPS).parquet(f"{root}/{stage}/swaps"), root, stage), "installed")
    lost = done.filter("state = 'conflict'").select("raw").distinct()
    before = spark.read.schema(MANIFEST).parquet(f"{root}/{stage}/before").join(lost, "raw", "left_semi").select(*MANIFEST.fieldNames())
    if before.limit(1).count():
        log.append(before.withColumn("op", F.lit(changes.PUT)), root, WRITER)
    contained.remove_tree(root, stage)
    return done


def apply(spark: SparkSession, root: str, radicals: float = han.MAX_RADICALS, repeats: float = han.MAX_REPEATS) -> DataFrame:
    """Repair the garbled texts of the archive at ``root``, whose manifest is in the log there; (raw, state).

    Texts that aren't as recorded are left alone, as are those whose archive path several records share: a repair of one would break the others'.
    """
    recover(spark, root)
    manifest = log.read(spark, root)
    shared = manifest.filter("raw <> ''").groupBy("raw").count().filter("count > 1").select("raw")
    own = manifest.join(shared, "raw", "left_anti").select(*MANIFEST.fieldNames())
    fixed = cut(audit.repaired(own, archive.read(own, root).filter("error is null").select("raw", "text"), radicals, repeats), "repaired")
    stage = f"{STAGING}/{uuid.uuid4().hex}"
    staged = cut(archive.write(fixed.select(F.concat(F.lit(f"{stage}/texts/"), "raw").alias("raw"), "text"), root), "staged")
    bad = staged.filter("error is not null").limit(5).collect()
    if bad:
        contained.remove_tree(root, stage)
        raise RuntimeError("; ".join(r["error"] for r in bad))
    old = own.select("manifest_pos", F.col("raw_sha256").alias("old_sha256"))
    fixed.join(old, "manifest_pos").select("raw", "old_sha256", F.col("raw_sha256").alias("new_sha256")).write.parquet(f"{root}/{stage}/swaps")
    own.join(fixed.select("manifest_pos"), "manifest_pos", "left_semi").select(*MANIFEST.fieldNames()).write.parquet(f"{root}/{stage}/before")
    number = log.state(spark, root).last.get(WRITER, -1) + 1
    contained.write(root, f"{stage}/number", str(number).encode())
    log.append(fixed.select(F.lit(changes.PUT).alias("op"), *MANIFEST.fieldNames()), root, WRITER, number)  # the commit
    return _finish(spark, root, stage)


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finish repairs that were cut off after their commit, and forget those before it; which it was, for each."""
    found = []
    for name in contained.entries(root, STAGING):
        stage = f"{STAGING}/{name}"
        try:
            number = int(contained.read(root, f"{stage}/number"))
        except FileNotFoundError:
            number = None
        if number is not None and number <= log.state(spark, root).last.get(WRITER, -1):
            _finish(spark, root, stage)
            found.append("finished")
        else:
            contained.remove_tree(root, stage)
            found.append("forgotten")
    return found
