"""Changes of a manifest as rows, and the manifest that a log of them makes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.plans.schemas import MANIFEST

PUT, DROP = "put", "drop"
_FIELDS = [f.name for f in MANIFEST.fields]


def between(before: DataFrame, after: DataFrame) -> DataFrame:
    """(op, MANIFEST fields) that turn one manifest into the other: what is new or differs is put, what is no longer there dropped.

    One equi-join on the record's position; a dropped record has no other field.
    """
    whole = lambda df, name: df.select(F.col("manifest_pos").alias(f"{name}_pos"), F.struct(*_FIELDS).alias(name))
    both = whole(before, "old").join(whole(after, "new"), F.col("old_pos") == F.col("new_pos"), "full")
    put = both.filter("new_pos is not null and not (old <=> new)").select(F.lit(PUT).alias("op"), "new.*")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in MANIFEST.fields if f.name != "manifest_pos"]
    drop = both.filter("new_pos is null").select(F.lit(DROP).alias("op"), F.col("old_pos").alias("manifest_pos"), *none)
    return put.unionByName(drop)


def fold(manifest: DataFrame, changes: DataFrame) -> DataFrame:
    """The manifest after ``changes`` (batch, op, MANIFEST fields): of each record the change of the last batch counts.

    Rows that a batch repeats, as when it was run again, change nothing.  A batch should have one change of a record; of several
    a drop goes before a put, and of puts the greatest row counts.
    """
    row = F.struct("batch", "op", *(f for f in _FIELDS if f != "manifest_pos"))
    last = changes.groupBy("manifest_pos").agg(F.max(row).alias("last"))
    kept = manifest.select(*_FIELDS).join(last.select("manifest_pos"), "manifest_pos", "left_anti").select(*_FIELDS)
    put = last.filter(F.col("last.op") == PUT).select("manifest_pos", "last.*").select(*_FIELDS)
    return kept.unionByName(put)
