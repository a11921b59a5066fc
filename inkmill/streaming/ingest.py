"""Incremental runs as micro-batches: an extension of the batch merge, with the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from inkmill.operators import changes, incremental, recovery
from inkmill.sources import archive, log
from inkmill.sources.shared import cut


def ingest(listings: DataFrame, load: Callable[[], tuple[DataFrame, DataFrame]], extract: Callable[[DataFrame], DataFrame], commit: Callable[[DataFrame, DataFrame, int], None]) -> DataStreamWriter:
    """A writer that merges each micro-batch of a streaming listing (rel, size, source_sha256).

    ``load`` returns manifest and archive; ``extract`` reads the planned rows; ``commit`` stores
    manifest and extracted rows under the batch's number, and must be idempotent by it, as a batch can be run again.  ``ingest_to_log`` has one that is.
    """

    def batch(rows: DataFrame, number: int) -> None:
        manifest, archive_ = load()
        last = rows.dropDuplicates(["rel"])
        planned = incremental.plan(last, manifest, incremental.digests(archive_))
        done = extract(planned.filter("action = 'extract'"))
        commit(incremental.merge(planned, manifest, done), done, number)

    return listings.writeStream.foreachBatch(batch)


WRITER = "stream"


def ingest_to_log(listings: DataFrame, root: str, extract: Callable[[DataFrame], DataFrame]) -> DataStreamWriter:
    """As ``ingest``, with the manifest's log and the archive at ``root``: each micro-batch is one append, under its number.

    Texts are written first.  A batch that is run again, as after a lost driver, either finds its number taken and does nothing, or finds the log as
    it was and does the same again.  A log takes one stream; its checkpoint goes with it.
    """
    spark = listings.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        if number <= log.state(spark, root).last.get(WRITER, -1):
            return
        before = cut(log.read(spark, root), "before")
        texts = archive.read(before, root).filter("error is null").select("raw", "text")
        planned = cut(incremental.plan(rows.dropDuplicates(["rel"]), before, incremental.digests(texts)), "planned")
        done = cut(extract(planned.filter("action = 'extract'")), "extracted")
        wrote = cut(archive.write(recovery.archived_texts(done), root), "archived")
        lost = wrote.filter("error is not null").select("raw", F.lit(True).alias("_lost"))
        after = incremental.merge(planned, before, done).join(lost, "raw", "left")
        safe = after.withColumn("raw_sha256", F.when(F.col("_lost").isNull(), F.col("raw_sha256"))).select(*before.columns)
        log.append(changes.between(before, safe), root, WRITER, number)

    return listings.writeStream.foreachBatch(batch)
