"""Decisions of a stream by state, against the plan of a batch."""

import datetime

from pyspark.sql import functions as F

from inkmill.operators import incremental
from inkmill.plans import fixtures as fx
from inkmill.sources.shared import cut
from inkmill.streaming import stateful
from tests.compare import SF

SCHEMA = "rel string, size long, source_sha256 string, found_at timestamp"
T0 = datetime.datetime(2024, 1, 1)


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def run(spark, tmp_path, start):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stateful.decide(stream, start).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    return {(r.rel, r.found_at): (r.action, r.source_sha256) for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def feed(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_late_and_repeated_files_and_a_restart(spark, tmp_path):
    start = spark.createDataFrame([("old", "A", True), ("open", "A", False), ("legacy", None, True)], "rel string, source_sha256 string, settled boolean")
    feed(spark, tmp_path, [("old", 1, "A", at(1)), ("open", 1, "A", at(1)), ("new", 1, "N", at(1)), ("legacy", 1, "L", at(1)), ("new", 1, "N", at(1)), ("gone bad", None, None, at(1))])
    assert run(spark, tmp_path, start) == {("old", at(1)): ("keep", "A"), ("open", at(1)): ("extract", "A"), ("new", at(1)): ("extract", "N"), ("legacy", at(1)): ("keep", "L"), ("gone bad", at(1)): ("extract", None)}
    feed(spark, tmp_path, [("old", 2, "B", at(5)), ("new", 1, "N", at(6)), ("open", 1, "A", at(5))])
    feed(spark, tmp_path, [("old", 1, "A", at(3)), ("new", 1, "N", at(6)), ("old", 2, "B", at(5)), ("new", 2, "M", at(9)), ("legacy", 1, "K", at(9))])  # late, repeated, new
    got = run(spark, tmp_path, start.limit(0))  # a restart has its state from the checkpoint
    assert {k: v for k, v in got.items() if k[1] > at(1)} == {("old", at(5)): ("extract", "B"), ("new", at(6)): ("keep", "N"), ("open", at(5)): ("keep", "A"), ("new", at(9)): ("extract", "M"), ("legacy", at(9)): ("extract", "K")}


def test_stream_decides_as_the_batch(spark, tmp_path):
    manifest = cut(fx.prior(spark, SF).filter("rel is not null"), "manifest")
    digests = incremental.digests(fx.archive(spark, SF))
    listing = cut(fx.listing(spark, SF), "listing")
    listing.withColumn("found_at", F.lit(at(1))).repartition(3).write.parquet(str(tmp_path / "in"))
    want = {r.rel: r.action for r in incremental.plan(listing, manifest, digests).collect()}
    got = {rel: action for (rel, _), (action, _) in run(spark, tmp_path, stateful.known(manifest, digests)).items()}
    assert got == want and len(set(want.values())) == 2


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path, monkeypatch):
    import pytest

    from inkmill.plans.schemas import LISTING
    from inkmill.sources import log
    from inkmill.streaming import ingest
    from tests.test_sources import sha

    root = str(tmp_path / "lib")
    listed = [[("a.pdf", 1, "A1"), ("b.pdf", 1, "B1")], [("a.pdf", 2, "A2"), ("c.txt", 1, "C1")]]
    tried = []

    def extract(rows):
        tried.append(sorted(r.rel for r in rows.collect()))
        own = F.concat(F.col("rel"), F.lit(" "), F.col("source_sha256"))
        return rows.filter("ext = '.pdf'").select("rel", own.alias("text"), F.lit("pages").alias("unit"), F.lit(1).alias("count"), F.length(own).alias("chars"), F.lit("text").alias("quality"), F.lit(None).cast("string").alias("error"), "source_sha256")

    def start():
        stream = spark.readStream.schema(LISTING).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        ingest.ingest_to_log(stream, root, extract).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()

    def state():
        return sorted((r.manifest_pos, r.rel, r.quality, r.raw_sha256, r.source_sha256) for r in log.read(spark, root).collect())

    spark.createDataFrame(listed[0], LISTING).coalesce(1).write.parquet(str(tmp_path / "in"))
    start()
    first = state()
    assert first == [(0, "a.pdf", "text", sha("a.pdf A1"), "A1"), (1, "b.pdf", "text", sha("b.pdf B1"), "B1")]
    spark.createDataFrame(listed[1], LISTING).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    real = log.append
    with monkeypatch.context() as m:  # the driver is lost before the commit
        m.setattr(log, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            start()
    assert state() == first
    with monkeypatch.context() as m:  # and right after it, before the stream's own checkpoint
        m.setattr(log, "append", lambda *a: real(*a) and (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            start()
    second = state()
    assert second == [(0, "a.pdf", "text", sha("a.pdf A2"), "A2"), (1, "b.pdf", "text", sha("b.pdf B1"), "B1"), (2, "c.txt", "unsupported", None, None)]
    start()
    assert state() == second and tried == [["a.pdf", "b.pdf"], ["a.pdf", "c.txt"], ["a.pdf", "c.txt"]] and log.state(spark, root).last == {"stream": 1}
