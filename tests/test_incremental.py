import pytest
from pyspark.sql import functions as F

from inkmill.operators import incremental
from inkmill.plans import fixtures
from inkmill.sources import shared
from tests.compare import SF


def test_ranks_at_size(spark):
    rows = spark.range(400_000).select(F.concat(F.lit("d/"), F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("rel"))
    got = incremental.numbered(rows.repartition(7), "rel").select("rel", "_rank")
    again = got.selectExpr("count(distinct _rank) n", "min(_rank) low", "max(_rank) high").first()
    assert (again.n, again.low, again.high) == (400_000, 0, 399_999)
    first = [r.rel for r in got.orderBy("_rank").limit(100).collect()]
    assert first == [r.rel for r in rows.orderBy("rel").limit(100).collect()]


def test_ranks_of_few_rows(spark):
    assert incremental.numbered(spark.createDataFrame([], "rel string"), "rel").collect() == []
    assert [r._rank for r in incremental.numbered(spark.createDataFrame([("a",)], "rel string"), "rel").collect()] == [0]


def test_failed_sources_are_counted(spark):
    planned, extracted = fixtures.planned(spark, SF), fixtures.extracted(spark, SF)
    counts = incremental.counted(planned, extracted)[1].first().asDict()
    plain = incremental.counts(planned).first().asDict()
    tried = {r.rel for r in planned.filter("action = 'extract'").collect()}
    broken = {r.rel for r in extracted.filter("error is not null").collect()}
    assert counts == {**plain, "n_failed": len(tried & broken)} and counts["n_failed"] > 0


def test_shared_folder_needs_a_setting_on_a_cluster(spark, tmp_path):
    class Context:
        master = "spark://somewhere:7077"
        _jsc = None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    class Held:
        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isDefined(self):
            return False

    Session.sparkContext._jsc = Held()
    with pytest.raises(RuntimeError):
        shared.shared_dir(Session())
    table = shared.cut(spark.range(5).toDF("x"), "five")
    assert table.count() == 5
    shared.drop(table)
    assert "five-" in table._shared_path
    with pytest.raises(Exception):
        spark.read.parquet(table._shared_path)


