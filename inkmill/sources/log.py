"""The manifest as an append-only log of changes on a base.

``root``/manifest-log has folders ``base-N`` and ``delta-N.writer.number``, each put in place by one rename: it is there
whole, or not at all.  A writer numbers its batches; one that is run again finds its number taken and changes nothing.  Readers fold
the deltas after the last base into it.  One process writes at a time.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.operators import changes
from inkmill.plans.schemas import MANIFEST
from inkmill.sources.shared import file_system

LOG = "manifest-log"
CHANGE = T.StructType([T.StructField("op", T.StringType()), *MANIFEST.fields])
_NAME = re.compile(r"(base)-(\d+)|delta-(\d+)\.([a-z]+)\.(\d+)")


@dataclass
class State:
    """What a log's folder has: its bases, (number, name) of its deltas, the last batch of each writer."""

    bases: list[int] = field(default_factory=list)
    deltas: list[tuple[int, str]] = field(default_factory=list)
    last: dict[str, int] = field(default_factory=dict)

    @property
    def base(self) -> int:
        return max(self.bases, default=0)

    @property
    def newest(self) -> int:
        return max([self.base, *(n for n, _ in self.deltas)])


def state(spark: SparkSession, root: str) -> State:
    fs, where = file_system(spark, f"{root}/{LOG}")
    out = State()
    if fs.exists(where):
        for name in (x.getPath().getName() for x in fs.listStatus(where)):
            if m := _NAME.fullmatch(name):
                if m[1]:
                    out.bases.append(int(m[2]))
                else:
                    out.deltas.append((int(m[3]), name))
                    out.last[m[4]] = max(out.last.get(m[4], -1), int(m[5]))
    if out.base:
        for r in spark.read.schema("writer string, number long").json(f"{root}/{LOG}/base-{out.base}/writers").collect():
            out.last[r["writer"]] = max(out.last.get(r["writer"], -1), r["number"])
    return out


def _publish(spark: SparkSession, root: str, made: str, name: str) -> None:
    fs, old = file_system(spark, f"{root}/{LOG}/{made}")
    _, new = file_system(spark, f"{root}/{LOG}/{name}")
    if fs.exists(new) or not fs.rename(old, new):
        raise RuntimeError(f"{name} is there already: another process writes to this log")


def append(rows: DataFrame, root: str, writer: str, number: int | None = None) -> bool:
    """Commit changes (op, MANIFEST fields) as the writer's batch ``number``, or its next; False if it was committed before.

    A run that ends before the rename leaves the log as it was.
    """
    if not re.fullmatch("[a-z]+", writer):
        raise ValueError(f"a writer's name has small letters only: {writer}")
    spark = rows.sparkSession
    now = state(spark, root)
    number = now.last.get(writer, -1) + 1 if number is None else number
    if number <= now.last.get(writer, -1):
        return False
    made = f".{uuid.uuid4().hex}"
    rows.select(*CHANGE.fieldNames()).write.parquet(f"{root}/{LOG}/{made}")
    _publish(spark, root, made, f"delta-{now.newest + 1:012d}.{writer}.{number}")
    return True


def read(spark: SparkSession, root: str) -> DataFrame:
    """The manifest that the log has now; without a log, no rows."""
    now = state(spark, root)
    at = f"{root}/{LOG}"
    base = spark.read.schema(MANIFEST).parquet(f"{at}/base-{now.base}/records") if now.base else spark.createDataFrame([], MANIFEST)
    newer = sorted((n, name) for n, name in now.deltas if n > now.base)
    if not newer:
        return base
    deltas = None
    for n, name in newer:
        one = spark.read.schema(CHANGE).parquet(f"{at}/{name}").withColumn("batch", F.lit(n).cast("long"))
        deltas = one if deltas is None else deltas.unionByName(one)
    return changes.fold(base, deltas)


def compact(spark: SparkSession, root: str) -> int:
    """Write what the log has now as its next base; its number.

    Deltas and bases that the base before this one already covered go; those in between stay for readers that have begun.
    """
    now = state(spark, root)
    if not now.deltas or now.newest == now.base:
        return now.base
    made = f".{uuid.uuid4().hex}"
    read(spark, root).write.parquet(f"{root}/{LOG}/{made}/records")
    spark.createDataFrame(sorted(now.last.items()), "writer string, number long").coalesce(1).write.json(f"{root}/{LOG}/{made}/writers")
    _publish(spark, root, made, f"base-{now.newest}")
    fs, _ = file_system(spark, root)
    gone = [f"base-{n}" for n in now.bases if n < now.base] + [name for n, name in now.deltas if n <= now.base]
    for name in gone:
        fs.delete(file_system(spark, f"{root}/{LOG}/{name}")[1], True)
    return now.newest
