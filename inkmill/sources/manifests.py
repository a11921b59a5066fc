"""Manifests and libraries as files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.plans.schemas import MANIFEST
from inkmill.sources import contained
from inkmill.sources.shared import file_system


POINTER = "manifest.current"


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """An array of objects in one file; fields of MANIFEST, positions in the array's order.  Without the file, no rows."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return spark.createDataFrame([], MANIFEST)
    fields = [f for f in MANIFEST.fields if f.name != "manifest_pos"]
    element = "array<struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields) + ">>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", element).alias("r"))
    rows = whole.select(F.posexplode("r"))
    return rows.select(F.col("pos").cast("long").alias("manifest_pos"), "col.*").select(*(f.name for f in MANIFEST.fields))


def _current(spark: SparkSession, root: str) -> int:
    """Number of the committed version; 0 for none."""
    fs, where = file_system(spark, f"{root}/{POINTER}")
    return int(spark.read.text(str(where)).first()[0]) if fs.exists(where) else 0


def commit(manifest: DataFrame, root: str) -> int:
    """Write the manifest as the next version, one JSON object a line, then point to it; the version's number.

    Readers see the old version or the new one, never a part; a run that ends before the pointer is
    renamed leaves the old.  The version before stays, for readers that have begun; older ones go.
    """
    spark = manifest.sparkSession
    last = _current(spark, root)
    manifest.write.mode("overwrite").json(f"{root}/manifest-{last + 1}")
    fs, pointer = file_system(spark, f"{root}/{POINTER}")
    _, new = file_system(spark, f"{root}/{POINTER}.{last + 1}")
    out = fs.create(new, True)
    out.write(bytearray(str(last + 1).encode()))
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    modes = spark.sparkContext._gateway.new_array(options, 1)
    modes[0] = options.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri() if new.toUri().getScheme() else fs.getUri()).rename(new, pointer, modes)
    _, old = file_system(spark, f"{root}/manifest-{last - 1}")
    fs.delete(old, True)
    return last + 1


def load(spark: SparkSession, root: str) -> DataFrame:
    """The committed manifest; without one, no rows."""
    last = _current(spark, root)
    return spark.read.schema(MANIFEST).json(f"{root}/manifest-{last}") if last else spark.createDataFrame([], MANIFEST)


def write_markdown(documents: DataFrame, root: str, below: str = "") -> DataFrame:
    """(path, bytes, error) after writing each (path, markdown) to a shared folder, or to the folder ``below`` in it.

    A path that may leave it, or leads through a link, is an error and is not written; files are put in place by a rename.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, body in zip(frame["path"], frame["markdown"]):
                data = body.encode()
                try:
                    contained.parts(path)
                    contained.write(root, f"{below}/{path}" if below else path, data)
                    rows.append((path, len(data), None))
                except (contained.Unsafe, OSError) as e:
                    rows.append((path, 0, str(e) if isinstance(e, contained.Unsafe) else f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "bytes", "error"])

    return documents.select("path", "markdown").mapInPandas(run, "path string, bytes long, error string")


def unlike(documents: DataFrame, root: str, below: str = "") -> DataFrame:
    """(path, error) of the documents (path, markdown) whose file is not there or has other bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, wanted in zip(frame["path"], frame["wanted"]):
                try:
                    contained.parts(path)
                    if contained.digest(root, f"{below}/{path}" if below else path)[0] != wanted:
                        rows.append((path, "other bytes"))
                except (contained.Unsafe, OSError) as e:
                    rows.append((path, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "error"])

    return documents.select("path", F.sha2(F.encode("markdown", "UTF-8"), 256).alias("wanted")).mapInPandas(run, "path string, error string")


def parse_markdown(texts: DataFrame) -> DataFrame:
    """(path, fields, body) of (path, markdown): front matter as a map, quotes at the edges of values removed."""
    parts = F.split("markdown", "\n---", 3)
    front = F.substring(F.get(parts, F.lit(0)), 4, 1 << 30)
    lines = F.filter(F.split(front, "\n"), lambda x: F.contains(x, F.lit(":")))
    pair = lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.regexp_replace(F.trim(F.regexp_replace(x, r"\A[^:]*:", "")), r'\A"+|"+\z', "").alias("v"))
    whole = F.col("markdown").startswith("---") & (F.size(parts) > 1)
    body = F.concat(F.get(parts, F.lit(1)), F.coalesce(F.get(parts, F.lit(2)), F.lit("")))
    # The last of equal keys counts.
    rows = F.transform(lines, pair)
    last = F.filter(rows, lambda x, i: ~F.exists(F.slice(rows, i + 2, F.size(rows)), lambda y: y["k"] == x["k"]))
    none = F.create_map().cast("map<string,string>")
    return texts.select("path", F.when(whole, F.map_from_entries(last)).otherwise(none).alias("fields"), F.when(whole, body).otherwise(F.col("markdown")).alias("body"))
