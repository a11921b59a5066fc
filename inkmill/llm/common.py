"""Tables, joins and Arrow helpers of the subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.batches import bound_batches, release
from inkmill.sources.shared import cut, drop  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has in any case."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def col(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def named(columns: list[str], name: str) -> str:
    """The column that ``name`` means: Spark takes names without regard to case."""
    return name if name in columns else next(c for c in columns if c.lower() == name.lower())


def as_long(df: DataFrame, name: str) -> Column:
    """A column as a long; null for what is no number, whatever the column's type is."""
    kind = df.schema[named(df.columns, name)].dataType
    c = col(name)
    return (c if isinstance(kind, (T.NumericType, T.StringType)) else c.cast("string")).try_cast("long")


def distinct(docs: DataFrame, key: Column) -> bool:
    """Whether no two rows share a key, null taken as one."""
    return not docs.groupBy(key.alias("_key")).count().filter("count > 1").limit(1).count()


def numbered(docs: DataFrame, place: Column, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a long added, another for each row, in the order of the long ``place``; and that column's name.

    It is ``place`` itself where no two rows share one; else the rows are sorted into a table and numbered.
    """
    row = fresh(docs, "_row")
    keyed = docs.withColumn(row, place)
    if distinct(docs, place):
        return keyed, row
    at = fresh(keyed, "_at")
    ordered = keyed.withColumn(at, F.monotonically_increasing_id()).orderBy(row, at).drop(row, at)
    return cut(ordered.withColumn(row, F.monotonically_increasing_id()), name), row


#: A key with more than one in so many rows is hot; there are fewer hot keys than that.
HOT = 1024


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner equi-join to a table with one row for each key; ``count`` says how many of ``rows`` have it.

    A hot key's rows never meet in one task: keys of more than 1/HOT of the rows, fewer than HOT of them, are broadcast.
    Both sides are read twice where there are any, so they should be tables.
    """
    total, most = table.agg(F.sum(count), F.max(count)).first()
    if most is None or most <= total / HOT:
        return rows.join(table, keys)
    hot = table.filter(F.col(count) > total / HOT)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table.filter(F.col(count) <= total / HOT), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(others)


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text mod n; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are bounded."""
    bound_batches(df.sparkSession)
    return df


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType, rows: int = 1000) -> DataFrame:
    """``mapInArrow`` with ``fn`` over slices of at most ``rows`` rows of each batch; columns may have any names."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    plain = [f"c{i}" for i in range(len(schema.fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows))
                if out is not None and out.num_rows:
                    yield pa.RecordBatch.from_arrays(out.columns, names=plain)
        release()

    named = T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(plain, schema.fields, strict=True)])
    return small_batches(df).toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(run, named).toDF(*schema.names)


def with_field(schema: T.StructType, name: str, kind: str) -> T.StructType:
    """A copy of the schema with one more field."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(f"`{name}` {kind}").fields])


#: Hash slots of ``split``: what it broadcasts is at most so many longs, whatever the size of the keys.
SLOTS = 1 << 20


def split(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among ``keys`` (a single column), and rows whose key is not.

    A broadcast of the keys' hash slots, bounded by SLOTS, tells them apart before any shuffle, so
    that only the first need to be shuffled to meet their keys.
    """
    name = fresh(df, "_slot")
    slot = lambda c: F.pmod(F.xxhash64(c.cast(keys.schema[0].dataType)), F.lit(SLOTS))
    slots = F.broadcast(keys.select(slot(F.col(keys.columns[0])).alias(name)).distinct())
    slotted = df.withColumn(name, slot(key))
    return slotted.join(slots, name, "left_semi").drop(name), slotted.join(slots, name, "left_anti").drop(name)


def semi(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys``."""
    maybe, _ = split(df, key, keys)
    name = fresh(df, "_among")
    return maybe.join(keys.withColumnRenamed(keys.columns[0], name), key == F.col(name), "left_semi")


def anti(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys``, or null."""
    maybe, others = split(df, key, keys)
    name = fresh(df, "_among")
    return others.union(maybe.join(keys.withColumnRenamed(keys.columns[0], name), key == F.col(name), "left_anti"))
