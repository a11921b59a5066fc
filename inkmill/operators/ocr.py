"""Scanned books: sampling of pages, the decision, recognition by a given function."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions import text
from inkmill.sources.shared import cut

BOOK_CHARS, DPI = 150, 150


def sample_pages(n: Column) -> Column:
    """Sorted distinct page numbers to look at in a document of ``n`` pages; none for no pages."""
    part = lambda k: F.floor(n * k / 5).cast("int")
    pages = F.array(F.least(F.lit(2), n - 1).cast("int"), part(1), F.floor(n / 2).cast("int"), part(4))
    return F.when(n > 0, F.array_sort(F.array_distinct(pages))).otherwise(F.array().cast("array<int>"))


def candidates(manifest: DataFrame) -> DataFrame:
    """Image PDFs that were not recognised yet."""
    return manifest.filter((F.col("quality") == "image") & (F.col("ext") == ".pdf") & ~F.coalesce("ocr", F.lit(False)))


def books(sampled: DataFrame, key: str, threshold: int = BOOK_CHARS) -> DataFrame:
    """(key, mean, is_book) from the recognised text of sampled pages."""
    length = F.length(text.strip(F.coalesce("text", F.lit(""))))
    out = sampled.groupBy(key).agg(F.avg(length).alias("mean"))
    return out.withColumn("is_book", F.col("mean") >= threshold)


def recognise(files: DataFrame, read: Callable[[str], bytes], pages_of: Callable[[bytes], int], read_page: Callable[[bytes, int], str], threshold: int = BOOK_CHARS) -> DataFrame:
    """(rel, text, chars, count, error, source_sha256) of the sources (rel) whose sampled pages make a book.

    ``read`` gives a source's bytes, ``pages_of`` counts pages, ``read_page`` recognises one; all run in the workers, so they bring
    their own tools.  Sampling comes first: other sources are never read in full.  A failure is that row's
    error, and so is a source that changes while it is read.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for rel in frame["rel"]:
                try:
                    rows.append((rel, pages_of(read(rel)), None))
                except Exception as e:  # one broken file is one failed row
                    rows.append((rel, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["rel", "n", "error"]).astype({"n": "Int64"})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for rel, n, picked in zip(frame["rel"], frame["n"], frame["picked"]):
                try:
                    content = read(rel)
                    digest = hashlib.sha256(content).hexdigest()
                    if sum(len(read_page(content, i).strip()) for i in picked) < threshold * len(picked):
                        continue
                    whole = "\n\n".join(read_page(content, i) for i in range(n))
                    if hashlib.sha256(read(rel)).hexdigest() != digest:
                        raise OSError("the source changed while it was read")
                    rows.append((rel, whole, n, None, digest))
                except Exception as e:  # one broken file is one failed row
                    rows.append((rel, None, None, f"{type(e).__name__}: {e}", None))
            yield pd.DataFrame(rows, columns=["rel", "text", "count", "error", "source_sha256"]).astype({"count": "Int64"})

    counted = cut(files.select("rel").mapInPandas(count, "rel string, n long, error string"), "pages")
    sampled = counted.filter("n > 0").select("rel", "n", sample_pages(F.col("n")).alias("picked"))
    done = sampled.mapInPandas(run, "rel string, text string, count long, error string, source_sha256 string")
    none = F.lit(None).cast("string")
    done = done.union(counted.filter("error is not null").select("rel", none, F.lit(None).cast("long"), "error", none))
    whole = F.when(F.col("error").isNull(), text.clean(F.col("text")))
    return done.select("rel", whole.alias("text"), text.ocr_chars(whole).alias("chars"), F.col("count").cast("int").alias("count"), "error", "source_sha256")
