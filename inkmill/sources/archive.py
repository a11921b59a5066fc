"""Archived texts as files, published before the manifest that names them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.functions import names
from inkmill.sources import contained, manifests
from inkmill.sources.shared import cut


def write(texts: DataFrame, root: str) -> DataFrame:
    """(raw, raw_sha256, bytes, error) after writing each (raw, text) below ``root``, a folder that the workers share.

    The fingerprint is that of the text, not of what is on disk later.  A path that may leave ``root``, or leads through a link, is an error.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for raw, body in zip(frame["raw"], frame["text"]):
                try:
                    data = (body or "").encode()
                    contained.write(root, raw or "", data)
                    rows.append((raw, hashlib.sha256(data).hexdigest(), len(data), None))
                except contained.Unsafe as e:
                    rows.append((raw, None, None, str(e)))
                except OSError as e:
                    rows.append((raw, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["raw", "raw_sha256", "bytes", "error"]).astype({"bytes": "Int64"})

    return texts.select("raw", "text").mapInPandas(run, "raw string, raw_sha256 string, bytes long, error string")


def read(manifest: DataFrame, root: str) -> DataFrame:
    """(raw, text, error) of the archived texts that records name and that are there; links are not followed.

    Bytes that are no UTF-8 are that row's error and have no text, so that nothing takes them for what was archived.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for raw in frame["raw"]:
                try:
                    rows.append((raw, contained.read(root, raw).decode("utf-8"), None))
                except (FileNotFoundError, contained.Unsafe):
                    continue
                except (OSError, UnicodeDecodeError) as e:
                    rows.append((raw, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["raw", "text", "error"])

    named = manifest.select("raw").filter(names.safe(F.col("raw"))).distinct()
    return named.mapInPandas(run, "raw string, text string, error string")


def publish(manifest: DataFrame, texts: DataFrame, root: str) -> DataFrame:
    """Write the texts, then commit the manifest; the texts that could not be written, with their errors.

    A record whose text was not written is committed without a fingerprint, so that nothing trusts its archive.  A
    run that ends in between leaves the old manifest, whose fingerprints then don't fit, which is found too.
    """
    done = cut(write(texts, root), "archived")
    failed = done.filter("error is not null").select("raw", F.lit(True).alias("_lost"))
    safe = manifest.join(failed, "raw", "left").withColumn("raw_sha256", F.when(F.col("_lost").isNull(), F.col("raw_sha256"))).select(*manifest.columns)
    manifests.commit(safe, root)
    return done.filter("error is not null").select("raw", "error")
