"""What to extract of a stream of found files, by a state for each path in place of the whole manifest for each batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from inkmill.functions import names
from inkmill.operators import incremental

DECISIONS = "rel string, size long, source_sha256 string, found_at timestamp, action string"
_STATE = "found_at timestamp, source_sha256 string, settled boolean"
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def known(manifest: DataFrame, archive_digests: DataFrame) -> DataFrame:
    """(rel, source_sha256, settled) of the records that have a path: what a stream starts from.

    A record is settled if a run would keep it while its source doesn't change.
    """
    rows = incremental.current(manifest.filter("rel is not null and rel <> ''")).join(incremental.shared_raws(manifest), "raw", "left").join(archive_digests, "raw", "left")
    done = incremental.settled(*(F.col(c) for c in ("quality", "raw", "raw_sha256", "archive_sha256", "archive_bytes")))
    moved = F.coalesce(F.col("raw") != "", F.lit(False)) & (F.col("n_raw").isNotNull() | (F.col("raw") != names.raw_path(F.col("rel"))))
    twin = F.coalesce(F.col("quality") == "skip_duplicate", F.lit(False))
    return rows.select("rel", "source_sha256", (done & ~moved & ~twin).alias("settled"))


class Decider(StatefulProcessor):
    """``extract`` for a path that is new, was not settled, or has another fingerprint than before; else ``keep``.

    What was found no later than what the state has is a repetition, or came late, and gets no row: something newer has been decided on.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        for sha, settled in zip(initialState["source_sha256"], initialState["settled"]):
            self.last.update((None, sha, bool(settled)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        found = pd.concat(list(rows)).sort_values("found_at", kind="stable")
        at, sha, settled = self.last.get() if self.last.exists() else (None, None, False)
        out = []
        for r in found.itertuples():
            if at is not None and r.found_at <= pd.Timestamp(at):
                continue
            now = r.source_sha256 if isinstance(r.source_sha256, str) else None
            keep = settled and now is not None and (sha is None or sha == "" or sha == now)
            out.append((key[0], None if pd.isna(r.size_) else int(r.size_), now, r.found_at, "keep" if keep else "extract"))
            at, sha, settled = r.found_at.to_pydatetime(), now, True
        if out:
            self.last.update((at, sha, settled))
            yield pd.DataFrame(out, columns=["rel", "size", "source_sha256", "found_at", "action"]).astype({"size": "Int64"})

    def close(self) -> None:
        pass


def decide(listings: DataFrame, start: DataFrame) -> DataFrame:
    """DECISIONS for a stream of listings (rel, size, source_sha256, found_at); ``start`` as of ``known``.

    The state of each path is kept by the state store, which a restart reads from the checkpoint; the manifest is read once, at the first start.
    A row's work is that of its path alone, whatever the size of the manifest.
    """
    spark = listings.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    rows = listings.select("rel", F.col("size").cast("long").alias("size_"), "source_sha256", "found_at")
    return rows.groupBy("rel").transformWithStateInPandas(Decider(), DECISIONS, "Append", "None", start.select("rel", "source_sha256", "settled").groupBy("rel"))
