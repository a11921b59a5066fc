"""Counters that come with the pass that does the work, not by another one over its rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation

from inkmill.sources.shared import cut


def counted(rows: DataFrame, name: str, counts: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``rows`` as a table in the shared folder, and one row with the aggregates ``counts`` of them.

    The aggregates are observed while the table is written, so the plan of ``rows`` is evaluated once.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    empty = rows.limit(0).agg(*(c.alias(n) for n, c in counts.items())).schema
    table = cut(rows.observe(seen, *(c.alias(n) for n, c in counts.items())), name)
    got = seen.get
    return table, rows.sparkSession.createDataFrame([tuple(got[n] for n in counts)], empty)
