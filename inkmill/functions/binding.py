"""Columns that are computed once, however often an expression has them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    A plain expression stands in the plan wherever it is used, so expressions of expressions grow
    exponentially, and within lambdas one would be computed for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
