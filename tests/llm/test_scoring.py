"""What language-model scoring shuffles, and how it is packed."""

import numpy as np
import pytest

from inkmill.llm import scoring
from tests.compare import SF


def shuffled(spark, run):
    """Bytes of shuffles that ``run`` writes."""
    context = spark.sparkContext._jsc.sc()

    def now():
        context.listenerBus().waitUntilEmpty()
        executors = context.statusStore().executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    before = now()
    run()
    return now() - before


def test_shuffles_are_bounded_by_the_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chars = docs.selectExpr("sum(length(text))").first()[0]
    assert shuffled(spark, lambda: scoring.score(docs, block_chars=chars // 8).collect()) < 4 * chars


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_parts_of_a_relation(parts):
    rng = np.random.default_rng(parts)
    grams = np.unique(np.append(rng.integers(0, 1 << 64, 500, np.uint64, endpoint=False), np.array([0, 1, (1 << 64) - 1], np.uint64)))
    at = scoring.cuts(grams, parts)
    assert at[0] == 0 and at[-1] == len(grams) and len(at) == parts + 1
    for p in range(parts):
        own = grams[at[p] : at[p + 1]]
        assert all(int(g) * parts >> 64 == p for g in own)
        got = scoring.unpacked(scoring.packed(np.diff(own, prepend=np.uint64(0))), len(own), np.uint64)
        assert np.array_equal(np.cumsum(got, dtype=np.uint64), own)


def test_counts_of_other_relations():
    grams = np.array([5, 9, (1 << 64) - 1, 5, 9, 7], np.uint64)
    assert scoring.beyond(grams, np.array([2, 1, 4, 3, 1, 6])).tolist() == [3, 1, 0, 2, 1, 0]
