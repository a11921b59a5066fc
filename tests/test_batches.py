import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkmill.functions import han, text
from inkmill.functions.batches import _BATCH, BATCH_BYTES
from inkmill.operators.grams import _block, _numbers, _varints
from inkmill.plans.queries import QUERIES
from tests.compare import SF


@pytest.mark.parametrize("column", [han.keywords, text.page_text, lambda c: text.chapter_texts(F.array(c))])
def test_batches_of_texts_are_bounded(spark, column):
    spark.conf.set(_BATCH, str(64 << 20))
    column(F.lit("a"))
    assert int(spark.conf.get(_BATCH).rstrip("b")) == BATCH_BYTES


@pytest.mark.parametrize("name", ["search_nothing", "search_notes", "front_matter", "han_keywords"])
def test_keywords_are_computed_once(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_postings_are_those_of_a_plain_count(block):
    rng = random.Random(5)
    texts = ["".join(rng.choice("aab方\U0001f600\n") for _ in range(rng.choice([0, 1, 2, 300]))) for _ in range(60)] + ["ab" + "c" * (1 << 22) + "ab", "", ""]
    paths = pa.array([f"p{i}" for i in range(21)])
    parts = [_block(paths, texts)] if block > 1 else [_block(paths.slice(i, 1), texts[3 * i : 3 * i + 3]) for i in range(21)]
    want = {}
    for u, t in enumerate(texts):
        for i in range(len(t) - 1):
            want.setdefault((t[i : i + 2], f"p{u // 3}", u % 3), []).append(i)
    got = {}
    for b in parts:
        for r in b.to_pylist() if b else []:
            assert (key := (r["pair"], r["path"], r["field"])) not in got
            got[key] = np.cumsum(_numbers(np.frombuffer(r["at"], np.uint8))[0]).tolist()
    assert got == want


def test_steps_of_any_size():
    n = np.array([0, 1, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, (1 << 28) - 1, 1 << 28, (1 << 31) - 1])
    data, size = _varints(n)
    back, end = _numbers(data)
    assert back.tolist() == n.tolist() and end.tolist() == np.cumsum(size).tolist()
