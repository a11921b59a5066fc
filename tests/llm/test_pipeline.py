"""The whole pipeline against a plain version of its stages."""

import random

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from inkmill.llm import quality
from tests.llm.test_brute_force import changed, groups, jaccard_links, plain_lines, prose
from tests.llm.test_decontamination import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(4)
    good = lambda s: "\n".join(" ".join(rng.choice("the old sailors watch silver moon above quiet hills while foxes jump over seven lazy dogs".split()) + (f" n{s}x{rng.randint(0, 999)}" if rng.random() < 0.4 else "") for _ in range(12)).capitalize() + "." for _ in range(8))
    texts = [good(s) if s % 4 else " ".join(rng.choice(["###", "$$$", "%%", "BUY", "!!!", f"{s}"]) for _ in range(80)) for s in range(120)]
    items = [(i, prose(900 + i, n)) for i, n in enumerate((8, 20, 60))]
    shared = "\n".join(good("shared").split("\n")[:4])
    for i in (5, 9, 13, 17):
        texts[i] = texts[i] + "\n" + shared
    texts[21], texts[22] = texts[25], changed(texts[25], 0.02, 1)
    texts[30] += "\n" + items[1][1]
    texts[31] += "\n" + items[2][1] + " " + items[0][1]
    texts += ["", None]
    return list(enumerate(texts)), items


def test_run_against_plain_stages(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], COLUMNS)
    labels = spark.createDataFrame([(i, int(bool(i % 4)), 0) for i in range(0, 120, 1)], "doc_id long, quality int, toxic int")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    model = quality.train(docs, labels)
    scores = model.score(*quality.features([t for _, t in rows], [None if t is None else len(t) for _, t in rows]))
    left = [r for r, s in zip(rows, scores) if s >= quality.THRESHOLD]
    assert 70 <= len(left) < len(rows)
    left = [(i, t) for (i, _), t in zip(left, plain_lines(left))]
    roots = groups(len(left), jaccard_links([t for _, t in left]))
    once = [r for k, r in enumerate(left) if roots[k] == k]
    assert len(once) < len(left)
    clean = [r for r in once if not brute([r], items)]
    assert len(clean) < len(once)

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in clean}
    got, sequences = {}, {}
    for r in pieces:
        got.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.doc_tokens == want[r.doc_id]
    assert {i: sum(n for _, n in p) for i, p in got.items()} == want
    for parts in [*got.values(), *sequences.values()]:
        parts.sort()
        assert [s for s, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
    assert all(sum(n for _, n in p) <= 4096 for p in sequences.values())


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect() == []
