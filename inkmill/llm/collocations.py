"""Phrases whose words stand together more often than their parts would by chance, mined with suffix-sigma.

1. All words of a language are counted, then the pairs of frequent words, then the triples of frequent pairs.  A word has a hash of 64 bits that no
   other word of the table has (that is looked up; if two share one, all is hashed anew with another seed), and a run is the hashes of its words, so these counts
   are exact; runs are spelled once, from the table of words.  What occurs fewer than ``least`` times is in no phrase.  Frequent words and runs are
   known to the tasks by bitmaps of hash slots, whose size is fixed; slots that are shared let too much through, which the counts then take out.
2. Longer phrases are counted by suffixes: a word and up to MAX_WORDS - 1 words after it, within its piece and as far as its triples are frequent, if these are
   more than COUNTED words.  Equal suffixes of a task are one row with a count, as far as it holds them.  Rows are shuffled by language and first word.
   Words with more than 1/HOT of all words are salted by their second word, such pairs by the suffix.
3. A partition sorts its suffixes in descending order and keeps one stack of open prefixes.  A prefix is closed when a suffix comes
   that doesn't begin with it; then its count is known, and added to that of the prefix before.  Counts that salting has split are added up after.
4. Candidates are joined to the counts of their parts at each cut, and to the phrases that contain them.

Texts are handled as UTF-8 bytes: all separators are ASCII, and bytes are in the order that phrases are ranked by.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkmill.llm import common
from inkmill.llm.wordhash import mix, span_hashes

MAX_WORDS = 5
LEAST = 100
TOP = 2000
#: A candidate goes if a longer one has so many hundredths of its count.
SHARE = 100
UNKNOWN = "und"
#: Words of the longest runs that are counted by the hashes of their words; longer ones are counted by suffixes.
COUNTED = 3
#: Bits of a bitmap of frequent runs, and of a part of it.
SLOTS = 1 << 26
_CHUNK = 1 << 18
#: Words and pairs with more than one in so many of all words are hot; there are fewer of each than that.
HOT = 1024
#: Bytes of texts that are hashed at once; a longer text is a block by itself.
BLOCK = 2_000_000
#: Distinct words or runs that a task holds before it returns their counts.
HELD = 1 << 20
#: Bytes of distinct words or suffixes that a task holds, at most HELD of them, before it returns their counts.
HELD_BYTES = 96_000_000
#: Bytes of a word that are hashed as a polynomial; of long words, those of two letters can be made to agree for every base.
LONG = 64
#: Columns of the hashes of a run's words; null beyond its last.
KEYS = [f"h{i}" for i in range(1, COUNTED + 1)]
_NEXT = np.uint64(0x9E3779B185EBCA87)
_CLASS = np.zeros(256, np.uint8)
_CLASS[32] = 1
_CLASS[[46, 44, 59, 58, 33, 63, 10, 11, 12, 13]] = 2  # . , ; : ! ? and line ends


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """What stands ``by`` places later; 0 beyond the end."""
    return np.append(x[by:], np.zeros(min(by, len(x)), x.dtype))


class Words:
    """The words of a block of texts of one language, in order; another ``seed`` gives other hashes."""

    def __init__(self, lang: bytes, texts: list[bytes], seed: int = 0) -> None:
        self.data = re.sub(rb"[ \t]+", b" ", b"\n".join(texts).lower()) + b"\n"
        codes = np.frombuffer(self.data, np.uint8)
        kind = _CLASS[codes]
        inside = np.zeros(len(codes) + 1, np.int8)
        inside[1:] = kind == 0
        step = np.diff(inside, append=0)
        self.starts, self.ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        ends_piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        digest = lambda x: np.uint64(int.from_bytes(hashlib.blake2b(x, digest_size=8, key=seed.to_bytes(8)).digest()))
        hashes = span_hashes(codes + np.uint64(seed << 8) if seed else codes, self.starts, self.ends)
        for i in np.flatnonzero(self.ends - self.starts > LONG).tolist():
            hashes[i] = digest(self.data[self.starts[i] : self.ends[i]])
        self.hashes = mix(hashes + digest(lang))
        self.goes_on = np.append(ends_piece[1:] == ends_piece[:-1], False)[: len(self.starts)]  # the next word is in the same piece

    def texts(self) -> pa.Array:
        codes = np.frombuffer(self.data, np.uint8)
        offsets = np.append(0, np.cumsum(self.ends - self.starts)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(codes[_CLASS[codes] == 0])])

    def runs(self, k: int) -> np.ndarray:
        """Hash of each word and the k-1 after it; of use where they are in one piece."""
        out = self.hashes
        for i in range(1, k):
            out = mix(out * _NEXT + _shifted(self.hashes, i))
        return out

    def open_runs(self, frequent: list[Frequent]) -> list[np.ndarray]:
        """For k = 1 and up: where a run of k words in one piece is, all of whose shorter runs, those ``frequent`` tells of, are frequent, and itself if it does."""
        out = []
        for k in range(1, len(frequent) + 2):
            at = out[-1] & _shifted(out[-1], 1) if k > 1 else np.ones(len(self.hashes), bool)
            at = at & self.goes_on if k == 2 else at
            out.append(at & frequent[k - 1].among(self.runs(k)) if k <= len(frequent) else at)
        return out


def _blocks(langs: list[str], texts: list[bytes | None], block: int = BLOCK) -> Iterator[tuple[bytes, list[bytes]]]:
    by_lang: dict[str, list[bytes]] = {}
    for lang, text in zip(langs, texts):
        by_lang.setdefault(lang, []).append(text or b"")
    for lang, own in by_lang.items():
        held: list[bytes] = []
        size = 0
        for text in own:
            if size and size + len(text) > block:
                yield lang.encode(), held
                held, size = [], 0
            held.append(text)
            size += len(text) + 1
        yield lang.encode(), held


def _batches(batches: Iterator[pa.RecordBatch], block: int = BLOCK) -> Iterator[tuple[bytes, list[bytes]]]:
    """Blocks of texts of one language, of rows (lang, text) of several Arrow batches."""
    langs: list[str] = []
    texts: list[bytes | None] = []
    size = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            langs.append(lang)
            texts.append(text)
            size += len(text or b"")
            if size >= block:
                yield from _blocks(langs, texts, block)
                langs, texts, size = [], [], 0
    yield from _blocks(langs, texts, block)


class Frequent:
    """Hash slots of frequent words, by parts of a bitmap."""

    def __init__(self, chunks: dict[int, bytes]) -> None:
        self.chunks = chunks
        self.bits = np.zeros(SLOTS // 8, np.uint8)
        for c, blob in chunks.items():
            self.bits[c * _CHUNK // 8 : (c + 1) * _CHUNK // 8] = np.frombuffer(blob, np.uint8)

    def __reduce__(self):
        return Frequent, (self.chunks,)

    def among(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & np.uint64(SLOTS - 1)
        return self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 > 0


#: Hashes of hot words or pairs, and into how many parts the rows of each are dealt.
Hot = dict[int, int]


def parts_of(hashes: np.ndarray, hot: Hot) -> np.ndarray:
    out = np.ones(len(hashes), np.uint64)
    known = np.array([*hot], np.uint64)
    for h in known[np.isin(known, hashes)].tolist():
        out[hashes == np.uint64(h)] = hot[h]
    return out


def chained(runs: np.ndarray) -> np.ndarray:
    """What ``Words.runs`` has for these runs, rows of the hashes of their words."""
    out = runs[:, 0]
    for i in range(1, runs.shape[1]):
        out = mix(out * _NEXT + runs[:, i])
    return out


def distinct(runs: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct rows, and the sums of their ``c``; rows that only their chained hash takes for equal stay apart, and may then be several places."""
    order = np.argsort(chained(runs))
    new = np.zeros(len(runs), bool)
    new[:1] = True
    for i in range(runs.shape[1]):
        own = runs[:, i][order]
        new[1:] |= own[1:] != own[:-1]
    at = np.flatnonzero(new)
    return order[at], np.add.reduceat(c[order], at) if len(at) else c


def _words(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(h, lang, word, c): hashes and counts of words; also, with a null h and word, the number of each language's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def block(lang: bytes, texts: list[bytes]) -> pa.Table:
            w = Words(lang, texts, seed)
            total[lang.decode()] = total.get(lang.decode(), 0) + len(w.hashes)
            found = w.texts().dictionary_encode()
            at = found.indices.to_numpy()
            h = np.zeros(len(found.dictionary), np.uint64)
            h[at] = w.hashes
            c = np.bincount(at, minlength=len(h)).astype(np.int64)
            return pa.table({"h": pa.array(h.view(np.int64)), "lang": pa.repeat(lang.decode(), len(h)), "word": found.dictionary, "c": pa.array(c)})

        for found in combined(block(*b) for b in _batches(batches)):
            yield from found.to_batches(max_chunksize=100_000)
        if total:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(total), pa.int64()), pa.array(list(total)), pa.nulls(len(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["h", "lang", "word", "c"])
        common.release()

    return common.small_batches(docs).mapInArrow(run, "h long, lang string, word binary, c long")


def _runs(docs: DataFrame, frequent: list[Frequent], seed: int = 0) -> DataFrame:
    """(h1, h2, ..., c): counts of the runs of one word more than ``frequent`` tells of, as the hashes of their words."""
    k = len(frequent) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def add(runs: np.ndarray, c: np.ndarray) -> None:
            at, c = distinct(runs, c)
            held.append((runs[at], c))

        def together() -> None:
            runs, c = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            add(runs, c)

        def rows() -> Iterator[pa.RecordBatch]:
            runs, c = held.pop()
            for lo in range(0, len(c), 100_000):
                part = runs[lo : lo + 100_000].view(np.int64)
                own = [pa.array(part[:, i].copy()) if i < k else pa.nulls(len(part), pa.int64()) for i in range(COUNTED)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(c[lo : lo + 100_000])], names=[*KEYS, "c"])

        for lang, texts in _batches(batches):
            w = Words(lang, texts, seed)
            at = np.flatnonzero(w.open_runs(frequent)[-1])
            add(np.stack([w.hashes[at + i] for i in range(k)], axis=1), np.ones(len(at), np.int64))
            if sum(len(c) for _, c in held) > 2 * HELD:
                together()
                if len(held[0][1]) > HELD:
                    yield from rows()
        if held:
            together()
            yield from rows()
        common.release()

    return common.small_batches(docs).mapInArrow(run, ", ".join(f"{x} long" for x in [*KEYS, "c"]))


def _chained(counts: DataFrame, k: int) -> DataFrame:
    """Rows of ``_runs`` of ``k`` words with the run's hash ``h`` beside those of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = chained(np.stack([b.column(i).to_numpy().view(np.uint64) for i in range(k)], axis=1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h.view(np.int64))], names=[*KEYS, "c", "h"])

    return common.small_batches(counts.select(*KEYS, "c")).mapInArrow(run, ", ".join(f"{x} long" for x in [*KEYS, "c", "h"]))


def _hot(counts: DataFrame, words: int) -> Hot:
    """What has more than 1/HOT of ``words``, of rows (h, c): fewer than HOT."""
    hot = counts.filter(F.col("c") * HOT > words).select("h", F.expr(f"c * {HOT} div {max(1, words)} + 1").alias("n")).collect()
    return {r["h"] % (1 << 64): r["n"] for r in hot}


def _frequent(counts: DataFrame, words: int) -> tuple[Frequent, Hot]:
    """Bitmap of the hashes of a table (h, c, ...), and those that are hot among ``words`` words.  What comes to the driver is the bitmap and fewer than HOT hashes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, np.zeros(_CHUNK, bool)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["chunk", "bits"])

        for b in batches:
            chunk, slot = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for lo, hi in zip(edges := [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist()], [*edges[1:], len(chunk)]):
                if hi > lo:
                    if now is not None and chunk[lo] != now:
                        yield row()
                        bits[:] = False
                    now = int(chunk[lo])
                    bits[slot[lo:hi]] = True
        if now is not None:
            yield row()

    slot = F.col("h").bitwiseAND(F.lit(SLOTS - 1))
    dealt = counts.select(F.floor(slot / _CHUNK).cast("int").alias("chunk"), (slot % _CHUNK).cast("int").alias("slot"))
    bits = common.small_batches(dealt.repartition("chunk").sortWithinPartitions("chunk")).mapInArrow(pack, "chunk int, bits binary")
    chunks = {r["chunk"]: bytes(r["bits"]) for r in bits.toLocalIterator()}
    return Frequent(chunks), _hot(counts, words)


def suffixes(w: Words, lang: bytes, frequent: list[Frequent], hot: list[Hot], words: int = MAX_WORDS, above: int = 0) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct suffixes of a block that have more than ``above`` words, each followed by a blank; the part that each goes to; of how many words, at most, its prefixes are split over parts; and counts."""
    n = len(w.hashes)
    runs = w.open_runs(frequent)[: len(frequent)]
    longest = len(runs)
    last, alive = np.arange(n), runs[0].copy()
    for k in range(1, words):
        # the suffix goes on if its last words, as many as were counted, are a frequent run
        alive = alive & (runs[k] if k < longest else _shifted(runs[-1], k - longest + 1))
        last[alive] += 1
    index = np.flatnonzero(runs[0] & (last - np.arange(n) >= above))
    size = last[index] - index + 1
    own = np.stack([np.where(size > k, w.hashes[np.minimum(index + k, n - 1)], np.uint64(0)) for k in range(words)] + [size.astype(np.uint64)], axis=1)
    first, counts = distinct(own, np.ones(len(index), np.int64))
    index, size, own = index[first], size[first], own[first]
    second = own[:, 1] if words > 1 else np.zeros(len(index), np.uint64)
    by_word = parts_of(w.hashes[index], hot[0])
    # a hot pair's first word is hot too, so all rows of that word say that its count is split
    by_pair = np.where((by_word > 1) & (size > 1), parts_of(w.runs(2)[index], hot[1]), np.uint64(1))
    salt = mix(second + np.uint64(1)) % by_word + mix(chained(own) + np.uint64(1)) % by_pair
    split = np.where(by_pair > 1, words, np.where(by_word > 1, 1, 0)).astype(np.int32)
    keys = [lang + b"\n" + w.data[a:b] + b" " for a, b in zip(w.starts[index].tolist(), w.ends[last[index]].tolist())]
    return keys, mix(w.hashes[index] + salt).view(np.int64), split, counts


def _together(held: list[pa.Table]) -> pa.Table:
    names = held[0].column_names
    found = pa.concat_tables(held).group_by([x for x in names if x != "c"], use_threads=False).aggregate([("c", "sum")])
    return found.rename_columns([x.removesuffix("_sum") for x in found.column_names]).select(names)


def combined(blocks: Iterator[pa.Table], rows: int = HELD, size: int = HELD_BYTES) -> Iterator[pa.Table]:
    """Rows (..., c) of several blocks, equal ones as one row with the sum of ``c``, as many as a task holds."""
    held: list[pa.Table] = []
    for block in blocks:
        held.append(block)
        if sum(t.num_rows for t in held) > rows or sum(t.nbytes for t in held) > size:
            held = [_together(held)]
            if 2 * held[0].num_rows > rows or 2 * held[0].nbytes > size:
                yield held.pop()
    if held:
        yield _together(held)


def _suffixes(docs: DataFrame, frequent: list[Frequent], hot: list[Hot], words: int, above: int = 0, seed: int = 0) -> DataFrame:
    def block(lang: bytes, texts: list[bytes]) -> pa.Table:
        keys, part, split, counts = suffixes(Words(lang, texts, seed), lang, frequent, hot, words, above)
        return pa.table({"part": pa.array(part), "suffix": pa.array(keys, pa.binary()), "split": pa.array(split), "c": pa.array(counts.astype(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in combined(block(*b) for b in _batches(batches)):
            yield from found.to_batches(max_chunksize=100_000)
        common.release()

    return common.small_batches(docs).mapInArrow(run, "part long, suffix binary, split int, c long")


def count_prefixes(rows: Iterator[tuple[bytes, int, int]], least: int) -> Iterator[tuple[bytes, int]]:
    """(prefix, count) of all prefixes of suffixes (suffix, split, count) in descending order, by one stack.

    Prefixes of up to ``split`` words have a part of their count here; of others, those that reach ``least`` are returned.
    A suffix is language, line feed, and words with a blank after each; prefixes are without the last blank.
    """
    stack: list[list] = []  # open prefixes, each with its count so far

    def close() -> Iterator[tuple[bytes, int]]:
        prefix, count, partial = stack.pop()
        if stack:
            stack[-1][1] += count
        if partial or count >= least:
            yield prefix[:-1], count

    for suffix, split, c in rows:
        while stack and not suffix.startswith(stack[-1][0]):
            yield from close()
        at = len(stack[-1][0]) if stack else suffix.rindex(b"\n") + 1
        while at < len(suffix):
            at = suffix.index(b" ", at) + 1
            stack.append([suffix[:at], 0, len(stack) < split])
        stack[-1][1] += c
    while stack:
        yield from close()


def _stacked(suffix_rows: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held: list[tuple[bytes, bytes, int]] = []

        def batch() -> pa.RecordBatch:
            langs, phrases, counts = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.binary()), pa.array(phrases, pa.binary()), pa.array(counts, pa.int64())], names=["lang", "phrase", "f"])

        for prefix, count in count_prefixes(rows, least):
            lang, _, phrase = prefix.rpartition(b"\n")
            held.append((lang, phrase, count))
            if len(held) >= 50_000:
                yield batch()
                held.clear()
        if held:
            yield batch()
        common.release()

    return common.small_batches(suffix_rows).mapInArrow(run, "lang binary, phrase binary, f long")


def _spelled(runs: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of the runs (h1, h2, ..., c), from the table ``known`` of words (h, lang, word); and a table that this reads."""
    each = runs.select(*KEYS, "c", F.posexplode(F.array_compact(F.array(*KEYS))).alias("at", "h"))
    uses = each.groupBy("h").agg(F.count("*").alias("uses"))
    spelling = common.cut(uses.join(known.select("h", "lang", "word"), "h"), "spelling")
    own = F.sort_array(F.collect_list(F.struct("at", "lang", F.col("word").cast("string").alias("word"))))
    met = common.join_counted(each, spelling, ["h"], "uses").groupBy(*KEYS, "c").agg(own.alias("own"))
    return met.select(F.col("own")[0]["lang"].alias("lang"), F.array_join(F.col("own.word"), " ").alias("phrase"), F.size("own").alias("size"), F.col("c").alias("f")), spelling


def _counted(docs: DataFrame) -> tuple[DataFrame, int]:
    """A table of the rows of ``_words`` added up, and a seed with which no two words of it have one hash."""
    for seed in itertools.count():
        counted = common.cut(_words(docs, seed).groupBy("h", "lang", "word").agg(F.sum("c").alias("c")), "word-counts")
        if not counted.filter("h is not null").groupBy("h").count().filter("count > 1").limit(1).count():
            return counted, seed
        common.drop(counted)


def phrase_counts(docs: DataFrame, least: int = LEAST, words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of each language, and (lang, phrase, size, f) of all phrases of 1 to ``words`` words that occur ``least`` times, as tables."""
    held = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text"))
    counted, seed = _counted(held)
    totals = common.cut(counted.filter("h is null").select("lang", F.col("c").alias("n")), "totals")
    known = common.cut(counted.filter("h is not null").filter(F.col("c") >= least), "words")
    common.drop(counted)
    n = totals.agg(F.sum("n")).first()[0] or 0
    frequent, hot = (list(x) for x in zip(_frequent(known, n)))
    phrases = known.select("lang", F.col("word").cast("string").alias("phrase"), F.lit(1).alias("size"), F.col("c").alias("f"))
    used = [known]
    for k in range(2, min(COUNTED, words) + 1):
        counts = _runs(held, frequent, seed).groupBy(*KEYS).agg(F.sum("c").alias("c")).filter(F.col("c") >= least)
        runs = common.cut(_chained(counts, k), "frequent")
        more, hotter = _frequent(runs, n)
        frequent.append(more)
        hot.append(hotter)
        spelled, spelling = _spelled(runs, known)
        phrases = phrases.union(spelled)
        used += [runs, spelling]
    if words > COUNTED:
        rows = _suffixes(held, frequent, hot, words, COUNTED, seed).repartition("part").select("suffix", "split", "c").sortWithinPartitions(F.desc("suffix"))
        found = _stacked(rows, least).select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), F.size(F.split(F.col("phrase").cast("string"), " ")).alias("size"), "f")
        # shorter prefixes have been counted above, from all words and not from these suffixes
        longer = found.filter(F.col("size") > COUNTED).groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
        phrases = phrases.union(longer)
    out = common.cut(phrases, "phrases")
    for table in used:
        common.drop(table)
    return totals, out


def _exact(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = LEAST, words: int = MAX_WORDS, share: int = SHARE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language of ``docs`` (text, lang, ...).

    A-Z are lowered; texts are split into pieces at .,;:!? and line ends, and those into words at blanks and tabs.  A null text is empty,
    a null language is ``und``.  a, l and r count a phrase and its two parts at its weakest cut, n all words of the language; the score is floor(1000*a*n/(l*r)),
    by score, then a, both descending, then by the phrase's bytes.  A phrase goes if a longer one that contains it has ``share`` hundredths of its count.
    Long texts are read whole; repeated rows count as often as they stand there; other columns are not read.  An empty table gives an empty table.
    """
    totals, phrases = phrase_counts(docs, least, words)
    own = F.split("phrase", " ")
    several = phrases.filter("size > 1").withColumnRenamed("f", "a")
    span = lambda start, n: F.array_join(F.slice("own", start, n), " ")
    cuts = several.withColumn("own", own).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    both = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), p.alias("part")) for s, p in ((0, span(F.lit(1), F.col("k"))), (1, span(F.col("k") + 1, F.col("size")))))))
    parts = common.cut(cuts.select("lang", "phrase", "a", "k", both.alias("p")).select("lang", "phrase", "a", "k", "p.side", "p.part"), "parts")
    uses = parts.groupBy("lang", "part").agg(F.count("*").alias("uses"))
    known = common.cut(uses.join(phrases.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"]), "known")
    met = common.join_counted(parts, known, ["lang", "part"], "uses")
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("f")))
    cut = met.groupBy("lang", "phrase", "a", "k").agg(side(0).alias("l"), side(1).alias("r")).join(F.broadcast(totals) if totals.count() < HOT else totals, "lang")
    # decimals of 38 digits hold all products up to 1e38; div is exact and floors
    score = F.call_function("div", F.lit(1000).cast("decimal(38,0)") * _exact("a") * _exact("n"), _exact(_exact("l") * _exact("r")))
    scored = cut.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))

    inner = phrases.filter("size > 2").withColumn("own", own)
    inner = inner.withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    longer = inner.groupBy("lang", span(F.col("at"), F.col("m")).alias("phrase")).agg(F.max("f").alias("longer"))
    covered = longer.join(several.select("lang", "phrase", "a"), ["lang", "phrase"]).filter(100 * F.col("longer") >= share * F.col("a")).select("lang", "phrase")
    left = scored.join(covered, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "n", "s.score", "s.l", "s.r")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return left.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY 1),
f AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words), (SELECT unnest(range(1, 6)) AS m)
  WHERE i + m - 1 <= len(w) GROUP BY 1, 2, 3 HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, f AS a, m, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.m, c.k, x.f AS l, y.f AS r, t.n,
    CAST(1000 AS HUGEINT) * c.a * CAST(t.n AS HUGEINT) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, f, m, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS i FROM f WHERE m > 2), (SELECT unnest(range(2, 5)) AS k)
  WHERE k < m AND i + k - 1 <= m GROUP BY 1, 2
), kept AS (
  SELECT * FROM weakest WHERE NOT EXISTS (SELECT 1 FROM inner_phrases p WHERE p.lang = weakest.lang AND p.phrase = weakest.phrase AND 100 * p.longer >= 100 * weakest.a)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
