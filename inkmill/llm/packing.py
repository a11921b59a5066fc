"""Packing of token sequences into windows by Karmarkar-Karp differencing.

Each Spark partition packs its own documents in a stream.  A document that is
longer than a window gives whole windows; what is left of it, or a shorter
document, is a piece.  Once a group has pieces for about ``group`` windows,
multiway differencing merges partial partitions with opposing imbalances into near-equal
windows.  Where one exceeds the capacity the window count rises and
differencing starts anew, so no piece of a group is ever cut.  The small, near-equal gaps that
are left are filled with the documents that come next, cut to size.  No state passes
between partitions, so a lost task is simply run again.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common
from inkmill.llm.wordhash import blocks

CAPACITY = 4096
#: Windows that the pieces of a group are worth.
GROUP = 32
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Words of a generation; a worker keeps two.
CACHE_WORDS = 200_000

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: What the vocabulary's tokens at the end of a word end with.
END_OF_WORD = "</w>"

#: Texts outside of printable Latin-1, or with a special token, are encoded whole.
_OTHER = re.compile("[^\t\n\r -~\xa0-\xff]")
_SPECIAL = "<|"
#: The words of the tokenizer's own pattern, for lower-case Latin-1.
_WORD = re.compile("[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|'(?:[stmd]|re|ve|ll)|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\\sa-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")


class CachedTokenizer:
    """Ids of whole texts as little-endian bytes, by a cache of words.

    The tokenizer composes, lower-cases and splits a text into words, and merges
    within a word only.  In Latin-1 the first is void and the others are Python's
    ``lower`` and one pattern, so a text's ids are its words' ids in order (tested
    against whole texts).  Any other text is encoded by the tokenizer as it is.
    """

    def __init__(self, path: str | None = None, most: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Whether a token ends a word.
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(END_OF_WORD)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):  # a vocabulary that does not mark ends of words
                e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
                ends = np.searchsorted(np.array(e.word_ids), np.arange(1, len(part) + 1))
            raw, at_bytes = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.known.update(zip(part, [raw[i:j] for i, j in zip(at_bytes, at_bytes[1:])], strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        words = [None if _SPECIAL in t or _OTHER.search(t) else _WORD.findall(t.lower()) for t in texts]
        if len(self.known) > self.most:
            self.older, self.known = self.known, {}
        missing = set(chain.from_iterable(w for w in words if w)).difference(self.known)
        again = missing & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        self._learn(sorted(missing - again))
        get = self.known.__getitem__
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if w is None else b"".join(map(get, w)) for t, w in zip(texts, words, strict=True)]


@cache
def tokenizer_of(path: str | None) -> CachedTokenizer:
    """One for all tasks of a worker, so that words are learned once."""
    return CachedTokenizer(path)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Multiway Karmarkar-Karp: item numbers of k subsets with near-equal sums.

    A partial partition is the (sum, items) pairs of its subsets in falling order; of k, empty ones are left out.  The two with
    the largest spread are merged, the largest sums of one with the smallest of
    the other, until one is left.  Items are a tree of pairs until the end.
    """
    heap = [(-s if k > 1 else 0, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        # Of k places those without items are left out; a's i-th meets b's (k - 1 - i)-th.
        met = k - len(b)
        merged = a[:met] + b[: k - len(a)] + [(x + y, (p, q)) for (x, p), (y, q) in zip(a[met:], reversed(b[max(0, k - len(a)) :]))]
        merged.sort(key=lambda e: -e[0])
        heapq.heapreplace(heap, ((merged[-1][0] if len(merged) == k else 0) - merged[0][0], n, merged))
        n += 1
    out: list[list[int]] = []
    for _, tree in heap[0][2] if heap else []:
        items, stack = [], [tree]
        while stack:
            t = stack.pop()
            if isinstance(t, tuple):
                stack += [t[1], t[0]]
            else:
                items.append(t)
        out.append(items)
    return out + [[] for _ in range(k - len(out))] if out else out


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers of near-equal windows, none of which exceeds the capacity.

    The count begins at the least that could do and rises until differencing gives no
    window over the capacity.  An item longer than that raises ValueError; without items there is no window.
    """
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("an item exceeds the capacity")
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = differencing(sizes, k)
        if max(sum(sizes[i] for i in items) for items in sets) <= capacity:
            return [items for items in sets if items]
        k += 1


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


#: doc_id, start, ids, doc_tokens
Piece = tuple[int | None, int, np.ndarray, int]


class _Packer:
    """Windows of one partition, with sequence ids of its own."""

    def __init__(self, partition: int, capacity: int, group: int):
        self.capacity, self.full = capacity, capacity * group
        self.sequence = partition << 40
        self.pieces: list[Piece] = []
        self.held = 0
        #: Windows of a group that still have gaps, the largest gap last.
        self.gaps: list[tuple[int, list[Piece]]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        n, at = len(ids), 0
        while at < n:
            if self.gaps:
                gap, window = self.gaps.pop()
                part = ids[at : at + gap]
                window.append((doc_id, at, part, n))
                if len(part) < gap:
                    self.gaps.append((gap - len(part), window))
                else:
                    yield from self._write(window)
            else:
                part = ids[at : at + self.capacity]
                if len(part) == self.capacity:
                    yield from self._write([(doc_id, at, part, n)])
                else:
                    self.pieces.append((doc_id, at, part, n))
                    self.held += len(part)
            at += len(part)
        if self.held >= self.full and not self.gaps:
            yield from self._close()

    def _close(self) -> Iterator[tuple]:
        """Windows of the group: full ones are written, the others wait for what fills their gaps."""
        sizes = [len(p[2]) for p in self.pieces]
        for items in windows(sizes, self.capacity):
            window = [self.pieces[i] for i in items]
            gap = self.capacity - sum(sizes[i] for i in items)
            if gap:
                self.gaps.append((gap, window))
            else:
                yield from self._write(window)
        self.gaps.sort(key=lambda x: x[0])
        self.pieces, self.held = [], 0

    def finish(self) -> Iterator[tuple]:
        """What is left: its last documents fill gaps, and what has nothing to fill it goes in lengths that need no padding.

        These are whole windows and then powers of two.
        """
        last: list[Piece] = []
        spare = 0
        while self.pieces and spare < max(self.held // 16, self.capacity):
            last.append(self.pieces.pop())
            spare += len(last[-1][2])
        if not self.gaps:
            yield from self._close()
        rest = self.pieces + last[::-1]
        self.pieces = []
        while self.gaps and rest:
            gap, window = self.gaps.pop()
            doc_id, start, ids, n = rest.pop()
            window.append((doc_id, start, ids[:gap], n))
            if len(ids) < gap:
                self.gaps.append((gap - len(ids), window))
            else:
                yield from self._write(window)
            if len(ids) > gap:
                rest.append((doc_id, start + gap, ids[gap:], n))
        rest += [p for _, window in self.gaps for p in window]
        self.gaps = []
        total = sum(len(p[2]) for p in rest)
        rest.reverse()
        for size in [self.capacity] * (total // self.capacity) + powers_of_two(total % self.capacity):
            window = []
            while size:
                doc_id, start, ids, n = rest.pop()
                window.append((doc_id, start, ids[:size], n))
                if len(ids) > size:
                    rest.append((doc_id, start + size, ids[size:], n))
                size -= len(window[-1][2])
            yield from self._write(window)

    def _write(self, window: list[Piece]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, n in window:
            yield doc_id, start, len(ids), ids.tobytes(), n, self.sequence, offset
            offset += len(ids)
        self.sequence += 1


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, group: int = GROUP, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` ids.

    Returns doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id and offset.  A document is its ids and then ``end_id``; a null text is
    empty.  Repeated rows are packed as often as they occur; an empty table
    gives no rows; other columns are not read.  Sequences are full but for at most
    log2(capacity) per partition, whose lengths are powers of two.
    ``tokenizer`` is the path of a tokenizer file on every executor.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokenizer_of(tokenizer).encode
        packer = _Packer(TaskContext.get().partitionId(), capacity, group)
        end = np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for at in range(0, b.num_rows, 256):
                texts = b.column(1).slice(at, 256).to_pylist()
                for lo, hi in blocks(texts):
                    for doc_id, ids in zip(doc_ids[at + lo : at + hi], encode(texts[lo:hi]), strict=True):
                        for row in packer.add(doc_id, np.frombuffer(ids + end, "<u4")):
                            rows.append(row)
                            size += row[2]
                        if size > 1 << 18:
                            yield batch()
                            rows, size = [], 0
        rows += packer.finish()
        if rows:
            yield batch()
        common.release()

    return common.small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digest(pack(common.table(spark, sf_dir, "documents")))


def with_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
