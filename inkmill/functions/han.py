"""Chinese text: garbled fonts and keywords."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.batches import bound_batches, release
from inkmill.functions.binding import bound

HAN = "一-鿿"
#: Blocks of radicals that broken fonts use for characters (fixed values).
RADICALS = "⺀-⻿⼀-⿟"
MIN_HAN, MAX_RADICALS, MAX_REPEATS = 50, 0.03, 0.06
#: Characters and words that keywords don't have (fixed values).
STOP_CHARS = "的了是在和有不我你他她它们个这那与就都而及等或被把对从到于会能可要也很更最还只"
STOP_WORDS = (
    "如何 因为 所以 什么 时候 已经 现在 知道 觉得 没有 然后 但是 如果 这样 那样 一一 一个 自己 东西 地方 "
    "开始 起来 出来 进行 通过 以及 其中 其实 当时 今天"
).split()


def han(c: Column) -> Column:
    return F.regexp_replace(c, f"[^{HAN}]+", "")


def han_count(c: Column) -> Column:
    return F.length(han(c))


def radical_rate(c: Column) -> Column:
    """Radicals per Han character (of one at least)."""
    return F.regexp_count(c, F.lit(f"[{RADICALS}]")) / F.greatest(han_count(c), F.lit(1))


def repeat_rate(c: Column) -> Column:
    """Share of Han characters that equal the Han character before, whatever stands between."""
    return F.regexp_count(han(c), F.lit(r"(.)(?=\1)")) / F.greatest(han_count(c), F.lit(1))


def garbled(c: Column, radicals: float = MAX_RADICALS, repeats: float = MAX_REPEATS, least: int = MIN_HAN) -> Column:
    def judged(x: Column) -> Column:
        most = F.greatest(x["n"], F.lit(1))
        again = F.regexp_count(x["h"], F.lit(r"(.)(?=\1)")) / most
        return (x["n"] >= least) & ((F.regexp_count(x["c"], F.lit(f"[{RADICALS}]")) / most > radicals) | (again > repeats))

    return bound(F.struct(c.alias("c"), han(c).alias("h")), lambda x: bound(F.struct(x["c"].alias("c"), x["h"].alias("h"), F.length(x["h"]).alias("n")), judged))


def _foldings() -> tuple[str, str]:
    """Radicals and what compatibility normalization makes of them; all are one to one."""
    pairs = [(chr(o), unicodedata.normalize("NFKC", chr(o))) for low, high in ((0x2E80, 0x2EFF), (0x2F00, 0x2FDF)) for o in range(low, high + 1)]
    pairs = [(a, b) for a, b in pairs if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_radicals(c: Column) -> Column:
    """Radicals as the characters they stand for; nothing else is normalized."""
    return F.translate(c, *_foldings())


def single_repeats(c: Column) -> Column:
    """Runs of a Han character to one, for characters that follow themselves three times in the text."""
    again = F.regexp_extract_all(c, F.lit(rf"([{HAN}])(?=\1)"), 1)
    # of the sorted repeats, those that stand two places later again are there three times
    often = bound(F.array_sort(again), lambda a: F.array_join(F.array_distinct(F.filter(a, lambda x, i: F.get(a, i + 2) == x)), ""))
    return F.when(often != "", F.regexp_replace(c, F.concat(F.lit("(["), often, F.lit(r"])\1+")), F.lit("$1"))).otherwise(c)


def repair(c: Column) -> Column:
    return single_repeats(fold_radicals(c))


_STOP = np.array([[ord(a), ord(b)] for a, b in STOP_WORDS], np.int64)
_STOP_PAIRS = np.sort(_STOP[:, 0] << 32 | _STOP[:, 1])
_NONE = np.empty(0, np.int64)
_STOP_CODES = np.sort(np.array([ord(x) for x in STOP_CHARS], np.int64))


def _pairs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of neighbouring Han characters without stop words: both characters in one number, count, first place."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    good = (codes >= ord(HAN[0])) & (codes <= ord(HAN[-1]))
    if not good.any():
        return _NONE, _NONE, _NONE
    good[good] = ~np.isin(codes[good], _STOP_CODES)
    at = np.flatnonzero(good[:-1] & good[1:])
    both = codes[at] << 32 | codes[at + 1]
    found, first, count = np.unique(both, return_index=True, return_counts=True)
    keep = ~np.isin(found, _STOP_PAIRS)
    return found[keep], count[keep], first[keep]


def frequent_pairs(text: str, top: int, least: int) -> list[str]:
    found, count, first = _pairs(text)
    ranked = np.lexsort((first, -count))[: 4 * top]
    taken: list[str] = []
    used: set[int] = set()
    for both in found[ranked[count[ranked] >= least]].tolist():
        own = {both >> 32, both & 0xFFFFFFFF}
        if len(taken) < top and not own & used:
            used |= own
            taken.append(chr(both >> 32) + chr(both & 0xFFFFFFFF))
    return taken


def keywords(c: Column, top: int = 6, least: int = 4) -> Column:
    """The most frequent pairs that share no character, at most ``top``; null has none.

    Of the ``4 * top`` most frequent (the first to occur leads among equals), those that occur ``least`` times are taken in turn
    unless one taken before has one of their characters.  It all happens within a row, in Arrow
    batches, so nothing is shuffled however many pairs a corpus has; as array functions it took ten times as long.
    Batches are bounded, and the function is not marked as deterministic: a filter on keywords that is pushed below them would have
    them computed twice, in two Python workers for each core.
    """
    bound_batches()

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda t: frequent_pairs(t or "", top, least))
        release()

    return of.asNondeterministic()(c)
