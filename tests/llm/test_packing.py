import random
from itertools import product

import numpy as np
import pytest

from inkmill.llm import packing


def spread_of_best(sizes, k):
    """The least possible difference of the sums of k subsets, by trying all."""
    best = sum(sizes)
    for deal in product(range(k), repeat=len(sizes)):
        sums = [0] * k
        for s, to in zip(sizes, deal):
            sums[to] += s
        best = min(best, max(sums) - min(sums))
    return best


def sums_of(sizes, sets):
    assert sorted(i for s in sets for i in s) == list(range(len(sizes)))
    return [sum(sizes[i] for i in s) for s in sets]


@pytest.mark.parametrize("seed", range(30))
def test_differencing_against_all_partitions(seed):
    rng = random.Random(seed)
    k = rng.choice([2, 3])
    sizes = [rng.randint(1, 60) for _ in range(rng.randint(k, 8))]
    sums = sums_of(sizes, packing.differencing(sizes, k))
    spread = max(sums) - min(sums)
    assert spread_of_best(sizes, k) <= spread <= max(sizes)


def test_differencing_known_case():
    assert sorted(sums_of([8, 7, 6, 5, 4], packing.differencing([8, 7, 6, 5, 4], 2))) == [14, 16]  # the textbook result
    assert packing.differencing([], 3) == [] and packing.differencing([5], 1) == [[0]]


def first_feasible(sizes, capacity):
    k = max(1, -(-sum(sizes) // capacity))
    while not any(max(sum(s for s, d in zip(sizes, deal) if d == to) for to in range(k)) <= capacity for deal in product(range(k), repeat=len(sizes))):
        k += 1
    return k


@pytest.mark.parametrize("seed", range(20))
def test_count_rises_until_no_window_exceeds(seed):
    rng = random.Random(100 + seed)
    sizes = [rng.randint(1, 20) for _ in range(6)]
    got = packing.windows(sizes, 20)
    assert max(sums_of(sizes, got)) <= 20
    assert first_feasible(sizes, 20) <= len(got) <= first_feasible(sizes, 20) + 1


def test_windows_rise():
    assert len(packing.windows([3, 3, 3, 3], 5)) == 4  # 12 tokens would go in three windows of 5 if they could be cut
    assert packing.windows([], 5) == []
    with pytest.raises(ValueError):
        packing.windows([6], 5)


def packed(lengths, capacity=64, group=4):
    p, rows = packing._Packer(3, capacity, group), []
    for i, n in enumerate(lengths):
        rows += p.add(i, np.arange(n, dtype="<u4") + 1000 * i)
    return rows + list(p.finish())


@pytest.mark.parametrize("lengths", [[], [1], [64], [63], [65], [1] * 500, [33] * 100, [63] * 50, [500], [64 * 4], [200, 1, 1, 63] * 20])
def test_every_id_once_and_no_padding(lengths):
    check(lengths)


@pytest.mark.parametrize("seed", range(20))
def test_random_lengths(seed):
    rng = random.Random(seed)
    check([min(400, int(rng.expovariate(1 / 30)) + 1) for _ in range(rng.randint(1, 300))])


def check(lengths):
    rows = packed(lengths)
    ids, sequences = {}, {}
    for doc, start, length, data, n, sequence, offset in rows:
        assert length == len(data) // 4 > 0 and n == lengths[doc]
        ids.setdefault(doc, []).append((start, np.frombuffer(data, "<u4")))
        sequences.setdefault(sequence, []).append((offset, length))
    assert sorted(ids) == [i for i, n in enumerate(lengths) if n]
    for doc, parts in ids.items():
        parts.sort(key=lambda x: x[0])
        assert np.concatenate([x for _, x in parts]).tolist() == [1000 * doc + j for j in range(lengths[doc])]
        assert [s for s, _ in parts] == np.cumsum([0] + [len(x) for _, x in parts])[:-1].tolist()
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        total = sum(n for _, n in parts)
        assert total <= 64 and total & (total - 1) == 0  # full, or a power of two: no padding


def test_pieces_of_a_group_stay_whole():
    rng = random.Random(5)
    lengths = [rng.randint(1, 60) for _ in range(2000)]
    cut = sum(1 for r in packed(lengths, 64, 32) if r[4] > r[2] and r[1] == 0)
    assert cut < 0.35 * len(lengths)  # only those that fill gaps
