import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from astrolode.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def laid_out(runs):
    """Sequence -> its (offset, length) pairs; checks that ranks of a length are gapless."""
    found, ranks = defaultdict(list), defaultdict(list)
    for length, rank, count, sequence, offset in runs:
        ranks[length].append((rank, count))
        for i in range(count):
            found[sequence + i].append((offset, length))
    for parts in ranks.values():
        at = 0
        for rank, count in sorted(parts):
            assert rank == at
            at += count
    return found


def check(histogram, capacity):
    runs = packing.plan(histogram, capacity)
    found = laid_out(runs)
    placed = defaultdict(int)
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
            placed[length] += 1
        assert at <= capacity
    assert placed == {k: n for k, n in histogram.items() if n}
    return len(found)


def fewest(items, capacity):
    """The least number of sequences, by trying everything."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - items[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9), st.integers(20, 24))
def test_close_to_the_best(items, capacity):
    histogram = defaultdict(int)
    for i in items:
        histogram[i] += 1
    assert check(dict(histogram), capacity) <= fewest(items, capacity) + (len(items) > 6)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8), st.integers(20, 24))
def test_reduction_loses_nothing(items, capacity):
    histogram = defaultdict(int)
    for i in items:
        histogram[i] += 1
    plan = packing._Plan(dict(histogram), capacity)
    packing._reduce(plan)
    rest = [length for length, n in plan.left.items() for _ in range(n)]
    assert plan.sequences + fewest(rest, capacity) == fewest(items, capacity)


def test_many_pieces_reach_the_bound():
    rnd = random.Random(2)
    histogram = defaultdict(int)
    for _ in range(30_000):
        histogram[min(4096, int(rnd.lognormvariate(6, 1)) + 1)] += 1
    total = sum(k * n for k, n in histogram.items())
    assert check(dict(histogram), 4096) <= 1.002 * -(-total // 4096)
    wide = {k: n * 10**6 for k, n in histogram.items()}
    assert len(packing.plan(wide)) < 40_000  # its size does not follow the number of pieces


def test_odd_histograms():
    assert packing.plan({}) == []
    assert check({4096: 3}, 4096) == 3 and check({1: 10_000}, 4096) == 3
    for wrong in ({0: 1}, {5000: 1}):
        with pytest.raises(ValueError):
            packing.plan(wrong)


@pytest.mark.parametrize("capacity", [4096, 50])
def test_rows(odd_docs, odd_rows, capacity):
    library = Tokenizer.from_file(PATH)
    want, tokens = [], 0
    for key, text in odd_rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, packing.END]
        tokens += len(ids)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            held = ids[at:at + capacity]
            want.append((key, piece, at, len(held), zlib.crc32(np.array(held, "<u4").tobytes())))
    rows = packing.pack(odd_docs, PATH, capacity).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    spots = defaultdict(list)
    for r in rows:
        spots[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in spots.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(spots) <= 1.15 * -(-tokens // capacity) + 1


def test_empty(no_docs):
    assert packing.pack(no_docs, PATH).collect() == []
