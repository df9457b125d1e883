"""The draws of Python's random.Random, replayed in arrays: whole numbers below bounds that rise or fall by one.

A draw takes as many 32-bit words as its bound has bits, drops the bits too many, and is repeated while its value is not
below the bound. Which draws are repeated depends on those before, as these move the bound: a chunk of draws is judged at
once and again until nothing changes, which settles it from the left. Memory is that of a chunk, whatever the number of
draws.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20  # draws judged at once


class Words:
    """The 32-bit words of random.Random(seed), with the way back to any place that was marked."""

    def __init__(self, seed: str | int | None = None, mark: tuple[dict, int] | None = None):
        self.source = np.random.MT19937()
        if mark is None:
            *key, place = random.Random(seed).getstate()[1]
            mark = ({"bit_generator": "MT19937", "state": {"key": np.array(key, dtype=np.uint32), "pos": place}}, 0)
        self.begin, self.used = mark  # the state that buffer starts from, and the words of it that are gone
        self.buffer = np.empty(0, dtype=np.uint64)

    def mark(self) -> tuple[dict, int]:
        return self.begin, self.used

    def peek(self, n: int) -> np.ndarray:
        if len(self.buffer) - self.used < n:
            self.source.state = self.begin
            self.source.random_raw(self.used)
            self.begin, self.used = self.source.state, 0
            self.buffer = self.source.random_raw(n)
        return self.buffer[self.used : self.used + n]

    def skip(self, n: int) -> None:
        self.used += n


def below(words: Words, start: int, stop: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, tuple[dict, int]]]:
    """(bounds, values, mark of the words before them) by chunks: what randrange gives for each bound of range(start,
    stop, step); step is 1 or -1, bounds are from 1 to 2**62."""
    bound = start
    while (stop - bound) * step > 0:
        bits = bound.bit_length()
        other = 1 << bits if step > 0 else (1 << (bits - 1)) - 1  # the next bound of another length
        left = abs((min if step > 0 else max)(stop, other) - bound)
        tries = min(CHUNK, max(64, bound // 8), 4 * left + 64)
        mark = words.mark()
        raw = words.peek(tries * (2 if bits > 32 else 1))
        values = (raw[::2] | raw[1::2] >> np.uint64(64 - bits) << np.uint64(32) if bits > 32 else raw >> np.uint64(32 - bits)).astype(np.int64)
        taken = values < bound
        while True:
            again = values < bound + step * (np.cumsum(taken) - taken)
            if (again == taken).all():
                break
            taken = again
        at = np.flatnonzero(taken)[:left]
        words.skip((int(at[-1]) + 1 if len(at) == left else tries) * (2 if bits > 32 else 1))
        if len(at):
            yield bound + step * np.arange(len(at)), values[at], mark
        bound += step * len(at)


def reservoir_ranks(seed: str, size: int, seen: int) -> np.ndarray:
    """Which of 0..seen-1 stands in each slot of a reservoir after all have passed it (Algorithm R)."""
    slots = np.arange(min(size, seen))
    for bounds, values, _ in below(Words(seed), size + 1, seen + 1, 1):
        stays = values < size
        np.maximum.at(slots, values[stays], bounds[stays] - 1)  # later items are greater ones
    return slots


def shuffled_ranks(seed: str, size: int, n: int) -> np.ndarray:
    """The first size places of a shuffled 0..n-1.

    A shuffle swaps each place, from the last one down, with one not above it. Going back from its end, through the draws
    in reverse, the places to be filled lead to what was there at first. Marks of all chunks are kept, not draws.
    """
    size = min(size, n)
    marks = [(int(bounds[0]), len(bounds), mark) for bounds, _, mark in below(Words(seed), n, 1, -1)]
    slot_at = {i: i for i in range(size)}
    for first, count, mark in reversed(marks):
        again = list(below(Words(mark=mark), first, first - count, -1))
        i, j = (np.concatenate([x[k] for x in again])[::-1] for k in (0, 1))
        i = i - 1
        held = np.sort(np.fromiter(slot_at, dtype=np.int64, count=len(slot_at)))
        met = held[np.minimum(np.searchsorted(held, j), max(len(held) - 1, 0))] == j if len(held) else np.zeros(len(j), dtype=bool)
        for a, b in zip(*(x[(i < size) | met | (j >= i[0])].tolist() for x in (i, j)), strict=True):
            if a != b:
                x, y = slot_at.pop(a, None), slot_at.pop(b, None)
                if x is not None:
                    slot_at[b] = x
                if y is not None:
                    slot_at[a] = y
    out = np.empty(size, dtype=np.int64)
    out[list(slot_at.values())] = list(slot_at)
    return out
