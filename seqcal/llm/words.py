"""Words of whole texts and their hashes, computed on Arrow buffers a slice of documents at a time.

A word is a run of bytes outside [\\x20\\x09-\\x0D]. Its hash chains mixed blocks of eight bytes behind a state that
depends on a key, from LONG bytes on it is a BLAKE2b digest with that key. Where unequal words must not meet, the key is
drawn for each run (fresh_key) and travels to the tasks with their function, so nobody can prepare words that meet. The hash of a window of words is a polynomial over the prime field of 2**61 - 1 (Rabin-Karp), for
all windows of a size at once by doubling. All functions are pure: with one key the same text has the same hashes on
every executor and in every attempt.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
NORMAL = LOWER.copy()  # lower case, ASCII punctuation as white space
NORMAL[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 0x20
PRIME = U64(2**61 - 1)
BASE, SECOND_BASE = 0x11B7A6C94D2E5F03, 0x0E5C1D8A37F96B21  # of two independent window hashes
LONG = 64
BLOCK_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
SLICE_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def fresh_key() -> int:
    return secrets.randbits(64)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int = 0) -> np.ndarray:
    """Hashes of data[start:end] for all pairs at once."""
    n = ends - starts
    out = mix((n.astype(np.uint64) + U64(0x9E3779B97F4A7C15)) ^ mix(np.array([key], dtype=np.uint64)))
    blocks = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, dtype=np.uint8)]), 8)
    some = np.flatnonzero((n > 0) & (n < LONG))
    for done in range(0, LONG, 8):
        some = some[n[some] > done]
        if not len(some):
            break
        block = blocks[starts[some] + done].view("<u8").ravel() & BLOCK_MASKS[np.minimum(n[some] - done, 8)]
        out[some] = mix(out[some] + block * U64(0xD1342543DE82EF95))
    secret = key.to_bytes(8, "little")
    for i in np.flatnonzero(n >= LONG):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=secret).digest(), "little")
    return out


def _times(a: np.ndarray, b: int) -> np.ndarray:
    """a * b modulo PRIME, but for a few multiples of it; a and b are below it."""
    low, high = a & U64(2**32 - 1), a >> U64(32)
    b_low, b_high = U64(b & 2**32 - 1), U64(b >> 32)
    middle = high * b_low + low * b_high
    low *= b_low
    return ((high * b_high) << U64(3)) + (middle >> U64(29)) + ((middle & U64(2**29 - 1)) << U64(32)) + (low & PRIME) + (low >> U64(61))


def _reduced(a: np.ndarray) -> np.ndarray:
    a = (a & PRIME) + (a >> U64(61))
    return np.minimum(a, a - PRIME)  # the difference wraps around where a is smaller


def run_hashes(hashes: np.ndarray, size: int, base: int = BASE) -> np.ndarray:
    """Of every run of size hashes: the sum of hash * base**(places behind it) modulo PRIME, mixed."""
    if len(hashes) < size:
        return np.empty(0, dtype=np.uint64)
    values = _reduced(hashes)
    runs, n = values, 1
    for bit in bin(size)[3:]:
        runs = _reduced(_times(runs[: len(values) - 2 * n + 1], pow(base, n, int(PRIME))) + runs[n:])
        n *= 2
        if bit == "1":
            runs = _reduced(_times(runs[: len(values) - n], base) + values[n:])
            n += 1
    return mix(runs + U64(size << 3))


@dataclass
class Slice:
    """Some documents: bytes with the bounds of documents and words. first_word[d]:first_word[d + 1] are document d's words."""

    first_row: int
    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first_word: np.ndarray

    @property
    def documents(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first_word)

    def text(self, d: int) -> bytes:
        return self.data[self.bounds[d] : self.bounds[d + 1]].tobytes()

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def word_hashes(self, key: int = 0) -> np.ndarray:
        return byte_hashes(self.data, self.starts, self.ends, key)

    def window_hashes(self, hashes: np.ndarray, size: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every run of size words within one document, in order."""
        n = len(hashes)
        if n < size:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        document = np.repeat(np.arange(self.documents), self.counts())
        first = np.flatnonzero(document[: n - size + 1] == document[size - 1 :])
        return first, run_hashes(hashes, size, base)[first]

    def documents_of(self, word_indexes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first_word, word_indexes, side="right") - 1


def byte_slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds of the documents in them): whole texts (null: empty) in slices of about limit bytes, one document at least."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    array = texts.cast(pa.large_string()).fill_null("")
    if not len(array):
        return
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.empty(0, dtype=np.uint8)
    at = 0
    while at < len(array):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def slices(texts: pa.Array | pa.ChunkedArray, lower: bool = False, limit: int = SLICE_BYTES, table: np.ndarray | None = None) -> Iterator[Slice]:
    """The byte slices, split in words; table replaces bytes."""
    if lower:
        table = LOWER
    for first_row, data, bounds in byte_slices(texts, limit):
        yield split_words(first_row, data if table is None else table[data], bounds)


def split_words(first_row: int, data: np.ndarray, bounds: np.ndarray) -> Slice:
    inside = ~SPACE[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)  # a document begins here
    fresh[bounds] = True
    starts = np.flatnonzero(inside & (np.concatenate([[False], ~inside[:-1]]) | fresh[:-1])) if len(data) else np.empty(0, dtype=np.int64)
    ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [False]]) | fresh[1:])) + 1 if len(data) else starts
    return Slice(first_row, data, bounds, starts, ends, np.searchsorted(starts, bounds))


def covered(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in one of the windows that begin at first."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + size, -1)
    return np.cumsum(change[:-1]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Marks the values that stand in keys twice or more."""
    if not len(keys):
        return np.zeros(0, dtype=bool)
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    return out
