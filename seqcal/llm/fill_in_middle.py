"""Fill-in-middle transformation by displacement scatter.

A document is cut in units (white space with the word behind it; white space at the end is a unit of its own) and, at
two of the units' ends, in prefix, middle and suffix. A batch of documents is one array of bytes. Each part of each
document moves by one shift, so a difference array with the change of shift at every cut, summed up, gives the shift of
every byte; one scatter builds all outputs, and the markers go into the gaps. The way back reads the parts from the
markers of an output, sums up the shifts the same way and gathers.

A batch is worked on in slices of about 512 kB (a longer text alone), sums and scatters in spans of SPAN bytes, so
memory is a few times one slice. There is no shuffle and no state: a lost task is run again with the same outcome, as
all draws are hashes of doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import prepare
from .words import Slice, byte_slices, split_words

MARKERS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle; all of one length
MARKER_BYTES = np.array([list(m.encode()) for m in MARKERS], dtype=np.uint8)
FORMS = np.array(["plain", "psm", "spm"], dtype=object)
PLAIN, PSM, SPM = range(3)
SPAN = 1 << 20
COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int, seed: int) -> bytes:
    """Four unsigned 32-bit numbers, big-endian: the first 16 bytes of sha256 of seed:doc_id."""
    return hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()[:16]


def marker_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, number of the marker) of all markers in the bytes, in order."""
    if len(data) < 3:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    open_, letter, close = MARKER_BYTES[0, 0], MARKER_BYTES[:, 1], MARKER_BYTES[0, 2]
    at = np.flatnonzero((data[:-2] == open_) & (data[2:] == close))
    which = (data[at + 1][:, None] == letter).argmax(axis=1)
    real = data[at + 1] == letter[which]
    return at[real], which[real]


def shifts(starts: np.ndarray, moves: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first byte, shift of each byte) by spans, for parts that begin at starts (in order, some may be empty) and move
    by moves."""
    change = np.zeros(size + 1, dtype=np.int64 if size > 1 << 30 else np.int32)
    np.add.at(change, starts, np.diff(moves, prepend=0).astype(change.dtype))
    now = 0
    for at in range(0, size, SPAN):
        span = now + np.cumsum(change[at : min(at + SPAN, size)], dtype=np.int64)
        yield at, span
        now = span[-1]


def unit_ends(part: Slice, k: np.ndarray) -> np.ndarray:
    """Where the first k[d] units of each document end."""
    words, first = part.counts(), part.first_word[:-1]
    ends = np.concatenate([part.ends, [0]])  # never read at the place added
    at_word = ends[first + np.clip(k, 1, np.maximum(words, 1)) - 1]
    return np.where(k == 0, part.bounds[:-1], np.where(k <= words, at_word, part.bounds[1:]))


def arranged(part: Slice, ids: list[int | None], seed: int, percent: int, spm_percent: int) -> pa.RecordBatch:
    """The outputs of a slice of documents."""
    begin, end = part.bounds[:-1], part.bounds[1:]
    words = part.counts()
    last = np.concatenate([part.ends, [0]])[part.first_word[1:] - 1]
    n = words + (np.where(words > 0, last, begin) < end)
    h = np.frombuffer(b"".join(draws(0 if i is None else i, seed) for i in ids), dtype=">u4").reshape(-1, 4).astype(np.int64)
    taken = np.zeros(part.documents, dtype=bool)  # a marker stands in the text itself
    at, _ = marker_places(part.data)
    owner = np.searchsorted(part.bounds, at, side="right") - 1
    taken[owner[at + 3 <= end[owner]]] = True
    plain = (begin == end) | taken | (h[:, 2] % 100 >= percent) | np.array([i is None for i in ids], dtype=bool)
    form = np.where(plain, PLAIN, np.where(h[:, 3] % 100 < spm_percent, SPM, PSM))

    cut1, cut2 = (unit_ends(part, k) for k in np.sort(h[:, :2] % (n + 1)[:, None], axis=1).T)
    prefix, middle, suffix = cut1 - begin, cut2 - cut1, end - cut2
    bounds = np.concatenate([[0], np.cumsum(end - begin + np.where(plain, 0, MARKER_BYTES.size))])
    base = bounds[:-1]
    to_prefix = base + np.where(form == SPM, 6 + suffix, 3)
    to_suffix = base + np.where(form == SPM, 3, 6 + prefix)
    to_middle = base + 9 + prefix + suffix
    moves = np.stack([to_prefix - begin, to_middle - cut1, to_suffix - cut2], axis=1)
    moves[plain] = (base - begin)[plain, None]
    out = np.empty(bounds[-1], dtype=np.uint8)
    for first, shift in shifts(np.stack([begin, cut1, cut2], axis=1).ravel(), moves.ravel(), len(part.data)):
        out[np.arange(first, first + len(shift)) + shift] = part.data[first : first + len(shift)]
    for target, marker in zip((to_prefix, to_suffix, to_middle), MARKER_BYTES, strict=True):
        out[target[~plain][:, None] + np.arange(-3, 0)] = marker

    chars = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    lengths = [pa.array(np.where(plain, 0, chars[b] - chars[a]), mask=plain) for a, b in ((begin, cut1), (cut1, cut2))]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n), pa.array(FORMS[form], pa.string()), *lengths, string_array(out, bounds)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def string_array(data: np.ndarray, bounds: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    found = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
    if null is not None and null.any():
        found = pa.compute.if_else(pa.array(~null), found, pa.scalar(None, pa.large_string()))
    return found.cast(pa.string())


def rebuilt(data: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> pa.Array:
    """The texts of a slice of outputs, from their bytes and forms; null where an output has not each marker once."""
    begin, end = bounds[:-1], bounds[1:]
    at, which = marker_places(data)
    owner = np.searchsorted(bounds, at, side="right") - 1
    inside = at + 3 <= end[owner]
    at, which, owner = at[inside], which[inside], owner[inside]
    seen = np.zeros((len(begin), 3), dtype=np.int64)
    np.add.at(seen, (owner, which), 1)
    place = np.zeros((len(begin), 3), dtype=np.int64)
    place[owner, which] = at
    plain = form == PLAIN
    p, s, m = place.T
    ordered = np.where(form == SPM, (begin == s) & (s < p) & (p < m), (begin == p) & (p < s) & (s < m))
    bad = ~plain & ~((seen == 1).all(axis=1) & ordered)
    moved = ~plain & ~bad
    prefix = np.where(moved, np.where(form == SPM, m, s) - p - 3, end - begin)
    suffix = np.where(moved, np.where(form == SPM, p, m) - s - 3, 0)
    middle = np.where(moved, end - m - 3, 0)
    back = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    starts = np.stack([back[:-1], back[:-1] + prefix, back[:-1] + prefix + middle], axis=1)
    sources = np.where(moved[:, None], np.stack([p + 3, m + 3, s + 3], axis=1), np.stack([begin, end, end], axis=1))
    out = np.empty(back[-1], dtype=np.uint8)
    for first, shift in shifts(starts.ravel(), (sources - starts).ravel(), len(out)):
        out[first : first + len(shift)] = data[np.arange(first, first + len(shift)) + shift]
    return string_array(out, back, bad)


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points), output for every row of docs(doc_id, text).

    percent hundredths of the documents are rearranged, of those spm_percent hundredths as suffix, prefix, middle and
    the others as prefix, suffix, middle. A text that is null or empty or that holds a marker stays as it is (plain, null
    as an empty text, both lengths null), and so does a row without doc_id, as its draws have no key. Rows that repeat a
    doc_id have the same draws. Other columns of docs are not read.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for first, data, bounds in byte_slices(batch["text"]):
                yield arranged(split_words(first, data, bounds), ids[first : first + len(bounds) - 1], seed, percent, spm_percent)

    return docs.select("doc_id", "text").mapInArrow(run, COLUMNS)


def restored(outputs: DataFrame, name: str = "restored") -> DataFrame:
    """outputs(form, output, ...) with the text that each output was built from, in column name.

    A null output counts as empty; a form other than psm and spm counts as plain. Where an output lacks the markers of
    its form, in their order and each once, the text is null.
    """
    prepare(outputs.sparkSession)
    names = outputs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {x: i for i, x in enumerate(FORMS)}
        for batch in batches:
            form = np.array([known.get(x, PLAIN) for x in batch["form"].to_pylist()], dtype=np.int64)
            for first, data, bounds in byte_slices(batch["output"]):
                part = batch.slice(first, len(bounds) - 1)
                yield pa.RecordBatch.from_arrays([*part.columns, rebuilt(data, bounds, form[first : first + len(bounds) - 1])], names=[*names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema)
    return outputs.mapInArrow(run, f"{schema}, `{name}` string")


def digests(outputs: DataFrame) -> DataFrame:
    """The rows of fill_in_middle with digests of the output and of the text rebuilt from it."""
    whole = [F.sha2(x, 256).alias(f"{x}_sha256") for x in ("output", "restored")]
    return restored(outputs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *whole)
