"""Packing: order-preserving dynamic programming over the cuts of a token stream.

Each input partition is one stream of documents in their stored order. Cuts may fall after a document (free), after a
sentence (small penalty) or, in stretches without either, at fixed steps (larger penalty). With f(j) the least cost of
a packing that ends at cut j,

    f(j) = penalty(j) + size - p(j) + min { f(i) + p(i) : p(j) - size <= p(i) < p(j) },

the minimum over a sliding window is kept in a monotone queue, so a stream costs linear time. Streams are cut in
blocks of bounded size; the open sequence of a block moves to the next one. There is no shuffle.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .storage import prepare
from .tokens import Encoder, encoder, tokenizer_path

SIZE = 1024
END_ID = 0
SENTENCE_PENALTY, STEP_PENALTY = 2.0, 24.0  # in tokens of padding
STEP = 64
BLOCK = 1 << 18

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def sentence_ends(own: Encoder) -> np.ndarray:
    """For each id whether a sentence may end after it: . ! ? or a line end (byte-level form) closes its string."""
    vocabulary = own.tokenizer.get_vocab()
    table = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    table[[i for x, i in vocabulary.items() if x.endswith((".", "!", "?", "Ċ"))]] = True
    return table


def candidate_cuts(ids: np.ndarray, document_ends: np.ndarray, ends: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(places, penalties) of all cuts in 1..len(ids), none more than step apart."""
    penalty = np.full(len(ids) + 1, np.inf)
    penalty[np.flatnonzero(ends[ids]) + 1] = SENTENCE_PENALTY
    penalty[document_ends] = 0.0
    penalty[len(ids)] = min(penalty[len(ids)], STEP_PENALTY)
    places = np.concatenate([[0], np.flatnonzero(penalty < np.inf)])
    gaps = np.diff(places)
    more = np.flatnonzero(gaps > step)
    fill = (gaps[more] - 1) // step
    extra = np.repeat(places[more], fill) + step * (np.arange(fill.sum()) - np.repeat(np.cumsum(fill) - fill, fill) + 1)
    penalty[extra] = STEP_PENALTY
    places = np.flatnonzero(penalty < np.inf)
    return places, penalty[places]


def best_cuts(places: list[int], penalties: list[float], size: int = SIZE, closed: bool = True) -> list[int]:
    """The cuts of a cheapest packing of 0..places[-1]; of one without its open last sequence unless closed."""
    places, cost, last = [0, *places], [0.0], [0]
    window: deque[int] = deque()
    key = [0.0]
    for j in range(1, len(places)):
        i = j - 1
        while window and key[window[-1]] > key[i]:
            window.pop()
        window.append(i)
        p = places[j]
        while places[window[0]] < p - size:
            window.popleft()
        best = window[0]
        cost.append(penalties[j - 1] + size - p + key[best])
        last.append(best)
        key.append(cost[j] + p)
    end = len(places) - 1
    if not closed:  # the rest goes on, so it costs no padding yet; any cut within reach may be the last one
        low = end
        while low and places[low - 1] >= places[end] - size:
            low -= 1
        end = min(range(low, end + 1), key=lambda i: (cost[i], -i))
    cuts = []
    while end:
        cuts.append(places[end])
        end = last[end]
    return cuts[::-1]


class Packer:
    """The open stream of one partition."""

    def __init__(self, ends: np.ndarray, first_sequence: int, size: int):
        self.ends, self.sequence, self.size = ends, first_sequence, size
        self.ids: list[np.ndarray] = []
        self.documents: list[tuple[int | None, int, int, int]] = []  # doc_id, ids already packed, ids here, all ids
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.documents.append((doc_id, 0, len(ids), len(ids)))
        self.held += len(ids)

    def packed(self, closed: bool) -> list[tuple]:
        """The pieces of all sequences but, unless closed, the open one."""
        if not self.held:
            return []
        ids = np.concatenate(self.ids)
        bounds = np.cumsum([0, *(d[2] for d in self.documents)])
        places, penalties = candidate_cuts(ids, bounds[1:], self.ends)
        cuts = np.array([0, *best_cuts(places.tolist(), penalties.tolist(), self.size, closed)])
        points = np.unique(np.concatenate([cuts, bounds[bounds < cuts[-1]]]))
        a, b = points[:-1], points[1:]
        document, sequence = np.searchsorted(bounds, a, side="right") - 1, np.searchsorted(cuts, a, side="right") - 1
        out = []
        for x, y, d, s, c in zip(a.tolist(), b.tolist(), document.tolist(), sequence.tolist(), cuts[sequence].tolist(), strict=True):
            doc_id, done, _, total = self.documents[d]
            out.append((doc_id, done + x - int(bounds[d]), y - x, zlib.crc32(ids[x:y]), total, self.sequence + s, x - c))
        self.sequence += len(cuts) - 1
        at = int(cuts[-1])
        first = int(np.searchsorted(bounds, at, side="right")) - 1
        rest = []
        for d in range(first, len(self.documents)):
            doc_id, done, n, total = self.documents[d]
            skip = max(0, at - int(bounds[d]))
            if n > skip:
                rest.append((doc_id, done + skip, n - skip, total))
        self.documents, self.ids, self.held = rest, [ids[at:]] if at < len(ids) else [], len(ids) - at
        return out


def _pack(path: str, end_id: int, size: int):
    types = [pa.int64()] * 7
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        packer = Packer(sentence_ends(own), TaskContext.get().partitionId() << 36, size)
        for batch in batches:
            ids, bounds = own.encode_with_end(batch["text"], end_id)
            for doc_id, a, b in zip(batch["doc_id"].to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                packer.add(doc_id, ids[a:b])
                if packer.held >= BLOCK and (rows := packer.packed(False)):
                    yield batch_of(rows)
        if rows := packer.packed(True):
            yield batch_of(rows)

    return run


def pack(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece of a document of docs(doc_id, text): doc_id, start (ids of its document before it),
    length, ids_crc32, doc_tokens (all ids of the document, its end id included), sequence_id and offset there.

    A null text is empty and packs as its end id alone; rows without doc_id and repeated rows are packed like others.
    A sequence holds size ids at most; its pieces leave no gap. An empty table has no pieces.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(_pack(tokenizer or tokenizer_path(), end_id, size), PIECES)
