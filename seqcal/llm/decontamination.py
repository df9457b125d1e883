"""Benchmark decontamination by latent semantic retrieval: randomised SVD of TF-IDF passages, cosine candidates, then
longest common subsequences and answer checks.

The benchmark is the stated query set: it is taken in blocks of BLOCK_WORDS words, each against all documents. Items and
documents are cut into passages alike, of 64 words, or of 32 for items no longer than that. For a block (1) one pass counts in how many passages of the corpus each of the
block's words stands; (2) a randomised SVD (Halko et al., 2011) of TF-IDF passages gives the latent space. Its basis is
fitted on the block's passages and all passages of the corpus, which together weigh as much as FIT_PASSAGES at most; each
task sends its sum of their products. (3) Every passage of every document is projected and compared with all passages of the
block; where a cosine is above MIN_COSINE, the region around is aligned word by word with the whole item, in the same
task, as the words are there. A region that holds SURE_COMMON of the item's words in order is a match; one that holds
MIN_COMMON is a paraphrase if it also holds the answer, the item's last sentence. Of an item of under DENSE_BELOW words
a wide region holds many in order by chance, so DENSE_COMMON of them must stand within one and a half times its length. (4) Beside the latent search every run
of run_words() words of an item is looked up exactly, so a verbatim copy of a part is found whatever its share of the
item or the passage; items of under MIN_WORDS words are searched in this way alone, as a whole. Nothing is shuffled but
counts and sums. The tests measure the recall of the candidate search against brute force.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import prepare, row_key, written
from .words import NORMAL, Slice, run_hashes, slices

BLOCK_ITEMS, BLOCK_WORDS = 2048, 50_000
CELL, CELLS, MIN_WORDS = 32, (16, 32), 5  # a passage is two neighbouring cells; shorter items are found as a whole only
RANK, OVERSAMPLE, FIT_PASSAGES, ITEM_WEIGHT, SHARE_WORDS = 256, 16, 100_000, 30.0, 1024
MIN_COSINE, MIN_COMMON, SURE_COMMON, MIN_ANSWER = 0.45, 0.6, 0.8, 0.5
MIN_RUN, LONG_RUN = 8, 13
DENSE_BELOW, DENSE_COMMON = 12, 0.7
FILTER_BITS, SVD_SLICE, CELL_BLOCK, PASSAGE_BLOCK = 20, 1 << 16, 64, 512
FOUND = "doc_id long, key binary, item_id long, start_word long, end_word long, cosine double, common double, answer double"


def run_words(n: int) -> int:
    """So many words of an item of n words, side by side, are a copy: MIN_COMMON of it, from MIN_RUN to LONG_RUN words."""
    return min(n, LONG_RUN, max(MIN_RUN, int(np.ceil(MIN_COMMON * n))))


class Table:
    """Sorted hashes, found behind a filter of 2**FILTER_BITS flags that most other hashes fail."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.flags = hashes, np.zeros(1 << FILTER_BITS, dtype=bool)
        self.flags[hashes >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which are in the table, their first places)."""
        some = np.flatnonzero(self.flags[hashes >> np.uint64(64 - FILTER_BITS)])
        at = np.searchsorted(self.hashes, hashes[some])
        known = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes[some] if len(self.hashes) else np.zeros(len(some), dtype=bool)
        return some[known], at[known]


class Items:
    """A block of benchmark items as word hashes, with passages, vocabulary and runs; short items stand in the runs alone."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids, self.words, self.answers = [], [], []
        short_ids, short_words = [], []
        for part in slices(pa.array([t for _, t in rows], pa.string()), table=NORMAL):
            hashes = part.word_hashes()
            for d in range(part.documents):
                own = hashes[part.first_word[d] : part.first_word[d + 1]]
                if len(own) >= MIN_WORDS:
                    self.ids.append(rows[part.first_row + d][0])
                    self.words.append(own)
                    self.answers.append(self._answer(rows[part.first_row + d][1], own))
                elif len(own):
                    short_ids.append(rows[part.first_row + d][0])
                    short_words.append(own)
        self.vocabulary = Table(np.unique(np.concatenate(self.words)) if self.words else np.empty(0, dtype=np.uint64))
        self.all_ids, self.all_words, self.all_answers = self.ids + short_ids, self.words + short_words, self.answers + short_words
        self.masks, self.answer_masks = [word_masks(x) for x in self.all_words], [word_masks(x) for x in self.all_answers]
        # passages: item and first word
        cells = [range(0, max(CELL, len(own) - CELL), CELL) for own in self.words]
        self.item = np.repeat(np.arange(len(self.words)), [len(c) for c in cells])
        self.offset = np.array([x for c in cells for x in c], dtype=np.int64)
        self.cell = np.array([next((c for c in CELLS if len(self.words[i]) <= 2 * c), CELL) for i in self.item.tolist()], dtype=np.int64)
        self.needed = np.array([run_words(len(own)) for own in self.all_words], dtype=np.int64)
        self.runs = self._runs()

    def _runs(self) -> dict[int, tuple[Table, np.ndarray, np.ndarray]]:
        """By length (hashes of the items' runs, item, place in it); longer runs are looked up by those of MIN_RUN words."""
        found: dict[int, list] = {}
        for i, own in enumerate(self.all_words):
            size = min(len(own), MIN_RUN)
            hashes = run_hashes(own, size)
            found.setdefault(size, []).append((hashes, np.full(len(hashes), i), np.arange(len(hashes))))
        out = {}
        for size, parts in found.items():
            hashes, item, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            out[size] = Table(hashes[order]), item[order], place[order]
        return out

    def copies(self, part: Slice, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """(first word, number of words, item) of every run in the slice's documents that is long enough for its item."""
        out = []
        for size, (known, item, place) in self.runs.items():
            first, windows = part.window_hashes(hashes, size)
            some, low = known.find(windows)
            n = np.searchsorted(known.hashes, windows[some], side="right") - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            word, item, place = np.repeat(first[some], n), item[at], place[at]
            order = np.lexsort((word, word - place, item))
            word, item, shift = word[order], item[order], (word - place)[order]
            fresh = np.ones(len(word), dtype=bool)
            fresh[1:] = (word[1:] != word[:-1] + 1) | (shift[1:] != shift[:-1]) | (item[1:] != item[:-1])
            heads = np.flatnonzero(fresh)
            length = np.diff(np.append(heads, len(word))) + size - 1
            enough = length >= self.needed[item[heads]]
            out += zip(word[heads][enough].tolist(), length[enough].tolist(), item[heads][enough].tolist(), strict=True)
        return sorted(out)

    @staticmethod
    def _answer(text: str, own: np.ndarray) -> np.ndarray:
        """The last sentence's words; all words if there is but one sentence."""
        sentences = [x for x in text.replace("!", ".").replace("?", ".").replace("\n", ".").split(".") if x.strip()]
        if len(sentences) < 2:
            return own
        last = next(slices(pa.array([sentences[-1]], pa.string()), table=NORMAL)).word_hashes()
        return last if len(last) else own

    def rows(self, idf: np.ndarray) -> Rows:
        """Unit TF-IDF rows of the passages."""
        size = len(self.vocabulary.hashes)
        own = [self.words[i][o : o + 2 * CELL if o + 2 * CELL < len(self.words[i]) else None] for i, o in zip(self.item, self.offset, strict=True)]
        row = np.repeat(np.arange(len(own)), [len(x) for x in own])
        term = np.searchsorted(self.vocabulary.hashes, np.concatenate(own))
        both, n = np.unique(row * size + term, return_counts=True)
        row, term = both // size, both % size
        weight = n * idf[term]
        length = np.sqrt(np.bincount(row, weights=weight**2))
        return Rows(row, term, weight / length[row], size)


@dataclass
class Rows:
    """A sparse matrix by rows; each row has an entry."""

    row: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    terms: int

    def times(self, m: np.ndarray) -> np.ndarray:
        heads = np.flatnonzero(np.diff(self.row, prepend=-1))
        return np.add.reduceat(m[self.term] * self.weight[:, None], heads, axis=0)

    def gram_times(self, m: np.ndarray) -> np.ndarray:
        """A^T A m."""
        order = np.argsort(self.term, kind="stable")
        heads = np.flatnonzero(np.diff(self.term[order], prepend=-1))
        out = np.zeros_like(m)
        out[self.term[order][heads]] = np.add.reduceat(self.times(m)[self.row[order]] * self.weight[order, None], heads, axis=0)
        return out


def cells_of(part: Slice, size: int = CELL) -> tuple[np.ndarray, np.ndarray]:
    """(document, first word) of every run of size words; the last of a document may be shorter."""
    n = -(-part.counts() // size)
    document = np.repeat(np.arange(part.documents), n)
    order = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return document, part.first_word[document] + size * order


def passages_of(document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first cell, second cell) of every passage: neighbours in a document, a lone cell twice."""
    n = len(document)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    follows = np.flatnonzero(document[1:] == document[:-1])
    lone = np.bincount(document)[document] == 1
    first = np.concatenate([follows, np.flatnonzero(lone)])
    second = np.concatenate([follows + 1, np.flatnonzero(lone)])
    order = np.argsort(first, kind="stable")
    return first[order], second[order]


def _cell_terms(items: Items, part: Slice, hashes: np.ndarray | None = None, size: int = CELL) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, cell) of the vocabulary's words in a slice; documents and first words of its cells."""
    document, first = cells_of(part, size)
    at, terms = items.vocabulary.find(part.word_hashes() if hashes is None else hashes)
    return terms, np.searchsorted(first, at, side="right") - 1, document, first


def _passage_counts(shared):
    """One row for each term that a task has seen: in how many passages; term -1 counts the passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        total = np.zeros(len(items.vocabulary.hashes) + 1, dtype=np.int64)
        for batch in batches:
            for part in slices(batch["text"], table=NORMAL):
                term, cell, document, _ = _cell_terms(items, part)
                first, second = passages_of(document)
                # a cell stands in the passage that it begins and in the one that it ends
                begins, ends = np.full(len(document), -1), np.full(len(document), -1)
                begins[first] = np.arange(len(first))
                ends[second] = np.arange(len(second))
                pairs = np.concatenate([begins[cell] * len(total) + term, ends[cell] * len(total) + term])
                pairs = np.sort(pairs[np.concatenate([begins[cell], ends[cell]]) >= 0])
                total += np.bincount(pairs[np.diff(pairs, prepend=-1) > 0] % len(total), minlength=len(total))
                total[-1] += len(first)
        some = np.flatnonzero(total)
        terms = np.where(some == len(total) - 1, -1, some)
        yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int64)), pa.array(total[some])], names=["term", "n"])

    return run


def _counted_cells(term: np.ndarray, cell: np.ndarray, n: int, terms: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(cells, the terms that stand in them, how often each stands in each) of CELL_BLOCK cells at a time; cell is sorted.
    Few of the terms stand in so few cells, so whole matrices of them multiply faster than their entries one by one."""
    ends = np.searchsorted(cell, np.arange(0, n + CELL_BLOCK, CELL_BLOCK))
    place = np.zeros(terms, dtype=np.int64)
    for at, low, high in zip(range(0, n, CELL_BLOCK), ends[:-1], ends[1:], strict=True):
        if low == high:
            continue
        rows, own = min(CELL_BLOCK, n - at), term[low:high]
        seen = np.zeros(terms, dtype=bool)
        seen[own] = True
        met = np.flatnonzero(seen)
        place[met] = np.arange(len(met))
        counts = np.bincount((cell[low:high] - at) * len(met) + place[own], minlength=rows * len(met))
        yield slice(at, at + rows), met, counts.astype(np.float32).reshape(rows, len(met))


def _latent_cells(term: np.ndarray, cell: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    """Sums of the basis rows of each cell's terms."""
    out = np.zeros((n, basis.shape[1]), dtype=basis.dtype)
    for cells, met, counts in _counted_cells(term, cell, n, len(basis)):
        out[cells] = counts @ basis[met]
    return out


def _lengths(term: np.ndarray, cell: np.ndarray, n: int, idf: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Squared TF-IDF lengths of passages: those of their cells and twice the products of neighbours."""
    both, counts = np.unique(cell * len(idf) + term, return_counts=True)
    weight = counts * idf[both % len(idf)]
    square = np.bincount(both // len(idf), weights=weight**2, minlength=n)
    at = np.minimum(np.searchsorted(both, both + len(idf)), max(len(both) - 1, 0))
    same = both[at] == both + len(idf)  # the word stands in the next cell too
    product = np.bincount(both[same] // len(idf), weights=weight[same] * weight[at[same]], minlength=n)
    return np.where(first == second, square[first], square[first] + square[second] + 2 * product[first])


def _gram_product(shared, matrix):
    """Each task's share of A^T A M over its passages: rows of bytes, of SHARE_WORDS words each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, idf = shared.value
        m = matrix.value * idf[:, None].astype(np.float32)
        out = np.zeros_like(m)
        for batch in batches:
            for part in slices(batch["text"], table=NORMAL, limit=SVD_SLICE):
                term, cell, document, _ = _cell_terms(items, part)
                if not len(term):
                    continue
                first, second = passages_of(document)
                length = _lengths(term, cell, len(document), idf, first, second)
                # a word of a cell has the same share in all passages of the cell, so cells are projected and summed up
                latent = _latent_cells(term, cell, len(document), m)
                two = first != second
                projected = latent[first]
                projected[two] += latent[second[two]]
                projected /= np.maximum(length, 1e-12).astype(np.float32)[:, None]
                back = np.zeros_like(latent)
                back[first] += projected
                back[second[two]] += projected[two]
                for cells, met, counts in _counted_cells(term, cell, len(document), len(m)):
                    out[met] += counts.T @ back[cells]
        out *= idf[:, None].astype(np.float32)
        for at in range(0, len(out), SHARE_WORDS):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([out[at : at + SHARE_WORDS].tobytes()], pa.binary())], names=["at", "share"])

    return run


def _sum_of_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, share in zip(batch["at"].to_pylist(), batch["share"], strict=True):
            own = np.frombuffer(share.as_buffer(), np.float32)
            total[at] = total[at] + own if at in total else own.astype(float)
    for at, share in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([share.tobytes()], pa.binary())], names=["at", "share"])


def latent_basis(docs: DataFrame, items: Items, idf: np.ndarray, rank: int = RANK, weight: float = 1.0) -> np.ndarray:
    """(words, rank) orthonormal basis: leading right singular vectors of the TF-IDF passages of the items and of all docs.

    One pass over docs gives Y = A^T A M for a random M; the space of Y is the basis' space, and A^T A within it follows
    from Y and M (Nystroem)."""
    context, shape = docs.sparkSession.sparkContext, len(items.vocabulary.hashes)
    width = min(rank + OVERSAMPLE, shape)
    start = np.random.Generator(np.random.PCG64(7)).standard_normal((shape, width)).astype(np.float32)
    shared, sent = context.broadcast((items, idf)), context.broadcast(start)
    tasks = docs.select("text").coalesce(4 * context.defaultParallelism)
    shares = tasks.mapInArrow(_gram_product(shared, sent), "at long, share binary")
    found = ITEM_WEIGHT**2 * items.rows(idf).gram_times(start.astype(float))  # so that the space holds every item whole
    # one block's size, in sums over all tasks, comes to the driver
    for row in shares.repartition("at").mapInArrow(_sum_of_shares, "at long, share binary").toLocalIterator():
        own = np.frombuffer(row.share, float).reshape(-1, width)
        found[row.at : row.at + len(own)] += weight * own
    sent.unpersist()
    q, r = np.linalg.qr(found)
    inner = start.T.astype(float) @ found
    small = r @ np.linalg.pinv((inner + inner.T) / 2, rcond=1e-6, hermitian=True) @ r.T
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return q @ vectors[:, np.argsort(-values)[:rank]]


def word_masks(item: np.ndarray) -> tuple[int, dict[int, int]]:
    """(number of words, a bit for each of its places by word)."""
    masks: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | 1 << i
    return len(item), masks


def common_words(item: tuple[int, dict[int, int]], region: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel dynamic programming (Hyyro, 2004)."""
    n, masks = item
    full = left = (1 << n) - 1
    for word in region.tolist():
        mask = masks.get(word)
        if mask:
            met = left & mask
            left = (left + met | left - met) & full
    return n - left.bit_count()


def densest(item: tuple[int, dict[int, int]], answer: tuple[int, dict[int, int]], region: np.ndarray) -> tuple[int, int]:
    """(first, end) of the part of region, one and a half times as long as the item at most, with most of the item's words
    in order; of equal ones that with most of the answer's, then the first."""
    width = item[0] + item[0] // 2
    starts = [k for k, word in enumerate(region.tolist()) if word in item[1]]
    best = max(starts, key=lambda k: (common_words(item, region[k : k + width]), common_words(answer, region[k : k + width]), -k), default=0)
    return best, min(best + width, len(region))


def _copies(items: Items, part: Slice, hashes: np.ndarray, rows: dict[tuple, tuple], ids: list, keys: list) -> None:
    """Adds the documents that hold a run of an item word for word; no cosine stands for them."""
    reach: dict[tuple, int] = {}
    for at, size, i in items.copies(part, hashes):
        d = int(part.documents_of(at))
        key, own = (part.first_row + d, i), items.all_words[i]
        if at + size <= reach.get(key, 0) or key in rows and rows[key][6] == 1.0:
            continue  # the region before has the run
        low, high = max(part.first_word[d], at - len(own)), min(part.first_word[d + 1], at + size + len(own))
        reach[key] = high
        region = hashes[low:high]
        common = common_words(items.masks[i], region) / len(own)
        if key not in rows or common > rows[key][6]:
            answer = common_words(items.answer_masks[i], region) / len(items.all_answers[i])
            base = part.first_word[d]
            rows[key] = (ids[key[0]], keys[key[0]], items.all_ids[i], int(low - base), int(high - base), None, common, answer)


def _candidates(items: Items, part: Slice, size: int, own: np.ndarray, latent_items: np.ndarray, document: np.ndarray, place: np.ndarray, latent: np.ndarray, best: dict[tuple, float]) -> None:
    """Adds (document, item, first word, end of the region): cosine for the slice's passages of two cells of this size."""
    first, second = passages_of(document)
    found = []
    for begin in range(0, len(first), PASSAGE_BLOCK):  # so many that they stay in a core's cache
        one, other = first[begin : begin + PASSAGE_BLOCK], second[begin : begin + PASSAGE_BLOCK]
        both, two = latent[one], one != other
        both[two] += latent[other[two]]
        length = np.sqrt(np.einsum("ij,ij->i", both, both))
        cosine = both @ latent_items.T
        cosine /= np.where(length > 1e-6, length, np.inf)[:, None]
        near = np.flatnonzero(cosine >= MIN_COSINE)
        found += zip((begin + near // len(own)).tolist(), (near % len(own)).tolist(), cosine.ravel()[near].tolist(), strict=True)
    for p, k, value in found:
        i, at = int(items.item[own[k]]), int(place[first[p]])
        n = len(items.words[i])
        if n <= 2 * size:
            low, high = at - n, int(place[second[p]]) + size + n
        else:  # where the item would begin, within a passage and an eighth of its length
            at -= int(items.offset[own[k]])
            low, high = (at - 2 * size - n // 8) // size * size, -(-(at + n + 2 * size + n // 8) // size) * size
        d = int(document[first[p]])
        name = (d, i, max(int(part.first_word[d]), low), min(int(part.first_word[d + 1]), high))
        best[name] = max(best.get(name, 0.0), value)


def _retrieve(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, basis, latent_items = shared.value
        names = [x.split()[0] for x in FOUND.split(", ")]
        types = [pa.int64(), pa.binary()] + [pa.int64()] * 3 + [pa.float64()] * 3
        for batch in batches:
            rows: dict[tuple, tuple] = {}
            ids, keys = batch["doc_id"].to_pylist(), batch["key"].to_pylist()
            for part in slices(batch["text"], table=NORMAL, limit=1 << 18):
                hashes = part.word_hashes()
                _copies(items, part, hashes, rows, ids, keys)
                if not items.ids:
                    continue
                finest = int(items.cell.min())
                term, cell, document, place = _cell_terms(items, part, hashes, finest)
                latent = _latent_cells(term, cell, len(document), basis)
                best: dict[tuple, float] = {}  # of the candidates for one region the highest cosine
                for size in CELLS:
                    own = np.flatnonzero(items.cell == size)
                    if not len(own):
                        continue
                    if size > finest:  # cells of this size are runs of the finest ones
                        heads = np.flatnonzero((place - part.first_word[document]) % size == 0)
                        joined, ends = latent[heads], np.append(heads[1:], len(place))
                        for k in range(1, size // finest):
                            more = heads + k < ends
                            joined[more] += latent[heads[more] + k]
                        at_size = (document[heads], place[heads], joined)
                    else:
                        at_size = (document, place, latent)
                    _candidates(items, part, size, own, latent_items[own], *at_size, best)
                for (d, i, low, high), near in best.items():
                    own, region = items.words[i], hashes[low:high]
                    masks = items.masks[i][1]
                    if sum(masks[w].bit_count() for w in masks.keys() & set(region.tolist())) < MIN_COMMON * len(own):
                        continue  # no common subsequence is longer than the words in common
                    common = common_words(items.masks[i], region) / len(own)
                    if common >= MIN_COMMON and len(own) < DENSE_BELOW:
                        first, end = densest(items.masks[i], items.answer_masks[i], region)
                        low, high, region = low + first, low + end, region[first:end]
                        common = common_words(items.masks[i], region) / len(own)
                    if common < (DENSE_COMMON if len(own) < DENSE_BELOW else MIN_COMMON):
                        continue
                    key = (part.first_row + d, i)
                    if key in rows and (common < rows[key][6] or common == rows[key][6] and rows[key][5] is not None):
                        continue
                    answer = common_words(items.answer_masks[i], region) / len(items.answers[i])
                    if common >= SURE_COMMON or answer >= MIN_ANSWER:
                        base = part.first_word[d]
                        rows[key] = (ids[key[0]], keys[key[0]], items.ids[i], int(low - base), int(high - base), near, common, answer)
            columns = list(zip(*rows.values(), strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=names)

    return run


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """Blocks of bounded size, in the order of the ids; a long item is a block of its own."""
    rows: list[tuple[int, str]] = []
    words = 0
    for row in benchmark.filter("item_id is not null and text is not null").select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        if rows and (len(rows) == BLOCK_ITEMS or words > BLOCK_WORDS):
            yield Items(rows)
            rows, words = [], 0
        rows.append((row.item_id, row.text))
        words += len(row.text.split())
    if rows:
        yield Items(rows)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, end_word, cosine, common, answer: the documents of docs(doc_id, text) that hold an
    item of benchmark(item_id, text), a copied run of it or a close paraphrase, one row for each document and item.

    common and answer are the shares of the item's words and of its last sentence's words that stand in the same order
    in the region from start_word to end_word; cosine is null if that region was found by a copied run alone. Null and empty texts
    hold nothing; items of under DENSE_BELOW words count as paraphrased only where their words stand close together; items without id or without words are not searched, those of under five words are found as a whole. Rows without doc_id and repeated rows are found like others. Other columns are
    not read.
    """
    return contaminated_keys(docs, benchmark).drop("key")


def contaminated_keys(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", row_key("doc_id", "text"))
    parts = [_found(docs, items) for items in _blocks(benchmark) if items.all_ids]
    out = spark.createDataFrame([], FOUND)
    for part in parts:
        out = out.union(part)
    return out


def _idf(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    counts = docs.select("text").mapInArrow(_passage_counts(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = {r.term: r.n for r in counts}  # one for each word of the block
    total = n.get(-1, 0)
    seen = np.array([n.get(t, 0) for t in range(len(items.vocabulary.hashes))], dtype=float)
    return np.log((1.0 + total) / (1.0 + seen)) + 1e-3, total


def _found(docs: DataFrame, items: Items) -> DataFrame:
    if not items.ids:
        shared = docs.sparkSession.sparkContext.broadcast((items, None, None))
        return docs.mapInArrow(_retrieve(shared), FOUND)
    idf, total = _idf(docs, items)
    basis = latent_basis(docs, items, idf, weight=min(1.0, FIT_PASSAGES / max(total, 1)))
    latent = items.rows(idf).times(basis)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    shared = docs.sparkSession.sparkContext.broadcast((items, (basis * idf[:, None]).astype(np.float32), latent.astype(np.float32)))
    return docs.mapInArrow(_retrieve(shared), FOUND)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without those that contaminated() finds, with their own columns."""
    found = written(contaminated_keys(docs, benchmark).select("key").distinct(), "contaminated")
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.select(own, "doc_id", F.coalesce("text", F.lit("")).alias("text")).select("row", row_key("doc_id", "text").alias("key"))
    return keyed.join(found, "key", "left_anti").select("row.*")
