"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark; repeated windows merge
into maximal removal intervals.

Plan: (1) each task hashes all windows of its documents and packs them by hash range, a window that repeats inside
one batch standing there once; (2) one shuffle brings equal hashes together, where sorted runs tell which windows
occur more than once; (3) the marks, one bit a window, go back to their documents. Hash values travel packed, eight
bytes a window, so the shuffle moves little more than the texts themselves. A batch sends each distinct window once,
and a task doesn't send again what it has seen twice in a batch before (up to KNOWN windows), so a passage that a third
of all documents share comes about once from each task.

Two hashes to independent bases name a window: one picks the range, the other is the value sent. With R ranges and N
windows about N * N / (R * 2**62) windows are taken for repeated by chance: 1e-4 of one at 1e8 windows and 50 ranges. Word hashes are
under a key drawn for the run, so no text can be made to meet another one.
Documents are named by 128-bit digests of their rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import prepare, row_key
from .words import SECOND_BASE, U64, Slice, covered, fresh_key, mix, slices

WINDOW = 35
KNOWN = 1 << 20
CHARS_PER_RANGE = 24_000_000

PACKED = "range int, batch binary, keys binary, places binary, counts binary, sent binary, twice binary, hashes binary"
MARKS = "batch binary, range int, keys binary, places binary, counts binary, marks binary"
FOUND = "key binary, found array<struct<range: int, marks: binary>>"
KEY_BYTES = 16


def _width(ranges: int) -> np.uint64:
    return U64((2**64 - 1) // ranges + 1) if ranges > 1 else U64(2**64 - 1)


def _unpack(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def _windows(part: Slice, size: int, ranges: int, secret: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, range, hash) of every window of a slice."""
    words = part.word_hashes(secret)
    first, hashes = part.window_hashes(words, size)
    return first, (part.window_hashes(words, size, SECOND_BASE)[1] // _width(ranges)).astype(np.int64), hashes


def _pack(size: int, ranges: int, secret: int):
    """For each batch and hash range one row: the windows of each document there, and their hashes; one more row, in any
    range and without hashes, has the keys of the batch's documents.

    Of the equal windows in a batch only the first is sent, with a mark if there are more; the others are known to
    be repeated, and so are windows that an earlier batch of the task had twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.empty(0, dtype=np.uint64)  # names of windows that are repeated for sure
        for batch in batches:
            keys = b"".join(batch["key"].to_pylist())
            owner, at, hashes = [], [], []
            for part in slices(batch["text"]):
                first, own, found = _windows(part, size, ranges, secret)
                owner.append(part.documents_of(first) + part.first_row)
                at.append(own)
                hashes.append(found)
            if not sum(map(len, hashes)):
                continue
            owner, at, hashes = np.concatenate(owner), np.concatenate(at), np.concatenate(hashes)
            index = np.lexsort((hashes, at))
            head = np.ones(len(index), dtype=bool)
            head[1:] = (hashes[index][1:] != hashes[index][:-1]) | (at[index][1:] != at[index][:-1])
            sent, twice = np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=bool)
            sent[index[head]] = True
            twice[index[head & np.append(~head[1:], False)]] = True
            names = mix(hashes ^ (at.astype(np.uint64) * U64(0x9E3779B97F4A7C15)))
            if len(known):
                sent &= known[np.minimum(np.searchsorted(known, names), len(known) - 1)] != names
            if len(known) < KNOWN:
                known = np.union1d(known, names[twice])
            index = np.argsort(at, kind="stable")  # by range, then document and place
            name = hashlib.blake2b(keys, digest_size=16).digest()
            rows: list[tuple] = [(name[0] % ranges, name, keys, None, None, None, None, None)]
            for group in np.split(index, np.flatnonzero(np.diff(at[index])) + 1):
                documents, counts = np.unique(owner[group], return_counts=True)
                bits = sent[group]
                rows.append((int(at[group[0]]), name, None, documents.astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes(), np.packbits(bits).tobytes(), np.packbits(twice[group]).tobytes(), hashes[group[bits]].tobytes()))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(x, pa.binary()) for x in columns[1:])], names=["range", "batch", "keys", "places", "counts", "sent", "twice", "hashes"])

    return run


def _mark(rows: pd.DataFrame) -> pd.DataFrame:
    """One hash range: which of its windows occur twice or more, as bits for each document."""
    out: dict[str, list] = {k.split()[0]: [] for k in MARKS.split(", ")}

    def put(*values) -> None:
        for k, v in zip(out, values, strict=True):
            out[k].append(v)

    named = rows["keys"].notna()
    for batch, keys in zip(rows["batch"][named], rows["keys"][named], strict=True):
        put(batch, -1, keys, None, None, None)
    rows = rows[~named]
    if not len(rows):
        return pd.DataFrame(out, dtype=object)
    hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["hashes"]])
    counts = [np.frombuffer(x, np.uint32) for x in rows["counts"]]
    sent = np.concatenate([_unpack(x, int(c.sum())) for x, c in zip(rows["sent"], counts, strict=True)])
    twice = np.concatenate([_unpack(x, int(c.sum())) for x, c in zip(rows["twice"], counts, strict=True)])[sent]
    order = np.argsort(hashes)
    ordered = hashes[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    run = np.cumsum(head) - 1
    often = np.bincount(run) + np.bincount(run, weights=twice[order]) > 1
    several = np.zeros(len(hashes), dtype=bool)
    several[order] = often[run]
    marked = ~sent
    marked[sent] = several
    place = 0
    for batch, places, n in zip(rows["batch"], rows["places"], counts, strict=True):
        bits, place = marked[place : place + int(n.sum())], place + int(n.sum())
        owner = np.repeat(np.arange(len(n)), n)
        some = np.bincount(owner, weights=bits, minlength=len(n)) > 0
        if some.any():
            put(batch, int(rows["range"].iloc[0]), None, np.frombuffer(places, np.uint32)[some].tobytes(), n[some].tobytes(), np.packbits(bits[some[owner]]).tobytes())
    return pd.DataFrame(out, dtype=object)


def _by_document(rows: pd.DataFrame) -> pd.DataFrame:
    """The marks of one batch, dealt out to its documents. Rows that repeat have one key and equal marks."""
    names = rows["keys"][rows["keys"].notna()].iloc[0]
    found: dict[bytes, dict[int, bytes]] = {}
    rows = rows[rows["keys"].isna()]
    for at, places, counts, marks in zip(rows["range"].tolist(), rows["places"], rows["counts"], rows["marks"], strict=True):
        counts = np.frombuffer(counts, np.uint32)
        bits = _unpack(marks, int(counts.sum()))
        ends = np.cumsum(counts.astype(np.int64))
        for d, n, end in zip(np.frombuffer(places, np.uint32).tolist(), counts.tolist(), ends.tolist(), strict=True):
            found.setdefault(names[KEY_BYTES * d : KEY_BYTES * (d + 1)], {})[at] = np.packbits(bits[end - n : end]).tobytes()
    return pd.DataFrame({"key": list(found), "found": [[{"range": a, "marks": m} for a, m in x.items()] for x in found.values()]}, dtype=object)


def _remove(size: int, ranges: int, secret: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch["found"].to_pylist()
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for part in slices(batch["text"]):
                counts = part.counts()
                for d in range(part.documents):
                    marks, kept = found[part.first_row + d], None
                    words = part.text(d).split()
                    if marks:
                        one = next(slices(pa.array([part.text(d)], pa.binary()).cast(pa.string())))
                        first, at, _ = _windows(one, size, ranges, secret)
                        hit = np.zeros(len(first), dtype=bool)
                        for mark in marks:
                            where = np.flatnonzero(at == mark["range"])
                            hit[where] = _unpack(mark["marks"], len(where))
                        kept = ~covered(first[hit], size, len(words))
                        words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
                    text = b" ".join(words)
                    n_words.append(int(counts[d]))
                    n_removed.append(int(counts[d]) - len(words))
                    digests.append(hashlib.sha256(text).hexdigest())
                    if with_text:
                        kept_texts.append(text.decode())
            columns = [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept_texts, pa.string())][: 4 + with_text], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: 4 + with_text])

    return run


def remove_repeated_windows(docs: DataFrame, size: int = WINDOW, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with with_text, kept_text for every row of docs(doc_id, text).

    Every word that a window of size words covers is removed if the window's word sequence also starts anywhere
    else, in the same document or in another; windows are judged on the input. A null or empty text has no words and
    keeps the empty text; texts under size words keep all. Rows that repeat another row count as another place, so
    both lose their windows. A null doc_id is kept as such. Columns besides doc_id and text are not read.
    """
    spark, secret = docs.sparkSession, fresh_key()
    prepare(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", row_key("doc_id", "text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // CHARS_PER_RANGE + 1)
    packed = docs.select("key", "text").mapInArrow(_pack(size, ranges, secret), PACKED)
    marks = packed.repartition(ranges, "range").groupBy("range").applyInPandas(_mark, MARKS)
    found = marks.groupBy("batch").applyInPandas(_by_document, FOUND).dropDuplicates(["key"])
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return docs.join(found, "key", "left").select("doc_id", "text", "found").mapInArrow(_remove(size, ranges, secret, with_text), schema)
