"""Token ids: byte-level BPE by the tokenizers library, and their binary Parquet form.

Encoding cuts a text where the tokenizer's own pre-tokenizer always cuts, before the last space ahead of a word, and
asks the library once for each distinct chunk that a worker meets, as most words return. Chunks in which no merge can
join two of the pre-tokenizer's pieces go there end to end and without the pre-tokenizer's search. Texts with
white space other than space, tab and line ends, or with the string of an added token, go to the library whole.

The table of ids is range-partitioned and sorted by doc_id, with dictionary pages for the ids, delta pages for the
document columns, small row groups and page indexes (written by default), so a reader can pick columns, documents or
metadata alone.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .storage import prepare, table_path
from .words import BLOCK_MASKS, U64, mix

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
DOUBTFUL, BLANK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)  # bytes that may belong to other white space
DOUBTFUL[[0x0B, 0x0C, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
BLANK[list(b" \n\r\t")] = True
CACHED_CHUNKS, JOINED = 300_000, 128
#: Classes of bytes as the pre-tokenizer tells them apart: letters (other than ASCII ones as far as they are Latin), digits, marks.
KIND = np.full(256, 2, dtype=np.uint8)
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
KIND[list(b"0123456789")] = 1
KIND[0x20] = 3
OPTIONS = {
    "compression": "zstd", "parquet.writer.version": "v2", "parquet.block.size": str(16 << 20), "parquet.page.size": str(256 << 10), "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false", "parquet.enable.dictionary#n_tokens": "false",
}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Known:
    """Ids of chunks of up to 16 bytes. A chunk is its length and two blocks of eight bytes, in the order of their hash."""

    def __init__(self):
        self.chunks, self.places, self.used = np.empty((0, 4), dtype=np.uint64), np.empty((0, 2), dtype=np.int64), np.empty(0, dtype=bool)
        self.ids = np.empty(0, dtype=np.uint32)

    @staticmethod
    def of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Hash, two blocks and length of every chunk data[bounds[i]:bounds[i + 1]]."""
        starts, n = bounds[:-1], np.diff(bounds)
        blocks = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(16, dtype=np.uint8)]), 8)
        out = np.empty((len(n), 4), dtype=np.uint64)
        for i in (0, 1):
            out[:, 1 + i] = blocks[starts + 8 * i].view("<u8").ravel() & BLOCK_MASKS[np.clip(n - 8 * i, 0, 8)]
        out[:, 3] = n
        out[:, 0] = mix(mix(out[:, 3] + out[:, 1] * U64(0xD1342543DE82EF95)) + out[:, 2])
        return out

    def find(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which are known, (start, number) of their ids)."""
        if not len(self.chunks):
            return np.zeros(len(chunks), dtype=bool), np.zeros((len(chunks), 2), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.chunks[:, 0], chunks[:, 0]), len(self.chunks) - 1)
        found = (self.chunks[at] == chunks).all(axis=1)
        self.used[at[found]] = True
        return found, self.places[at]

    def add(self, chunks: np.ndarray, places: np.ndarray) -> None:
        if len(self.chunks) > CACHED_CHUNKS or len(self.ids) > 8 * CACHED_CHUNKS:  # those not met since the last time go
            self._keep(self.used if self.used.sum() < CACHED_CHUNKS * 2 // 3 else np.zeros(len(self.used), dtype=bool))
            return
        # of chunks that share a hash the first is found, others are encoded anew each time
        chunks, places, used = np.concatenate([self.chunks, chunks]), np.concatenate([self.places, places]), np.concatenate([self.used, np.ones(len(chunks), dtype=bool)])
        order = np.argsort(chunks[:, 0], kind="stable")
        self.chunks, self.places, self.used = chunks[order], places[order], used[order]

    def _keep(self, some: np.ndarray) -> None:
        starts, n = self.places[some].T
        ends = np.cumsum(n)
        self.ids = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - n), n)]
        self.chunks, self.places, self.used = self.chunks[some], np.stack([ends - n, n], axis=1), np.zeros(int(some.sum()), dtype=bool)


class Encoder:
    """Ids of whole texts, as Tokenizer.encode(text, add_special_tokens=False) gives them."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        plan = json.loads(self.tokenizer.to_str())
        before = plan.get("pre_tokenizer") or {}
        #: whether chunks may be encoded on their own
        self.chunked = not plan.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and plan["model"]["type"] == "BPE"
        self.known = Known()
        if self.chunked:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.joins = self._joins(vocabulary)
            self.id_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # a letter of a token's string is a byte
            self.id_bytes[list(vocabulary.values())] = [len(x) for x in vocabulary]
            self.cuts, self.plain = self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _joins(self, vocabulary: dict[str, int]) -> np.ndarray:
        """For each pair of bytes of two classes whether a token holds them side by side."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values: bytes that stand for themselves
        value = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
        out = np.zeros((256, 256), dtype=bool)
        for token in vocabulary:
            own = [value[c] for c in token if c in value]
            for x, y in zip(own, own[1:]):
                out[x, y] |= bool(KIND[x] != KIND[y] and x != 0x20)
        # a token goes on from A0 to a space, so words with that end are not joined
        self.spaced = set(np.flatnonzero(out[:, 0x20])) <= {0xA0}
        return out.ravel()

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), dtype=np.uint32, count=int(n.sum())), n

    def _learn(self, chunks: pa.Array, simple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each has) of new chunks; simple ones are encoded end to end."""
        words, others = (chunks.filter(pa.array(x)) for x in (simple, ~simple))
        names = words.to_numpy(zero_copy_only=False).tolist()
        self.tokenizer.pre_tokenizer = self.plain
        ids, _ = self._ids(["".join(names[at : at + JOINED]) for at in range(0, len(names), JOINED)])
        self.tokenizer.pre_tokenizer = self.cuts
        letters = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False))
        counts = np.empty(len(chunks), dtype=np.int64)
        counts[simple] = np.diff(np.searchsorted(np.cumsum(self.id_bytes[ids]), letters) + 1, prepend=0)
        more, counts[~simple] = self._ids(others.to_pylist())
        first = np.empty(len(chunks), dtype=np.int64)
        first[simple] = np.cumsum(counts[simple]) - counts[simple]
        first[~simple] = len(ids) + np.cumsum(counts[~simple]) - counts[~simple]
        return np.concatenate([ids, more]), np.stack([first, counts], axis=1)

    def _look_up(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, (start, number) of those of every name) of distinct chunks."""
        data, bounds = _buffers(names)
        chunks = Known.of(data, bounds)
        found, places = self.known.find(chunks)
        new = np.flatnonzero(~found)
        fresh, of_new = self._learn(names.take(pa.array(new)), self._simple(data, bounds)[new])
        of_new[:, 0] += len(self.known.ids)
        places[new] = of_new
        ids = self.known.ids = np.concatenate([self.known.ids, fresh])
        short = chunks[new, 3] <= 16
        self.known.add(chunks[new[short]], of_new[short])
        return ids, places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, bounds): text i (null: empty) has the ids bounds[i]:bounds[i + 1]."""
        array = texts.cast(pa.large_string()).fill_null("")
        data, offsets = _buffers(array)
        whole = self._whole(array, data, offsets)
        if len(whole) == len(array):
            ids, n = self._ids(array.to_pylist())
            return ids, np.concatenate([[0], np.cumsum(n)])
        if whole:
            others = np.ones(len(array), dtype=bool)
            others[whole] = False
            data, offsets = _buffers(pc.if_else(pa.array(others), array, pa.scalar("", pa.large_string())))
        starts = chunk_starts(data, offsets)
        first = np.searchsorted(starts, offsets)
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)).dictionary_encode()
        ids, places = self._look_up(pieces.dictionary)
        places = places[pieces.indices.to_numpy(zero_copy_only=False)]
        n = places[:, 1]
        ends = np.cumsum(n)
        # each place's id is that of its chunk's name, so many places on
        out = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(places[:, 0] - (ends - n), n)]
        bounds = np.concatenate([[0], ends])[first]
        if whole:
            parts = np.split(out, bounds[1:-1])
            for i in whole:
                parts[i] = self._ids([array[i].as_py()])[0]
            out, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return out, bounds

    def _whole(self, array: pa.Array, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """Texts that the library gets whole."""
        if not self.chunked:
            return list(range(len(array)))
        doubtful = np.unique(np.searchsorted(offsets, np.flatnonzero(DOUBTFUL[data]), side="right") - 1)
        found = {i for i in doubtful.tolist() if OTHER_SPACE.search(array[i].as_py())}
        for token in self.added:
            found.update(np.flatnonzero(pc.match_substring(array, token).to_numpy(zero_copy_only=False)).tolist())
        return sorted(found)

    def _simple(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Chunks that are one space and then ASCII or Latin letters, digits and marks that no merge joins."""
        if not len(data) or not self.spaced:
            return np.zeros(len(bounds) - 1, dtype=bool)
        after = np.append(data[1:], np.uint8(0x20))
        odd = self.joins[data.astype(np.int32) * 256 + after]
        odd[bounds[1:] - 1] = False
        odd |= BLANK[data] & (data != 0x20)
        # other characters than C3 80 ... C3 BF, those but letters
        odd |= (data >= 0x80) & (data != 0xC3) & (np.concatenate([[0], data[:-1]]) != 0xC3) | (data == 0xC3) & ((after == 0x97) | (after == 0xB7))
        spaces = np.concatenate([[0], np.cumsum(data == 0x20)])
        alone = (np.diff(spaces[bounds]) == 1) & (data[bounds[:-1]] == 0x20) & (np.diff(bounds) > 1)
        return alone & (np.diff(np.concatenate([[0], np.cumsum(odd)])[bounds]) == 0) & (data[bounds[1:] - 1] != 0xA0)

    def encode_with_end(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with end_id behind each text."""
        ids, bounds = self.encode(texts)
        return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of this Python process: a reused worker keeps the tokenizer and the chunks that it knows."""
    return Encoder(path)


def _buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of large strings."""
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(array.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the chunks of texts begin: at a run of white space, at its last character if a word follows, and at a word
    unless a space stands before it. The tokenizer cuts at all of these places."""
    blank = BLANK[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[bounds] = True
    before = np.concatenate([[False], blank[:-1]]) & ~fresh[:-1] if len(data) else blank
    begins = fresh[:-1] | (before != blank)
    word = begins & ~blank
    starts = begins & blank
    starts[np.flatnonzero(word & before) - 1] = True
    starts |= word & ~(before & (np.concatenate([[0], data[:-1]]) == 0x20)) if len(data) else word
    return np.flatnonzero(starts)


def _encoded(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids, bounds = own.encode_with_end(batch["text"], end_id)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.diff(bounds)), lists], names=["doc_id", "n_tokens", "ids"])

    return run


SCHEMA = "doc_id long, n_tokens long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Writes doc_id, n_tokens, ids of every row of docs(doc_id, text) under path, in ascending doc_id order over its
    files by name and the rows in each. A null text is empty and has the end id alone; rows without doc_id come first;
    repeated rows stay, next to each other. Columns besides doc_id and text are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    dealt = docs.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    dealt.select("doc_id", "text").mapInArrow(_encoded(tokenizer or tokenizer_path(), end_id), SCHEMA).write.options(**OPTIONS).parquet(path)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["ids"]
        flat, bounds = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch["file"], batch["place"], batch["doc_id"], pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64())], names=["file", "place", "doc_id", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files: start counts the ids of all documents before this one."""
    prepare(spark)
    files = spark.read.schema(SCHEMA).parquet(path)
    placed = files.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"), "doc_id", "n_tokens", "ids")
    totals = placed.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    totals = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.mapInArrow(_checked, "file string, place long, doc_id long, n_tokens long, ids_crc32 long")
    rows = rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).join(totals, "file")
    return rows.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """write_tokens to the shared folder and read_tokens from there."""
    path = table_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path)
