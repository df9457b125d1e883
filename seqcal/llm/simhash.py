"""SimHash near-dedup with BK-trees.

Plan: documents of one fingerprint become one at once. Two fingerprints that differ in at most RADIUS of 64 bits agree on
BLOCKS - RADIUS of BLOCKS blocks of bits, so each combination of so many blocks, with the bits found there, is a shard
that holds every link between its members; a link is in one shard at least. The members of a shard make BK-trees of at
most TREE_NODES fingerprints: a node's children are keyed by their integer Hamming distance to it, and by the triangle
inequality a search within RADIUS of a value at distance d follows only the edges d - RADIUS to d + RADIUS. A larger shard
has several trees, each of which is sent to every block of searches of its shard, so no task holds a shard whole and no
tree passes the driver. A task joins what its searches find and sends a spanning forest, not the pairs: at most one link
for each member of a block, and no connection is lost. Components of the links name the groups.

Trees are grown and searched for all shards of a batch at once, a level at a time, as arrays; a tree of distinct 64-bit
values has at most 65 levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .graph import connected_components
from .storage import prepare, written
from .words import SPACE, Slice, slices

WORDS, SEED = 4, 42
RADIUS, BLOCKS = 4, 6
TREE_NODES = 1024  # fingerprints of one tree; a shard of more has several
FRONTIER = 1 << 22  # (search, node) pairs that one step may hold
COUNTED = 1 << 16  # hashes whose bits are counted at once
MEMBER = "shard int, bits long, i int, j int, value long, tree boolean, search boolean"


def shingle_hashes(part: Slice, size: int = WORDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shingles of each document, XXH64 of all shingles in order); the words of a shingle are joined by single spaces."""
    lengths = part.ends - part.starts + 1
    ends = np.cumsum(lengths) - 1
    joined = np.full(int(lengths.sum()), 0x20, dtype=np.uint8)
    letters = np.ones(len(joined), dtype=bool)
    letters[ends] = False
    joined[letters] = part.data[~SPACE[part.data]]
    text = joined.tobytes()
    words = part.counts()
    count = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    owner = np.repeat(np.arange(part.documents), count)
    first = part.first_word[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    last = first + np.minimum(words, size)[owner] - 1
    digest = xxhash.xxh64_digest
    found = b"".join([digest(text[a:b], seed) for a, b in zip((ends - lengths + 1)[first].tolist(), ends[last].tolist(), strict=True)])
    return count, np.frombuffer(found, dtype=">u8").astype(np.uint64)


def fingerprint_bits(count: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One fingerprint for each document: the bits set in over half of its hashes; zero without hashes."""
    owner = np.repeat(np.arange(len(count)), count)
    ones = np.zeros((len(count), 64), dtype=np.int64)
    for at in range(0, len(hashes), COUNTED):
        bits = np.unpackbits(hashes[at : at + COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[at : at + COUNTED]
        head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.empty(0, dtype=np.uint64), *(fingerprint_bits(*shingle_hashes(part)) for part in slices(batch["text"], lower=True))]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.concatenate(found).astype(np.uint64).view(np.int64))], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (64 bits as a long) of every row of docs(doc_id, text); see near_copies."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fingerprint long")


class Forest:
    """BK-trees over arrays of values; the values of one tree stand together and are distinct."""

    def __init__(self, values: np.ndarray, trees: np.ndarray):
        self.values = values
        head = np.concatenate([[True], trees[1:] != trees[:-1]])
        self.roots = np.flatnonzero(head)
        self.sizes = np.diff(np.append(self.roots, len(values)))
        key = np.full(len(values), -1, dtype=np.int64)  # parent * 65 + distance to it
        rest, group = np.arange(len(values)), np.cumsum(head)
        while len(rest):
            head = np.concatenate([[True], group[1:] != group[:-1]])
            node = rest[head][np.cumsum(head) - 1]  # the first of each group; the others go below it
            rest, node = rest[~head], node[~head]
            group = node * 65 + np.bitwise_count(values[rest] ^ values[node])
            key[rest] = group
            order = np.argsort(group, kind="stable")
            rest, group = rest[order], group[order]
        self.children = np.argsort(key, kind="stable")[len(self.roots) :]
        self.keys = key[self.children]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes within radius of queries[i] in the tree with root roots[i]."""
        query, node = np.arange(len(queries)), roots
        found = []
        while len(query):
            distance = np.bitwise_count(self.values[node] ^ queries[query]).astype(np.int64)
            near = distance <= radius
            found.append((query[near], node[near]))
            low = np.searchsorted(self.keys, node * 65 + np.maximum(distance - radius, 0))
            n = np.searchsorted(self.keys, node * 65 + np.minimum(distance + radius, 64), side="right") - low
            query = np.repeat(query, n)
            node = self.children[np.arange(len(query)) + np.repeat(low - np.cumsum(n) + n, n)]
        return tuple(np.concatenate([f[i] for f in found]) if found else np.empty(0, dtype=np.int64) for i in (0, 1))


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """labels (the least member of each group), with the groups of a[i] and b[i] joined."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels = labels[labels]
    return labels


def block_links(keys: np.ndarray, values: np.ndarray, tree: np.ndarray, search: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (a, b) of the links between each block's searches and its tree; rows of a block (equal keys) stand
    together, the nodes of its tree first."""
    block = np.cumsum(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) - 1
    nodes, queries = np.flatnonzero(tree), np.flatnonzero(search)
    if not len(nodes):
        return values[:0], values[:0]
    forest = Forest(values[nodes], block[nodes])
    root = np.full(block[-1] + 1, -1)
    size = np.zeros(block[-1] + 1, dtype=np.int64)
    at = block[nodes[forest.roots]]
    root[at], size[at] = forest.roots, forest.sizes
    queries = queries[root[block[queries]] >= 0]
    labels = np.arange(len(values))
    load = np.cumsum(size[block[queries]])
    for step in range(int(load[-1]) // FRONTIER + 1 if len(load) else 0):
        own = queries[(load >= step * FRONTIER) & (load < (step + 1) * FRONTIER)]
        q, node = forest.search(values[own], root[block[own]], radius)
        labels = merged(labels, own[q], nodes[node])
    far = np.flatnonzero(values != values[labels])
    return values[far], values[labels[far]]


def _links(radius: int):
    """Rows come sorted by block; whole blocks are worked on together, as many as a batch holds."""
    key = ["shard", "bits", "i", "j"]

    def found(rows: pa.Table) -> pa.RecordBatch:
        keys = np.stack([rows[c].to_numpy() for c in key], axis=1)
        links = block_links(keys, rows["value"].to_numpy().view(np.uint64), rows["tree"].to_numpy(), rows["search"].to_numpy(), radius)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in links], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy() for c in key], axis=1)
            fresh = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            last = int(fresh[-1]) if len(fresh) else 0  # the last block of the batch may go on in the next one
            if held and (last or [held[-1][c][-1].as_py() for c in key] != keys[0].tolist()):
                if last:
                    held.append(batch.slice(0, last))
                yield found(pa.Table.from_batches(held))
                held = []
            elif last:
                yield found(pa.Table.from_batches([batch.slice(0, last)]))
            held.append(batch.slice(last))
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def shards(values: DataFrame, radius: int, blocks: int) -> DataFrame:
    """shard, bits, value: each value in the shards of all combinations of blocks - radius blocks of its bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = [signed(sum((1 << cuts[i + 1]) - (1 << cuts[i]) for i in chosen)) for chosen in combinations(range(blocks), blocks - radius)]
    each = F.posexplode(F.array(*(F.col("value").bitwiseAND(F.lit(m).cast("long")) for m in masks))).alias("shard", "bits")
    return values.select("value", each).select("shard", "bits", "value")


def links_within(values: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, nodes: int = TREE_NODES) -> DataFrame:
    """a, b: links that connect all of values(value), distinct longs, that differ in at most radius bits; a spanning forest
    of each block, so far fewer than the pairs."""
    members = shards(values, radius, blocks)
    sizes = members.groupBy("shard", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    dealt = members.join(sizes, ["shard", "bits"]).withColumn("parts", F.expr(f"cast((n + {nodes - 1}) div {nodes} as int)"))
    dealt = dealt.withColumn("part", F.expr("cast(pmod(xxhash64(value), parts) as int)"))
    # part i as a tree meets the searches of the parts j >= i
    other = dealt.select("shard", "bits", "value", "part", F.explode(F.expr("sequence(0, parts - 1)")).alias("other"))
    blocked = other.select("shard", "bits", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "value", (F.col("part") <= F.col("other")).alias("tree"), (F.col("part") >= F.col("other")).alias("search"))
    key = ["shard", "bits", "i", "j"]
    return blocked.repartition(*key).sortWithinPartitions(*key, F.desc("tree")).mapInArrow(_links(radius), "a long, b long")


def near_copies(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, nodes: int = TREE_NODES) -> DataFrame:
    """doc_id, fingerprint (long), component_id for every row of docs(doc_id, text).

    The fingerprint is the SimHash of the text's runs of four words, A-Z in lower case, repeats included; a shorter text is
    one run, and a text without words (null, empty) has fingerprint zero, which is linked like any other. component_id is
    the smallest doc_id that links of at most radius differing bits reach. A row without doc_id has a fingerprint, takes
    no part in the groups and has a null component_id. Rows that repeat a doc_id are documents of their own with the same
    name. Other columns of docs are not read.
    """
    if blocks <= radius:
        raise ValueError("there must be more blocks than differing bits")
    signed = written(fingerprints(docs), "fingerprints", merge=False)
    values = written(signed.filter("doc_id is not null").groupBy(F.col("fingerprint").alias("value")).agg(F.min("doc_id").alias("first")), "values")
    groups = connected_components(links_within(values.select("value"), radius, blocks, nodes), "a", "b")
    named = values.join(groups, F.col("value") == F.col("node"), "left").select("value", "first", F.coalesce("component", "value").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select(F.col("value").alias("fingerprint"), "component_id")
    found = signed.join(named, "fingerprint", "left")
    return found.select("doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def kept_of_copies(docs: DataFrame) -> DataFrame:
    """The doc_ids to keep: one of each group, the smallest."""
    return near_copies(docs).filter("doc_id = component_id").select("doc_id").distinct()


def hexadecimal(fingerprint: str) -> Column:
    """A long as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
