"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

Plan: documents with equal shingle sets become one class at once. Each class is hashed once over its shingles; the
bins (Li et al., 2012), empty ones filled by universally hashed probes (Shrivastava, 2017), form bands. In every
bucket of a band each class is a candidate with the bucket's smallest class only (a star), so a bucket of m classes
has m - 1 pairs. Candidates are confirmed on full shingle sets; confirmed links give components. A star alone could
miss a link between two classes that are both unlike the smallest, so buckets whose classes are still in different
components have a second turn: each class outside the bucket's first component is compared there with the classes of
other components, in blocks of bounded size that give links, not pairs. With 48 bands of 6 bins a pair at a similarity
of 0.8 shares no bucket with a probability of 5e-7. A shingle is a 64-bit hash in its set, under a key drawn for the run; sets are named by 128-bit
digests, rows by 128-bit digests of their content, classes by numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .graph import connected_components
from .storage import prepare, row_key, written
from .words import U64, Slice, fresh_key, mix, run_hashes, slices

BANDS, BAND_BINS = 48, 6
PERCENT = 80
HUB_MEMBERS = 64  # members of one hub that one group confirms
BUCKET_CLASSES, BUCKET_SHINGLES = 256, 1 << 18  # of a mixed bucket in one side of a block; a larger set stands alone or nearly so
BIT_TABLE = 1 << 26  # bits in a block's table of shared shingles
PROBES = 64

SIGNATURE = "doc_id long, key binary, n_shingles long, set_hash binary, bands array<long>"


def shingle_sets(part: Slice, size: int, key: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each document's runs of size words; of all its words if it has fewer."""
    hashes = part.word_hashes(key)
    first, found = part.window_hashes(hashes, size)
    bounds = np.searchsorted(first, part.first_word)
    out = []
    for d, n in enumerate(part.counts().tolist()):
        if n >= size:
            out.append(np.unique(found[bounds[d] : bounds[d + 1]]))
        elif n:
            out.append(run_hashes(hashes[part.first_word[d] : part.first_word[d + 1]], n))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def probe_table(bins: int) -> np.ndarray:
    """For each turn and bin the bin to borrow from; the same for every set."""
    turn, at = np.meshgrid(np.arange(PROBES, dtype=np.uint64), np.arange(bins, dtype=np.uint64), indexing="ij")
    return (mix(turn * U64(bins) + at + U64(77)) % U64(bins)).astype(np.int64)


def densified(sets: list[np.ndarray], bins: int, probes: np.ndarray) -> np.ndarray:
    """One row of bins for each non-empty set: the smallest hash in each bin, empty bins borrowing a filled one's."""
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    values = mix(np.concatenate(sets) + U64(0x632BE59BD9B4E019))
    cell = owner * bins + ((values >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    values = mix(values)
    order = np.lexsort((values, cell))
    cell, values = cell[order], values[order]
    head = np.concatenate([[True], cell[1:] != cell[:-1]])
    out, filled = np.zeros(len(sets) * bins, dtype=np.uint64), np.zeros(len(sets) * bins, dtype=bool)
    out[cell[head]], filled[cell[head]] = values[head], True
    out, filled = out.reshape(-1, bins), filled.reshape(-1, bins)
    rows, at = np.nonzero(~filled)
    result = out.copy()
    for turn in probes:
        if not len(rows):
            return result
        lender = turn[at]
        found = filled[rows, lender]
        result[rows[found], at[found]] = out[rows[found], lender[found]]
        rows, at = rows[~found], at[~found]
    if len(rows):  # very small sets: the next filled bin to the right, around the end
        index = np.where(np.tile(filled, 2), np.arange(2 * bins), 4 * bins)
        following = np.minimum.accumulate(index[:, ::-1], axis=1)[:, ::-1]
        result[rows, at] = out[rows, following[rows, at] % bins]
    return result


def _signatures(size: int, key: int, bands: int, band_bins: int):
    bins = bands * band_bins
    probes = probe_table(bins)
    weights = mix(np.arange(1, band_bins + 1, dtype=np.uint64)) | U64(1)
    salts = mix(np.arange(1000, 1000 + bands, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, keys = [], [], []
            for part in slices(batch["text"], lower=True):
                sets = shingle_sets(part, size, key)
                n += [len(s) for s in sets]
                digests += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                if some := [s for s in sets if len(s)]:
                    rows = densified(some, bins, probes).reshape(len(some), bands, band_bins)
                    keys.append(mix((rows * weights).sum(axis=2, dtype=np.uint64) + salts).view(np.int64))
            full = np.array(n, dtype=np.int64) > 0
            offsets = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            flat = np.concatenate(keys).ravel() if keys else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "key", "n_shingles", "set_hash", "bands"])

    return run


def _confirm(size: int, key: int, percent: int):
    """Rows come sorted by (a, part), the hub itself first in each group, so one hub's set is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, mine = None, np.empty(0, dtype=np.uint64)
        for batch in batches:
            hubs, nodes = batch["a"].to_pylist(), batch["node"].to_pylist()
            a, b = [], []
            for part in slices(batch["text"], lower=True):
                for row, other in enumerate(shingle_sets(part, size, key), part.first_row):
                    if nodes[row] == hubs[row]:
                        hub, mine = hubs[row], other
                        continue
                    common = len(np.intersect1d(mine, other, assume_unique=True)) if hub == hubs[row] else 0
                    if 100 * common >= percent * (len(mine) + len(other) - common):
                        a.append(hub)
                        b.append(nodes[row])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, key: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar; each a's members are dealt out in groups of bounded size."""
    load = pairs.groupBy("a").agg(F.count("*").alias("members"))
    dealt = pairs.join(load, "a").select("a", "b", F.expr(f"pmod(xxhash64(b), cast((members + {HUB_MEMBERS - 1}) / {HUB_MEMBERS} as int))").alias("part"))
    asked = dealt.select("a", "part", F.explode(F.array("b", "a")).alias("node")).distinct()
    rows = asked.join(texts, "node").select("a", "part", "node", "text").repartition("a", "part")
    return rows.sortWithinPartitions("a", "part", F.col("node") != F.col("a")).mapInArrow(_confirm(size, key, percent), "a long, b long")


class Sets:
    """Shingle sets of one group, for exact intersections of one with many."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(x) for x in sets], dtype=np.int64)
        # shingles of one set alone meet nothing
        shared, counts = np.unique(np.concatenate(sets), return_counts=True)
        shared = shared[counts > 1]
        self.bits = None
        if len(shared) * len(sets) <= BIT_TABLE:
            self.bits = np.zeros((len(sets), -(-max(len(shared), 1) // 64) * 8), dtype=np.uint8)
            for i, own in enumerate(sets):
                at = np.searchsorted(shared, own)
                known = at[shared[np.minimum(at, len(shared) - 1)] == own] if len(shared) else at[:0]
                row = np.zeros(self.bits.shape[1] * 8, dtype=np.uint8)
                row[known] = 1
                self.bits[i] = np.packbits(row)
            self.bits = self.bits.view(np.uint64)

    def similar(self, one: int, many: np.ndarray, percent: int) -> np.ndarray:
        """Those of many whose similarity with one is at least percent hundredths."""
        if self.bits is not None:
            common = np.bitwise_count(self.bits[many] & self.bits[one]).sum(axis=1, dtype=np.int64)
        else:
            common = np.array([len(np.intersect1d(self.sets[one], self.sets[i], assume_unique=True)) for i in many], dtype=np.int64)
        return many[100 * common >= percent * (self.sizes[many] + self.sizes[one] - common)]


def _compare(rows: pa.Table, size: int, key: int, percent: int) -> list[tuple[int, int]]:
    """Links between the own classes of a block and its odd ones. Each pair is taken in the first band that it shares
    only, not with the bucket's hub, which the first turn has compared with all, and two odd classes once."""
    sets: list[np.ndarray] = []
    for part in slices(rows["text"], lower=True):
        sets += shingle_sets(part, size, key)
    table = Sets(sets)
    own = rows["own"].to_numpy()
    node, component, odd = (rows[c].to_numpy() for c in ("node", "component", "odd"))
    bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(own), -1)
    hub, band = rows["a"][0].as_py(), rows["band"][0].as_py()
    mine = np.flatnonzero(own & (node != hub))
    out = []
    for x in np.flatnonzero(~own & (node != hub)).tolist():
        fits = (component[mine] != component[x]) & (~odd[mine] | (node[mine] > node[x]))
        small, large = np.minimum(table.sizes[mine], table.sizes[x]), np.maximum(table.sizes[mine], table.sizes[x])
        some = mine[fits & (100 * small >= percent * large)]
        if len(some):
            some = some[(bands[some] == bands[x]).argmax(axis=1) == band]
        if len(some):
            out += [(int(node[x]), int(node[i])) for i in table.similar(x, some, percent)]
    return out


def _blocks(size: int, secret: int, percent: int):
    """Rows come sorted by (bucket, i, j); one block is held at a time."""
    key = ["bucket", "i", "j"]

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = _compare(pa.Table.from_batches(rows), size, secret, percent)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in key], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for at, to in zip(cuts, cuts[1:], strict=False):
                if to > at:
                    if held and tuple(keys[at]) != now:
                        yield links(held)
                        held = []
                    now = tuple(keys[at])
                    held.append(batch.slice(at, to - at))
        if held:
            yield links(held)

    return run


def _across(rest: DataFrame, classes: DataFrame, texts: DataFrame, size: int, key: int, percent: int) -> DataFrame:
    """Links between classes of different components that share a bucket.

    The classes of a bucket are dealt to parts of bounded size, those outside its first component to parts of their own,
    and each part of the ones meets each part of the others in a block, where full sets are compared.
    """
    parts = lambda n, shingles: f"cast(greatest(({n} + {BUCKET_CLASSES - 1}) / {BUCKET_CLASSES}, {shingles} / {BUCKET_SHINGLES} + 1) as int)"
    odd = rest.withColumn("odd", F.expr("component <> first"))
    counts = odd.groupBy("bucket").agg(F.count_if("odd").alias("odds"), F.sum("n").alias("all_n"), F.sum(F.when(F.col("odd"), F.col("n"))).alias("odd_n"))
    odd = odd.join(counts, "bucket").withColumn("rows", F.expr(parts("size", "all_n"))).withColumn("columns", F.expr(parts("odds", "odd_n")))
    own = odd.select("bucket", "band", "a", "node", "component", "odd", F.lit(True).alias("own"), F.expr("cast(pmod(xxhash64(node), rows) as int)").alias("i"), F.explode(F.expr("sequence(0, columns - 1)")).alias("j"))
    other = odd.filter("odd").select("bucket", "band", "a", "node", "component", "odd", F.lit(False).alias("own"), F.explode(F.expr("sequence(0, rows - 1)")).alias("i"), F.expr("cast(pmod(xxhash64(node), columns) as int)").alias("j"))
    placed = written(own.union(other), "blocks")
    needed = placed.select("node").distinct().join(classes.select("node", "bands"), "node")
    needed = needed.join(texts, "node").select("node", "bands", "text")
    rows = placed.join(needed, "node").select("bucket", "i", "j", "band", "a", "node", "component", "odd", "own", "bands", "text")
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(_blocks(size, key, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT, bands: int = BANDS, band_bins: int = BAND_BINS, with_key: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs(doc_id, text).

    A document's set holds its distinct runs of size words, A-Z in lower case; a text with fewer words is one shingle,
    and one without words (null, empty) has none and is linked with nothing. Documents are linked where the
    intersection of their sets is at least percent hundredths of the union. component_id is the smallest doc_id that
    links reach, kept says that it is the document's own. A row without doc_id takes no part: its component_id is null
    and it is kept. Rows that repeat a doc_id are documents of their own with the same name.
    """
    spark, secret = docs.sparkSession, fresh_key()
    prepare(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", row_key("doc_id", "text"))
    signed = written(docs.mapInArrow(_signatures(size, secret, bands, band_bins), SIGNATURE), "signatures", merge=False)
    real = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = real.groupBy("set_hash").agg(F.min(F.struct("doc_id", "key")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "set_hash", F.col("first.doc_id").alias("doc_id"), F.col("first.key").alias("key"), "n", "bands"), "classes")
    buckets = classes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("size")).filter("size > 1")
    hubs = hubs.select("bucket", "size", F.col("hub.node").alias("a"), F.col("hub.n").alias("hub_n"))
    full = written(buckets.join(hubs, "bucket"), "buckets")
    # the texts that the two turns compare, one for each class that shares a bucket
    shared = full.select("node").distinct().join(classes.select("node", "key"), "node")
    texts = written(docs.join(shared.hint("merge"), "key").select("node", "text").dropDuplicates(["node"]), "texts")
    stars = full.filter(f"node <> a and 100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)").select("a", F.col("node").alias("b")).distinct()
    stars = written(stars, "stars")
    links = written(_confirmed(stars, texts, size, secret, percent), "links")
    found = connected_components(links, "a", "b")

    member = full.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    member = written(member.select("bucket", "band", "size", "a", "node", "n", "component"), "members")
    mixed = member.groupBy("bucket").agg(F.min("component").alias("first"), F.max("component").alias("last")).filter("first < last").select("bucket", "first")
    more = written(_across(member.join(mixed, "bucket"), classes, texts, size, secret, percent), "links")
    if not more.isEmpty():
        found = connected_components(links.union(more), "a", "b")

    named = classes.select("set_hash", "node", "doc_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(first, "component").select("set_hash", "component_id")
    alone = F.col("n_shingles") == 0
    key = ["key"] if with_key else []
    out = signed.select("doc_id", *key, "n_shingles", F.when(~alone & F.col("doc_id").isNotNull(), F.col("set_hash")).alias("set_hash")).join(named, "set_hash", "left")
    out = out.select("doc_id", *key, "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def representatives(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """docs without near duplicates, with their own columns: of each group only the document of the smallest doc_id.

    Of rows that repeat that doc_id within the group one stays; a row without doc_id and one without words stay.
    """
    found = near_duplicates(docs, size, percent, with_key=True)
    gone = written(found.filter(~F.col("kept")).select("key").distinct(), "duplicates")
    # rows that share key have one doc_id and one text; different texts under one doc_id may be one group, too
    twins = found.filter("kept and n_shingles > 0 and doc_id is not null").groupBy("component_id").agg(F.count("*").alias("n"), F.min("key").alias("key")).filter("n > 1").select("component_id", "key")
    twins = written(twins, "twins")
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.select(own, "doc_id", F.coalesce("text", F.lit("")).alias("text")).select("row", row_key("doc_id", "text").alias("key"))
    left = keyed.join(gone.hint("merge"), "key", "left_anti")  # what goes grows with the documents: the same plan at every size
    if twins.isEmpty():
        return left.select("row.*")
    names = twins.select("component_id", F.col("key").alias("first"))
    marked = left.join(names, F.col("row.doc_id") == F.col("component_id"), "left")
    alone = marked.filter("component_id is null").select("row")
    several = marked.filter("component_id is not null and key = first").groupBy("key").agg(F.first("row").alias("row")).select("row")
    return alone.union(several).select("row.*")
