"""Overlap of domains on a target, and greedy suppression of the weaker of two that overlap."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType

from ..shared import written
from ..shipping import ship
from .running import fresh_rows, ranged, whole_groups

REGION, WIDEST = 512, 1 << 16  # positions that one task looks at in the first round and, as fewer hits are left, later; a hit takes part in every region that it touches
PAIRS = 1 << 20  # candidates that a sweep holds at once
CLEAR, WAITING, KEPT, DROPPED = range(4)  # the greatest of a hit's states in its regions counts


def overlap_of_shorter(start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """Shared positions over the length of the shorter interval; both ends are inclusive."""
    shared = F.greatest(F.lit(0), F.least(end1, end2) - F.greatest(start1, start2) + 1)
    return shared / F.least(end1 - start1 + 1, end2 - start2 + 1)


def _shares(start: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """overlap_of_shorter of the intervals a[i] and b[i]."""
    shared = np.minimum(end[a], end[b]) - np.maximum(start[a], start[b]) + 1
    length = end - start + 1
    return np.maximum(shared, 0) / np.minimum(length[a], length[b])


def _swept(least: float):
    """Rows come sorted by (part, other, target, start, ordinal). A row's partners are the rows behind it that start before
    its end, which stand together; in a block of two parts only rows of the later one are partners, of the earlier one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["part", "other"]):
            start, end, ordinal = (table[c].to_numpy() for c in ("start", "end", "ordinal"))
            first_start = start.min()
            span = int(end.max() - first_start) + 1
            fresh = fresh_rows(table, ["part", "other", "target_id"])
            group = np.cumsum(fresh) - 1
            key = group * span + (start - first_start)
            carried, own = table["carried"].to_numpy(), table["part"].to_numpy() == table["other"].to_numpy()
            # the rows of an earlier part come first in a group of two parts
            begin = np.flatnonzero(fresh)[group] + np.bincount(group, carried)[group].astype(np.int64)
            low = np.where(own, np.arange(len(key)) + 1, begin)
            high = np.searchsorted(key, group * span + (end - first_start), side="right")
            count = np.where(own | carried, np.maximum(high - low, 0), 0)
            done = np.concatenate([[0], np.cumsum(count)])
            at = 0
            while at < len(count):
                to = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, side="right")) - 1)
                a = np.repeat(np.arange(at, to), count[at:to])
                b = np.arange(len(a)) + np.repeat(low[at:to] - (done[at:to] - done[at]), count[at:to])
                share = _shares(start, end, a, b)
                real = share > least
                x, y = ordinal[a[real]], ordinal[b[real]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(share[real])], names=["first", "second", "overlap"])
                at = to

    return run


def overlapping_pairs(hits: DataFrame, least: float = 0.0) -> DataFrame:
    """first, second (ordinals), overlap of hits on one target that share more than least, which is not below zero.

    A plane sweep: hits are dealt to physical partitions by ranges of (target, start, ordinal), so hits that start at one
    position are dealt, too. Hits that reach over the start of later partitions are carried to them, to meet there the
    hits that start before they end: each two partitions between which hits reach are a block of their own. A task so
    holds the rows of two partitions at most, however many hits lie on one position. Hits without a target have no pairs.
    """
    spark = hits.sparkSession
    ship(spark)
    rows = hits.filter("target_id is not null").select("target_id", *(F.col(c).cast("long").alias(c) for c in ("start", "end", "ordinal")))
    table = written(ranged(rows, [F.asc("target_id"), F.asc("start"), F.asc("ordinal")]).withColumn("part", F.spark_partition_id()), "ranges", merge=False)
    ends = table.groupBy("part").agg(F.min(F.struct("target_id", "start")).alias("head"), F.max(F.struct("target_id", "end")).alias("tail")).orderBy("part").collect()
    reaching = []
    for i, a in enumerate(ends):  # a row for each partition
        for b in ends[i + 1 :]:
            if b.head.target_id != a.tail.target_id or b.head.start > a.tail.end:
                break
            reaching.append((b.part, a.part, b.head.target_id, b.head.start, a.tail.end))
    blocks = spark.createDataFrame(reaching, "part int, other int, target string, from long, to long")
    names = ["part", "other", "target_id", "start", "end", "ordinal"]
    own = table.withColumn("other", F.col("part")).select(*names, F.lit(False).alias("carried"))
    earlier = table.withColumnRenamed("part", "other").join(blocks, "other").filter("target_id = target and end >= from").select(*names, F.lit(True).alias("carried"))
    later = table.join(blocks, "part").filter("target_id = target and start <= to").select(*names, F.lit(False).alias("carried"))
    dealt = (own.unionByName(earlier).unionByName(later) if reaching else own).repartition("part", "other")
    # a part's rows come before those of a later one: equal starts are dealt by ordinal
    return dealt.sortWithinPartitions("part", "other", "target_id", "start", "ordinal").mapInArrow(_swept(least), "first long, second long, overlap double")


def decided(group: np.ndarray, start: np.ndarray, end: np.ndarray, regions: np.ndarray, kept: np.ndarray, most: float) -> np.ndarray:
    """The state of each hit as far as its region tells. Hits of a group (a region) stand together, the best first.

    In each turn the best undecided hit of every group is judged. One that a better kept hit overlaps was dropped before.
    One that a better hit overlaps that isn't decided has to wait. Another one is kept if the region shows all of it, else
    clear: it is kept if all its regions say so.
    """
    state = np.full(len(group), DROPPED)
    waits = np.zeros(len(group), dtype=bool)
    rest = np.arange(len(group))
    while len(rest):
        head = np.concatenate([[True], group[rest[1:]] != group[rest[:-1]]])
        best = rest[head]
        state[best] = np.where(kept[best], KEPT, np.where(waits[best], WAITING, np.where(regions[best] == 1, KEPT, CLEAR)))
        against = best[np.cumsum(head) - 1][~head]
        rest = rest[~head]
        over = _shares(start, end, against, rest) > most
        stays = ~(over & (state[against] == KEPT))
        waits[rest[over & stays]] = True
        rest = rest[stays]
    return state


def _decide(most: float):
    names = ["target_id", "start", "end", "hit", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["target_id", "region"]):
            group = np.cumsum(fresh_rows(table, ["target_id", "region"]))
            state = decided(group, *(table[c].to_numpy() for c in ("start", "end", "regions", "kept")), most)
            yield from table.select(names).append_column("state", pa.array(state.astype(np.int32))).combine_chunks().to_batches()

    return run


def distinct_domains(hits: DataFrame, most: float = 0.5, region: int = REGION) -> DataFrame:
    """hits(target_id, start, end, evalue, score, coverage, ordinal) without those that overlap a better kept one.

    Better is a lower E-value, then a higher score, a greater coverage, an earlier start, end and ordinal. Of equal
    intervals the best one is taken before anything is gathered. Then come rounds: a hit takes part in each region of
    positions that it touches; a region keeps every hit that is the best of its undecided neighbours there and drops what
    these overlap, and so on, as far as the region tells. A hit that crosses a border is kept once all its regions find no
    better one; hits that hang on it are decided in the next round. As the best undecided hit of a target is decided in
    each round, rounds end, with the outcome of one pass over all hits in order; they are as many as decisions in a row
    that hang on each other across borders, and regions grow fourfold a round, up to WIDEST positions. A task holds the
    distinct undecided intervals that touch one region, not a target. A null target_id is a target of its own, null scores
    and coverages count as zero.
    """
    if most >= 1:  # no two intervals share more than all of the shorter one
        return hits
    spark = hits.sparkSession
    ship(spark)
    ranked = F.struct(F.col("evalue"), (-F.coalesce("score", F.lit(0.0))).alias("s"), (-F.coalesce("coverage", F.lit(0.0))).alias("c"), F.col("start"), F.col("end"), F.col("ordinal"))
    named = hits.select(F.coalesce("target_id", F.lit("")).alias("target_id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), ranked.alias("hit"))
    live = named.groupBy("target_id", "start", "end").agg(F.min("hit").alias("hit")).withColumn("kept", F.lit(False))
    found = []
    while True:
        touched = F.sequence(F.floor(F.col("start") / region), F.floor(F.col("end") / region))
        placed = live.withColumn("touched", touched).withColumn("regions", F.size("touched")).withColumn("region", F.explode("touched")).drop("touched")
        judged = placed.repartition("target_id", "region").sortWithinPartitions("target_id", "region", "hit").mapInArrow(_decide(most), live.schema.add("state", IntegerType()))
        states = judged.filter("not kept or state <> 2").groupBy("target_id", "start", "end").agg(F.min("hit").alias("hit"), F.max("kept").alias("kept"), F.max("state").alias("state"))
        states = written(states.filter(f"not kept and state <> {DROPPED}").drop("kept"), "states")
        found.append(states.filter(f"state <> {WAITING}").select("target_id", "hit.ordinal"))
        if states.filter(f"state = {WAITING}").isEmpty():
            break
        region = min(4 * region, max(region, WIDEST))
        live = states.filter(f"state <> {KEPT}").withColumn("kept", F.col("state") == CLEAR).drop("state")
    chosen = reduce(DataFrame.union, found)
    return hits.withColumn("target_id", F.coalesce("target_id", F.lit(""))).join(chosen, ["target_id", "ordinal"], "left_semi").select(*hits.columns)
