"""Reproducible samples.

sample() picks rows by a keyed hash. reservoir() and shuffled() give the very rows that a sequential program with the same
seed draws: the draws depend on seed, size and number of items only, so a task for each group replays them, in chunks, and
sends which rank stands in which slot; a join picks the rows. No rows or draws pass the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.draws import reservoir_ranks, shuffled_ranks
from ..shipping import ship
from .running import prefix_scan

SLOT_ROWS = 1 << 16  # slots of one batch


def sample(df: DataFrame, group: str, keys: list[str], sizes: dict[str, int], seed: str) -> DataFrame:
    """The rows of least hash of keys and seed in each group of sizes, as many as it names, with their slot. Every task
    sends no more than that of a group."""
    wanted = F.create_map(*(F.lit(x) for g, n in sizes.items() for x in (g, n)))[F.col(group)]
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.md5(F.concat_ws(":", F.lit(seed), *keys)), *keys))
    most = max(sizes.values(), default=0)
    found = df.filter(wanted.isNotNull()).withColumn("slot", place).filter(F.col("slot") <= most)
    return found.filter(F.col("slot") <= wanted).withColumn("slot", (F.col("slot") - 1).cast("long"))


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds rank: the place, from 0, of each row in its group by order, which must tell rows apart. Null groups are one."""
    scanned = prefix_scan(df.withColumn("_one", F.lit(1).cast("long")), [group], [F.asc(c) for c in order], ["_one"])
    return scanned.select(*df.columns, (F.col("running__one") - 1).alias("rank"))


def _drawn(df: DataFrame, group: str, order: list[str], sizes: dict[str, int], seeds: dict[str, str], ranks: Callable[[str, int, int], np.ndarray]) -> DataFrame:
    """df's rows at the ranks that are drawn for each group of sizes, with their slot. Only the group and the order are
    ranked; the rows of the drawn ones are then looked up in df, whose other columns are neither sorted nor written."""
    ship(df.sparkSession)
    df, keys = df.filter(F.col(group).isin(list(sizes))), list(dict.fromkeys([group, *order]))
    named = ranked(df.select(*keys), group, order)
    seen = named.groupBy(group).agg((F.max("rank") + 1).alias("seen"))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n in zip(batch[group].to_pylist(), batch["seen"].to_pylist(), strict=True):
                found = ranks(seeds[name], sizes[name], n)
                for at in range(0, len(found), SLOT_ROWS):
                    part = found[at : at + SLOT_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(np.arange(at, at + len(part))), pa.array(part)], names=[group, "slot", "rank"])

    # a task for each group, as a group's draws follow from each other
    table = seen.repartition(len(sizes), group).mapInArrow(slots, f"`{group}` string, slot long, rank long")
    drawn = named.join(table, [group, "rank"]).drop("rank")
    if set(df.columns) == set(keys):
        return drawn.select(*df.columns, "slot")
    row = F.struct(*keys).alias("_row")  # equal structs, also of nulls, join
    found = df.select("*", row).join(drawn.select(row, "slot"), "_row")
    return found.dropDuplicates([group, "slot"]).select(*df.columns, "slot")


def reservoir(df: DataFrame, group: str, order: list[str], sizes: dict[str, int], seeds: dict[str, str]) -> DataFrame:
    """A reservoir sample of each group with its slot, as if its rows had come in order (which must tell rows apart)."""
    return _drawn(df, group, order, sizes, seeds, reservoir_ranks)


def shuffled(df: DataFrame, group: str, order: list[str], sizes: dict[str, int], seeds: dict[str, str]) -> DataFrame:
    """The first rows of each group's shuffled order, with their slot."""
    return _drawn(df, group, order, sizes, seeds, shuffled_ranks)
