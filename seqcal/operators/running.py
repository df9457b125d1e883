"""Running totals, ranks and as-of values over a sorted table of any size, none of whose groups is gathered in one task.

A table is dealt to physical partitions by ranges of (keys, order) and sorted there. Each task sums up its own rows in
that order and writes them, with the number of its partition. What a group needs from the partitions before its own is
one row for each partition, the carry, which is added as the table is read. So there are one shuffle and one written
table, whatever the size of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from ..shared import written
from ..shipping import ship


def ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    """df in sorted physical partitions whose ranges ascend: as many as the session shuffles to, which AQE leaves alone."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def fresh_rows(batch: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Which rows begin a group of equal keys; the first one always does. Rows of a group stand together."""
    fresh = np.zeros(batch.num_rows, dtype=bool)
    fresh[:1] = True
    for k in keys:
        column = batch[k].combine_chunks() if isinstance(batch, pa.Table) else batch[k]
        codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        fresh[1:] |= codes[1:] != codes[:-1]
    return fresh


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of sorted batches again, in tables that hold whole groups of equal keys: as many as a batch, or one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(np.flatnonzero(fresh_rows(batch, keys))[-1])  # the group that may go on in the next batch
        ended = bool(held) and [held[-1][k][-1].as_py() for k in keys] != [batch[k][0].as_py() for k in keys]
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        elif ended:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


class _Scan:
    """The running values of one physical partition, a batch at a time."""

    def __init__(self, keys: list[str], sums: list[str], lasts: list[str]):
        self.keys, self.sums, self.lasts = keys, sums, lasts
        self.key: list | None = None
        self.total = dict.fromkeys(sums, 0)
        self.last: dict[str, pa.Array | None] = dict.fromkeys(lasts)
        self.groups, self.rows = 0, 0

    def step(self, batch: pa.RecordBatch) -> list[pa.Array]:
        n = batch.num_rows
        fresh = fresh_rows(batch, self.keys)
        fresh[0] = [batch[k][0].as_py() for k in self.keys] != self.key
        group = self.groups + np.cumsum(fresh)
        start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        goes_on = group == self.groups  # rows of the group that the batch before ended with
        out = [pa.array(np.full(n, TaskContext.get().partitionId(), dtype=np.int32)), pa.array(np.arange(self.rows, self.rows + n)), pa.array(group == 1)]
        for v in self.sums:
            values = batch[v].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.cumsum(values)
            running = sums - (sums - values)[start] + np.where(goes_on, self.total[v], 0)
            self.total[v] = int(running[-1])
            out.append(pa.array(running))
        for v in self.lasts:
            known = np.maximum.accumulate(np.where(batch[v].is_valid().to_numpy(zero_copy_only=False), np.arange(n), -1))
            known = np.where(known >= start, known, -1)
            if self.last[v] is not None:  # stands behind the batch's own values
                known = np.where((known < 0) & goes_on, n, known)
                source = pa.concat_arrays([batch[v], self.last[v]])
            else:
                source = batch[v]
            found = source.take(pa.array(known, mask=known < 0))
            self.last[v] = found[n - 1 :] if found[n - 1].is_valid else None
            out.append(found)
        self.key = [batch[k][n - 1].as_py() for k in self.keys]
        self.groups, self.rows = int(group[-1]), self.rows + n
        return out


def _carries(ends: list, keys: list[str], sums: list[str], lasts: list[str]) -> list[tuple]:
    """(partition, sums, lasts) that each partition's first group brings from those before, where there are some."""
    out: list[tuple] = []
    before, brought = None, ([0] * len(sums), [None] * len(lasts))
    for row in sorted(ends, key=lambda r: r["_scan_part"]):
        first, last = [row["head"][k] for k in keys], [row["tail"][k] for k in keys]
        if before != first:
            brought = ([0] * len(sums), [None] * len(lasts))
        elif any(brought[0]) or any(x is not None for x in brought[1]):
            out.append((row["_scan_part"], *brought[0], *brought[1]))
        total = [row["tail"][f"running_{v}"] for v in sums]
        known = [row["tail"][f"last_{v}"] for v in lasts]
        if first == last:  # the group goes through the whole partition
            total = [a + b for a, b in zip(total, brought[0], strict=True)]
            known = [b if a is None else a for a, b in zip(known, brought[1], strict=True)]
        before, brought = last, (total, known)
    return out


def prefix_scan(df: DataFrame, keys: list[str], order: list[Column], sums: list[str] = (), lasts: list[str] = ()) -> DataFrame:
    """df with running_<v> for each long v of sums (the total of the rows of the same keys up to the row itself, null as
    zero) and last_<v> for each v of lasts (its last value in these rows that is not null).

    Rows of the same keys and order have no defined place among themselves and go to one partition, so order should tell
    rows apart: sum rows that are alike up first. Null keys are a group of their own.
    """
    spark, sums, lasts = df.sparkSession, list(sums), list(lasts)
    ship(spark)
    names = df.columns
    fields = [StructField("_scan_part", IntegerType()), StructField("_scan_at", LongType()), StructField("_scan_lead", BooleanType())]
    running = [StructField(f"running_{v}", LongType()) for v in sums] + [StructField(f"last_{v}", df.schema[v].dataType) for v in lasts]
    schema = StructType([*df.schema.fields, *fields, *running])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(keys, sums, lasts)
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, *scan.step(batch)], names=[f.name for f in schema])

    table = written(ranged(df, [*(F.col(k) for k in keys), *order]).mapInArrow(run, schema), "scan", merge=False)
    tail = F.max_by(F.struct(*keys, *(f.name for f in running)), "_scan_at").alias("tail")
    ends = table.groupBy("_scan_part").agg(F.min_by(F.struct(*keys), "_scan_at").alias("head"), tail).collect()  # a row for each partition
    carried = _carries(ends, keys, sums, lasts)
    if not carried:
        return table.select(*names, *(f.name for f in running))
    carry = spark.createDataFrame(carried, StructType([StructField("_scan_part", IntegerType()), *(StructField(f"_carry_{f.name}", f.dataType) for f in running)]))
    joined = table.join(F.broadcast(carry), "_scan_part", "left")
    brought = lambda name: F.when(F.col("_scan_lead"), F.col(f"_carry_{name}"))
    total = [(F.col(f"running_{v}") + F.coalesce(brought(f"running_{v}"), F.lit(0))).alias(f"running_{v}") for v in sums]
    known = [F.coalesce(f"last_{v}", brought(f"last_{v}")).alias(f"last_{v}") for v in lasts]
    return joined.select(*names, *total, *known)
