"""FASTA files of any store that Spark reads, split by blocks; problems are rows, not crashed tasks.

Spark's text reader cuts files at every >, so no row is longer than a record and any line ends will do. A piece is the
begin of a record if the piece before it ends in a line break with only white space behind it; else its > stands within a
line. Numbers of such ends, counted for each block of a file and added up over its blocks, number the records across
tasks. Nearly every piece is a record of its own; only those that a > within a line or a block's end takes apart are
gathered, each record for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as T
from ..operators import checks
from ..operators.checks import InputError
from ..operators.running import fresh_rows
from ..shared import written
from ..shipping import ship


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row (rising within a block), value, ends: what stands between > and >; ends tells that a > behind the
    piece begins a record."""
    try:
        rows = spark.read.option("lineSep", ">").option("recursiveFileLookup", "true").text(path)
        meta = [F.col(f"_metadata.{m}").alias(a) for m, a in (("file_path", "file"), ("file_block_start", "block"), ("file_size", "size"))]
        rows = rows.select(*meta, F.monotonically_increasing_id().alias("row"), "value")
    except AnalysisException as error:
        raise InputError(f"FASTA file does not exist: {path}") from error
    broken = rf"[\r\n][{T.WHITE_SPACE}]*\z"
    blank = (F.col("block") == 0) & F.col("value").rlike(rf"\A[{T.WHITE_SPACE}]*\z")  # of the first piece of a file
    rows = rows.withColumns({"broken": F.col("value").rlike(broken), "blank": blank})
    # the reader tells nothing of a last > with nothing behind it, but the file's size does
    read = rows.groupBy("file").agg(F.sum(F.octet_length("value") + 1).alias("read"), F.max("size").alias("size"), F.max("block").alias("block"))
    cut = read.filter("read = size or read = size - 3").select("file", (F.col("block") + 1).alias("block"), F.lit(0).cast("long").alias("row"), F.lit("").alias("value"), F.lit(False).alias("broken"), F.lit(False).alias("blank"))
    return rows.drop("size").unionByName(cut)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to the pieces of each block, in order, first (of the block), ends, and begun: ends before the piece, in its block."""
    file, total, before = None, 0, False
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        fresh = fresh_rows(batch, ["file", "block"])
        key = [batch["file"][0].as_py(), batch["block"][0].as_py()]
        fresh[0] = key != file
        broken, blank = (batch[c].to_numpy(zero_copy_only=False) for c in ("broken", "blank"))
        ends = broken | (blank & fresh)
        counted = np.cumsum(ends)
        start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        goes_on = np.cumsum(fresh) == 0
        begun = counted - ends - (counted - ends)[start] + np.where(goes_on, total, 0)
        previous = np.concatenate([[before], ends[:-1]])
        file, total, before = [batch["file"][n - 1].as_py(), batch["block"][n - 1].as_py()], int(begun[-1] + ends[-1]), bool(ends[-1])
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in ("file", "block", "row", "value")), pa.array(fresh), pa.array(ends), pa.array(begun.astype(np.int64)), pa.array(previous & ~fresh)],
            names=["file", "block", "row", "value", "first", "ends", "begun", "head"],
        )


def _records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, stray): file, record (from 1 in each file), text without its first >, and the text before the first one."""
    ship(spark)
    local = written(_pieces(spark, path).mapInArrow(_local, "file string, block long, row long, value string, first boolean, ends boolean, begun long, head boolean"), "pieces", merge=False)
    # a row for each block of a file
    blocks = local.groupBy("file", "block").agg(F.count_if("ends").alias("n"), F.max_by("ends", "row").alias("last"))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.coalesce(F.lag("last").over(order), F.lit(False)).alias("open"))
    placed = local.join(blocks, ["file", "block"]).select("file", "block", "row", "value", "ends", (F.col("base") + F.col("begun")).alias("record"), (F.col("head") | (F.col("first") & F.col("open"))).alias("head"))
    stray = placed.filter("record = 0").select("file", "value")
    alone = placed.filter("head and ends").select("file", "record", F.col("value").alias("text"))
    parts = placed.filter("record > 0 and not (head and ends)").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("parts"))
    joined = parts.select("file", "record", F.array_join(F.col("parts.value"), ">").alias("text"))
    return alone.unionByName(joined), stray


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """ordinal, header (with its >), sequence; ordinals rise in file order, those of several files follow their names.

    Lines are stripped, blank ones skipped; a line ends with LF, CR or both. Text before the first header, bytes that are
    no UTF-8 and a file set without records are errors. A line that has white space before its > is a header, too, and a >
    within a line is a character; a byte order mark is left out. A table with the files' pieces is written once.
    """
    records, stray = _records(spark, path)
    loose = stray.agg(F.min(F.when(~F.is_valid_utf8("value"), F.col("file"))), F.min(F.when(T.trim_space(F.col("value")) != "", F.col("file")))).first()
    coded = F.is_valid_utf8("text")
    found = records.agg(F.count("*"), F.min(F.when(~coded, F.col("file")))).first()
    if (bad := min(filter(None, (loose[0], found[1])), default=None)) is not None:
        raise InputError(f"text does not decode as UTF-8: {bad}")
    if loose[1] is not None:
        raise InputError(f"sequence text precedes the first header: {loose[1]}")
    if not found[0]:
        raise InputError(f"no FASTA records: {path}")
    files = records.groupBy("file").agg(F.max("record").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    lines = F.filter(F.transform(F.split(F.concat(F.lit(">"), "text"), r"\r\n|\r|\n"), T.trim_space), lambda x: x != "")
    split = records.join(files, "file").select((F.col("before") + F.col("record") - 1).alias("ordinal"), lines.alias("lines"))
    return split.select("ordinal", F.element_at("lines", 1).alias("header"), F.array_join(F.slice("lines", F.lit(2), F.size("lines")), "").alias("sequence"))


def read_proteins(spark: SparkSession, path: str) -> DataFrame:
    """ordinal, target_id (the header's first word), sequence."""
    rows = read_headers(spark, path)
    name = F.regexp_extract("header", f"^>[{T.WHITE_SPACE}]*([^{T.WHITE_SPACE}]*)", 1)
    checks.require(rows, F.when(name == "", F.lit("a header is empty")))
    return rows.select("ordinal", name.alias("target_id"), "sequence")
