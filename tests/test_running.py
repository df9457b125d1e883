"""Scans over physical partitions and exact sums against plain Python."""

import itertools
import math
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from seqcal.functions import exact
from seqcal.operators.running import prefix_scan


def brute(rows, falling):
    out = {}
    for _, group in itertools.groupby(sorted(rows, key=lambda r: ((r[0] is not None, r[0] or ""), -r[1] if falling else r[1])), key=lambda r: r[0]):
        total, last = 0, None
        for key, at, n, note in group:
            total += n or 0
            last = note if note is not None else last
            out[key, at] = (total, last)
    return out


@pytest.mark.parametrize("groups", [1, 3, 40])
@pytest.mark.parametrize("falling", [False, True])
@pytest.mark.parametrize("parts", [1, 5, 23])
def test_running_totals_and_last_values(spark, groups, falling, parts):
    rng = random.Random(groups)
    rows = [(rng.choice([None, *(f"g{i}" for i in range(groups - 1))]), i, rng.choice([None, 1, 5, -3]), rng.choice([None, None, None, f"n{i}"])) for i in range(500)]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(rows, "g string, at long, n long, note string").withColumn("both", F.when(F.col("note").isNotNull(), F.struct("note", "at")))
        got = prefix_scan(df, ["g"], [F.desc("at") if falling else F.asc("at")], ["n"], ["note", "both"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute(rows, falling)
    assert len(got) == len(rows) and {(r.g, r.at): (r.running_n, r.last_note) for r in got} == want
    assert all((r.last_both and r.last_both.note) == r.last_note for r in got)


def test_small_batches_and_several_keys(spark):
    rows = [(i % 2 == 0, i // 300, i, 1) for i in range(900)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = prefix_scan(spark.createDataFrame(rows, "a boolean, b int, at long, n long"), ["a", "b"], [F.asc("at")], ["n"], ["at"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.at, r.running_n) for r in got} == {(i, i % 300 // 2 + 1) for i in range(900)} and all(r.last_at == r.at for r in got)


def test_empty_tables_and_constant_groups(spark):
    empty = spark.createDataFrame([], "g string, at long, n long")
    assert prefix_scan(empty, ["g"], [F.asc("at")], ["n"]).count() == 0
    # one group over all partitions, whose tasks are of bounded size
    got = prefix_scan(spark.range(10_000).withColumn("g", F.lit("x")), ["g"], [F.asc("id")], ["id"], ["g"])
    assert got.filter("running_id <> id * (id + 1) div 2 or last_g <> 'x'").isEmpty() and got.count() == 10_000
    assert got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 6_000


SPECIAL = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1e16, -1e16, 1.0, 0.1, 2.0**32, 2.0**-32, 2.0**31.999999, 1e-300, 3.3e150]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False) | st.sampled_from(SPECIAL), max_size=30), min_size=1, max_size=6))
def test_sums_are_rounded_once(spark, groups):
    rows = [(i, v) for i, own in enumerate(groups) for v in own]
    got = {r.g: r.total for r in exact.exact_sums(spark.createDataFrame(rows, "g int, v double"), ["g"], "v", "total").collect()}
    for i, own in enumerate(groups):
        if own:
            try:
                want = math.fsum(own)
            except OverflowError:  # of a partial sum; the exact one may fit
                total = sum(int(v * 2**0) if v == int(v) else v for v in own) if all(v == int(v) for v in own) else None
                if total is None:
                    continue
                want = math.copysign(math.inf, total) if abs(total) >= 2**1024 - 2**970 else float(total)
            assert got[i] == want


def test_weights_nulls_and_infinities(spark):
    rows = [("w", 0.1, 10**15), ("w", 1e-5, 3), ("n", None, 2), ("i", math.inf, 1), ("i", 1.0, 1), ("x", math.inf, 1), ("x", -math.inf, 1), ("a", math.nan, 1), (None, 2.5, 2)]
    got = {r.g: r.total for r in exact.exact_sums(spark.createDataFrame(rows, "g string, v double, n long"), ["g"], "v", "total", "n").collect()}
    from fractions import Fraction

    assert got["w"] == float(Fraction(0.1) * 10**15 + Fraction(1e-5) * 3)
    assert got["n"] == 0.0 and got["i"] == math.inf and math.isnan(got["x"]) and math.isnan(got["a"]) and got[None] == 5.0
