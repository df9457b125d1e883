"""Sums of doubles with one rounding at the end, as a Spark aggregate.

A double is split without error in a whole part and a fraction of 53 bits, relative to a power of two in steps of 32: two
whole numbers and the number of its step. Whole numbers add up exactly in any order, so a group is reduced, partly before
the shuffle, to at most 67 rows (one a step), which one function adds up and rounds.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..shipping import ship

STEP = 32
LOWEST, HIGHEST = -34, 32  # floor(log2(x) / STEP) of the least and the greatest double
HALF_SCALES = [2.0 ** (-STEP // 2 * k) for k in range(LOWEST, HIGHEST + 1)]  # applied twice: the whole scale may not be a double
FRACTION_BITS = 53


def _rounded(steps: pd.Series) -> pd.Series:
    """The correctly rounded total of arrays of (step, whole, fraction)."""
    out = []
    for parts in steps:
        total = sum(((int(p["whole"]) << FRACTION_BITS) + int(p["fraction"])) << (STEP * (int(p["step"]) - LOWEST)) for p in parts)
        try:
            out.append(total / (1 << (FRACTION_BITS - STEP * LOWEST)))  # Python rounds a quotient of whole numbers once
        except OverflowError:
            out.append(float("inf") if total > 0 else float("-inf"))
    return pd.Series(out, dtype="float64")


def exact_sums(df: DataFrame, keys: list[str], value: str, name: str, weight: str | None = None) -> DataFrame:
    """keys, name: the sum of value (times weight, a long below 2**60) over each group, rounded once, as math.fsum's.

    Null values count as nothing, and a group of nulls sums to zero. Infinities and NaN give what adding them gives. A sum
    beyond the greatest double is infinite.
    """
    ship(df.sparkSession)
    x, times = F.col(value).cast("double"), F.lit(1) if weight is None else F.col(weight)
    finite = ~(F.isnan(x) | (F.abs(x) == float("inf")))
    step = F.when(finite & (x != 0), F.floor(F.log2(F.abs(x)) / STEP).cast("int"))
    half = F.element_at(F.array(*map(F.lit, HALF_SCALES)), F.col("_step") - LOWEST + 1)
    split = df.select(*keys, F.when(~finite, x).alias("_odd"), F.when(finite, x).alias("_x"), step.alias("_step"), times.cast("decimal(19,0)").alias("_times"))
    split = split.withColumn("_scaled", F.col("_x") * half * half)
    whole = F.floor("_scaled")
    fraction = ((F.col("_scaled") - whole) * float(1 << FRACTION_BITS)).cast("long")
    parts = split.groupBy(*keys, "_step").agg(
        F.sum(whole.cast("decimal(11,0)") * F.col("_times")).alias("whole"), F.sum(fraction.cast("decimal(17,0)") * F.col("_times")).alias("fraction"), F.sum("_odd").alias("_odd"),
    )
    known = F.when(F.col("_step").isNotNull(), F.struct(F.col("_step").alias("step"), "whole", "fraction"))
    total = F.pandas_udf(_rounded, "double")(F.col("_parts"))  # type: ignore[call-overload]
    # collect_list leaves nulls out: at most one row a step
    return parts.groupBy(*keys).agg(F.collect_list(known).alias("_parts"), F.sum("_odd").alias("_odd")).select(*keys, F.coalesce(F.col("_odd"), total).alias(name))


def mean_of(total: Column, n: Column) -> Column:
    """A mean from an exact sum, as statistics.fmean takes it."""
    return total / n
