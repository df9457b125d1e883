"""Operational cutoffs applied to scores; the same function serves batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from . import checks

PASSES, BELOW, UNCALIBRATED = "passes_operational_cutoff", "below_operational_cutoff", "uncalibrated_family"
CUTOFF_COLUMN, CLASS_COLUMN = "operational_cutoff_bit_score_bits", "operational_cutoff_classification"


def classification(score: Column, cutoff: Column) -> Column:
    return F.when(cutoff.isNull(), UNCALIBRATED).when(score >= cutoff, PASSES).otherwise(BELOW)


def apply_cutoffs(hits: DataFrame, cutoffs: DataFrame, family: str = "profile_name", score: str = "domain_bit_score_bits") -> DataFrame:
    """All columns of hits and the family's cutoff and class; cutoffs(family, cutoff) has one row for each family.

    Families match by their trimmed name. Output columns from an earlier run are replaced.
    """
    hits = hits.drop(CUTOFF_COLUMN, CLASS_COLUMN)
    named = cutoffs.select(F.col("family").alias("_family"), F.col("cutoff").alias(CUTOFF_COLUMN))
    joined = hits.join(named, T.trim_space(F.col(family)) == F.col("_family"), "left").drop("_family")
    return joined.withColumn(CLASS_COLUMN, classification(F.col(score).cast("double"), F.col(CUTOFF_COLUMN)))


def classified_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy(CLASS_COLUMN).agg(F.count("*").alias("n"))


def uncalibrated(hits: DataFrame, cutoffs: DataFrame, family: str = "profile_name") -> DataFrame:
    return hits.join(cutoffs, T.trim_space(F.col(family)) == cutoffs.family, "left_anti")


def require_calibrated(hits: DataFrame, cutoffs: DataFrame, family: str = "profile_name") -> None:
    n = uncalibrated(hits, cutoffs, family).count()
    if n:
        raise checks.InputError(f"{n} hit rows use profiles without supplied cutoffs")
