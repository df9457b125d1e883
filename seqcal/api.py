"""The entry points of the package by the names that users know."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from .operators import calibration, checks, hits
from .operators.calibration import roc_auc, roc_curve, wilson as wilson_interval, zero_false_positive_cutoff as select_zero_observed_false_positive_cutoff
from .search import kernel, model
from .search.kernel import scan_records
from .search.model import load_hmms
from .sources import fasta

__all__ = ["DomainHit", "confusion_at_threshold", "load_hmms", "roc_auc", "roc_curve", "scan_fasta", "scan_records", "select_zero_observed_false_positive_cutoff", "wilson_interval"]

DomainHit = Row(*hits.DOMAIN_HIT)  # makes rows of the tables that scans return


def confusion_at_threshold(scores: DataFrame, threshold: float) -> DataFrame:
    """Counts and rates of every family of scores(family, score, is_positive) at one threshold, which passes itself."""
    value = checks.finite_number(threshold, "threshold")
    return calibration.confusion_at_thresholds(scores, scores.select("family").distinct().select("family", F.lit(value).alias("threshold")))


def scan_fasta(spark: SparkSession, path: str, profiles: list[model.Profile], preflight: bool = True, **parameters: float) -> DataFrame:
    """scan_records of the proteins of a FASTA file; preflight checks them first, in a pass of its own."""
    if not profiles:
        raise checks.InputError("no profiles")
    checks.search_options(**parameters)
    records = fasta.read_proteins(spark, path)
    if preflight:
        checks.inspect_proteins(records)
    return kernel.scan_records(records, kernel.NumpyBackend(profiles), **parameters)
