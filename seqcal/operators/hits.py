"""From raw domain rows of a search to the table of accepted hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from . import checks

RAW_DOMAIN = (
    "profile_name string, target_id string, target_evalue double, target_length int, i_evalue double, score double, hmm_from int, hmm_to int, hmm_length int,"
    " target_from int, target_to int, alignment_target_length int"
)
DOMAIN_HIT = [
    "profile_name", "target_id", "target_full_sequence_evalue", "independent_domain_evalue", "domain_bit_score_bits", "hmm_start_match_state", "hmm_end_match_state",
    "hmm_length_match_states", "hmm_alignment_coverage_fraction", "target_start_amino_acid_position", "target_end_amino_acid_position", "target_length_amino_acids",
]
HIT_COLUMNS = [*(c for c in DOMAIN_HIT if c != "hmm_alignment_coverage_fraction"), "hmm_alignment_coverage_percent"]
ORDER = ["target_id", "target_start_amino_acid_position", "profile_name", "independent_domain_evalue", "target_end_amino_acid_position"]


def raw_problem(most_evalue: float) -> Column:
    """Why a raw row can't be used, or null. Coordinates of domains beyond the E-value threshold are not looked at."""
    name, target = T.profile_name(F.col("profile_name")), T.trim_space(F.col("target_id"))
    say = lambda what: F.concat(F.lit(what + ": "), name, F.lit(" against "), target)
    finite = lambda c: T.finite(F.col(c))
    near = F.col("i_evalue") <= most_evalue
    return (
        F.when(name == "", F.lit("a result has an empty profile name"))
        .when(target == "", F.concat(F.lit("a hit has an empty target identifier: "), name))
        .when(~finite("target_evalue") | (F.col("target_evalue") < 0), say("invalid target E-value"))
        .when(F.col("target_length") <= 0, say("invalid target length"))
        .when(~finite("i_evalue") | (F.col("i_evalue") < 0) | ~finite("score"), say("invalid domain statistic"))
        .when(near & ~F.expr("hmm_length > 0 and 1 <= hmm_from and hmm_from <= hmm_to and hmm_to <= hmm_length"), say("invalid profile coordinates"))
        .when(near & ~F.expr("alignment_target_length = target_length and 1 <= target_from and target_from <= target_to and target_to <= target_length"), say("invalid target coordinates"))
    )


def domain_hits(raw: DataFrame, most_evalue: float = 1e-15, least_coverage: float = 0.35) -> DataFrame:
    """Rows within both limits, which count as inside, in the columns of DOMAIN_HIT; other columns stay behind them."""
    coverage = (F.col("hmm_to") - F.col("hmm_from") + 1) / F.col("hmm_length")
    kept = raw.filter(F.col("i_evalue") <= most_evalue).withColumn("hmm_alignment_coverage_fraction", coverage).filter(F.col("hmm_alignment_coverage_fraction") >= least_coverage)
    source = {
        "profile_name": T.profile_name(F.col("profile_name")), "target_id": T.trim_space(F.col("target_id")), "target_full_sequence_evalue": F.col("target_evalue"),
        "independent_domain_evalue": F.col("i_evalue"), "domain_bit_score_bits": F.col("score"), "hmm_start_match_state": F.col("hmm_from"), "hmm_end_match_state": F.col("hmm_to"),
        "hmm_length_match_states": F.col("hmm_length"), "hmm_alignment_coverage_fraction": F.col("hmm_alignment_coverage_fraction"), "target_start_amino_acid_position": F.col("target_from"),
        "target_end_amino_acid_position": F.col("target_to"), "target_length_amino_acids": F.col("target_length"),
    }
    read = {"profile_name", "target_id", "target_evalue", "target_length", "i_evalue", "score", "hmm_from", "hmm_to", "hmm_length", "target_from", "target_to", "alignment_target_length"}
    return kept.select(*(source[c].alias(c) for c in DOMAIN_HIT), *(c for c in raw.columns if c not in read))


def checked_domain_hits(raw: DataFrame, most_evalue: float = 1e-15, least_coverage: float = 0.35, ordinal: str = "ordinal") -> DataFrame:
    checks.require(raw, raw_problem(most_evalue), ordinal)
    return domain_hits(raw, most_evalue, least_coverage)


def hit_rows(hits: DataFrame) -> DataFrame:
    """Coverage in percent, in the last column."""
    return hits.withColumn("hmm_alignment_coverage_percent", F.col("hmm_alignment_coverage_fraction") * 100.0).select(*HIT_COLUMNS)


def coverage_fraction(hits: DataFrame) -> Column:
    """The fraction from whichever coverage column hits has."""
    return F.col("hmm_alignment_coverage_fraction") if "hmm_alignment_coverage_fraction" in hits.columns else F.col("hmm_alignment_coverage_percent") / 100.0


def ordered(hits: DataFrame) -> DataFrame:
    return hits.orderBy(*ORDER, F.desc("domain_bit_score_bits"))
