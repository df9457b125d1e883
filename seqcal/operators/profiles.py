"""Calibration of one profile: search of the labelled references, best scores, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import calibration, checks, references


def calibrate_profile(classes: DataFrame, profile, backend, search_space: float, comparison: float | None = None, delta: float = 5.0, target_evalue: float = 10.0, domain_evalue: float = 10.0, independent_evalue: float = 10.0, family: str | None = None) -> dict:
    """classes(class_label, slot, accession, tags, sequence, sequence_sha256) against one profile, without a coverage
    limit and with a wide E-value limit, so that the whole range of scores is seen."""
    from ..search import kernel

    name = profile.name if family is None else family.strip().removesuffix(".hmm")
    if not name or name != profile.name:
        raise checks.InputError(f"family {name!r} does not match profile {profile.name!r}")
    references.require_disjoint(classes)
    targets = references.labelled_targets(classes).persist()
    labels = {r.class_label for r in targets.select("class_label").distinct().collect()}
    if "positive" not in labels or not labels & {"hard_negative", "easy_negative"}:
        raise checks.InputError("positive and negative references are required")
    options = {"target_evalue": target_evalue, "domain_evalue": domain_evalue, "independent_evalue": independent_evalue, "coverage": 0.0, "search_space": search_space}
    found = kernel.scan_records(targets.select("ordinal", "target_id", "sequence"), backend, **options)
    best = calibration.checked_best_scores(found.select("target_id", F.col("domain_bit_score_bits").alias("score")), targets)
    scores = best.join(targets.select("target_id", "class_label"), "target_id").select(F.lit(name).alias("family"), "score", (F.col("class_label") == "positive").alias("is_positive"), "class_label", "had_hit").persist()
    report = calibration.calibration_report(scores, name, comparison, delta)
    spread = {r["class_label"]: {k: v for k, v in r.asDict().items() if k != "class_label"} for r in calibration.score_distribution(scores, ["class_label"]).collect()}
    none = calibration.without_domain(scores).first()
    return report | {
        "family": name,
        "profile_length_match_states": profile.match_states,
        "reference_set_manifest": references.reference_manifest(classes),
        "reference_class_counts": {c: spread.get(c, {}).get("number_of_scores", 0) for c in references.CLASSES},
        "hard_negative_score_distribution": spread.get("hard_negative"),
        "easy_negative_score_distribution": spread.get("easy_negative"),
        "number_of_positive_references_without_reported_domain": none.positives_without_domain,
        "number_of_negative_references_without_reported_domain": none.negatives_without_domain,
        "calibration_search_parameters": {
            "target_reporting_evalue_threshold": target_evalue, "domain_reporting_evalue_threshold": domain_evalue, "independent_domain_evalue_threshold": independent_evalue,
            "minimum_hmm_coverage_fraction": 0.0, "evalue_search_space_Z": search_space, "missing_reported_domain_score_bits": 0.0, "search_backend": kernel.BACKEND,
        },
    }
