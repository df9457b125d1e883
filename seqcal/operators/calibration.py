"""ROC curves, cutoffs, intervals and calibration reports over scores(family, score, is_positive).

All families are treated in one job; every function takes and returns DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exact import exact_sums, mean_of
from . import checks
from .running import prefix_scan

Z_95 = 1.959963984540054  # fixed value: the two-sided 95 % point of the normal distribution
# What a report says of itself.
SELECTION_RULE = "lowest evaluated bit-score threshold with zero observed false positives in the calibration negatives"
SCOPE = "internal calibration; not independent external validation"
COUNTS = ["correctly_detected_positives", "missed_positives", "incorrectly_accepted_negatives", "correctly_rejected_negatives"]
RATES = ["sensitivity", "specificity", "false_positive_rate", "false_negative_rate"]
STEPS = ["step_positives", "step_negatives"]
CURVE = ["family", "bit_score_threshold_bits", *COUNTS, *RATES]


def _next(value: Column, direction: str) -> Column:
    return F.java_method(F.lit("java.lang.Math"), F.lit(direction), value).cast("double")


def _with_rates(df: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Rates from tp, fp and the class sizes positives, negatives; columns of extra stay."""
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "positives", "negatives"))
    return df.select(
        "family", F.col("threshold").alias("bit_score_threshold_bits"), tp.alias(COUNTS[0]), (p - tp).alias(COUNTS[1]), fp.alias(COUNTS[2]), (n - fp).alias(COUNTS[3]),
        (tp / p).alias(RATES[0]), ((n - fp) / n).alias(RATES[1]), (fp / n).alias(RATES[2]), ((p - tp) / p).alias(RATES[3]), "positives", "negatives",
        *(c for c in STEPS if c in df.columns), *extra,
    )


def class_sizes(scores: DataFrame) -> DataFrame:
    """family, positives, negatives, of families that have both."""
    sizes = scores.groupBy("family").agg(F.sum(F.col("is_positive").cast("long")).alias("positives"), F.sum((~F.col("is_positive")).cast("long")).alias("negatives"))
    return sizes.filter("positives > 0 and negatives > 0")


def _counted(scores: DataFrame) -> DataFrame:
    """family, threshold, step_positives, step_negatives: equal scores as one row. Adding zero turns -0.0 into 0.0, its equal."""
    positive = F.col("is_positive")
    return scores.groupBy("family", (F.col("score") + 0.0).alias("threshold")).agg(F.sum(positive.cast("long")).alias(STEPS[0]), F.sum((~positive).cast("long")).alias(STEPS[1]))


def confusion_at_thresholds(scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Counts and rates at each threshold of thresholds(family, threshold, ...), a score passing at the threshold.

    An as-of merge: scores and thresholds in one falling order, a threshold behind the scores equal to it, and running
    counts, so each score is read once and each threshold is one row, however many there are. Families without scores of
    both classes have no rows; columns of thresholds beside the first two stay.
    """
    asked = thresholds.select("family", (F.col("threshold") + 0.0).alias("threshold")).distinct().withColumn("asked", F.lit(True))
    none = {c: F.lit(0).cast("long") for c in STEPS}
    both = _counted(scores).withColumn("asked", F.lit(False)).unionByName(asked.withColumns(none))
    merged = prefix_scan(both, ["family"], [F.desc("threshold"), F.asc("asked")], STEPS)
    sizes = merged.groupBy("family").agg(F.sum(STEPS[0]).alias("positives"), F.sum(STEPS[1]).alias("negatives")).filter("positives > 0 and negatives > 0")
    passed = merged.filter("asked").select("family", "threshold", F.col(f"running_{STEPS[0]}").alias("tp"), F.col(f"running_{STEPS[1]}").alias("fp"))
    return _with_rates(thresholds.distinct().join(passed, ["family", "threshold"]).join(sizes, "family"), [c for c in thresholds.columns if c not in ("family", "threshold")])


def roc_curve(scores: DataFrame) -> DataFrame:
    """Counts and rates at every observed score and at sentinels just below the least and above the greatest.

    Equal scores are counted first; running counts go over physical partitions of (family, falling score), so one family
    isn't one task. step_positives and step_negatives count the scores at a threshold itself.
    """
    observed = prefix_scan(_counted(scores), ["family"], [F.desc("threshold")], STEPS).withColumnsRenamed({f"running_{STEPS[0]}": "tp", f"running_{STEPS[1]}": "fp"})
    about = observed.groupBy("family").agg(F.sum(STEPS[0]).alias("positives"), F.sum(STEPS[1]).alias("negatives"), F.min("threshold").alias("low"), F.max("threshold").alias("high"))
    about = about.filter("positives > 0 and negatives > 0")
    zero = F.lit(0).cast("long")
    ends = F.inline(F.array(
        F.struct(_next(F.col("low"), "nextDown").alias("threshold"), F.col("positives").alias("tp"), F.col("negatives").alias("fp")),
        F.struct(_next(F.col("high"), "nextUp").alias("threshold"), zero.alias("tp"), zero.alias("fp")),
    ))
    sentinels = about.select("family", "positives", "negatives", ends).withColumns(dict.fromkeys(STEPS, zero))
    return _with_rates(observed.join(about.select("family", "positives", "negatives"), "family").unionByName(sentinels))


def roc_auc(curve: DataFrame) -> DataFrame:
    """Trapezoid area under the (false positive rate, sensitivity) points of each family.

    A threshold's trapezoid follows from its own row, the point before it being without the scores at the threshold.
    Twice the area is a whole number of cells, so sums are exact in any order.
    """
    tp, n, p = (F.col(c).cast("decimal(18,0)") for c in (COUNTS[0], "step_negatives", "step_positives"))
    area = curve.groupBy("family", "positives", "negatives").agg(F.sum((n * (tp + tp - p)).cast("decimal(38,0)")).cast("double").alias("cells"))
    return area.select("family", (F.col("cells") / 2.0 / F.col("positives") / F.col("negatives")).alias("roc_auc"))


def zero_false_positive_cutoff(curve: DataFrame) -> DataFrame:
    """The lowest threshold of each family that accepts no negative."""
    clean = curve.filter(F.col(COUNTS[2]) == 0)
    return clean.groupBy("family").agg(F.min("bit_score_threshold_bits").alias("threshold"))


def confusion_from_curve(curve: DataFrame, wanted: DataFrame) -> DataFrame:
    """For wanted(family, wanted_threshold) the row of the smallest stored threshold at or above it, else the last.

    An as-of merge: curve and wanted thresholds in one falling order, a wanted one behind the stored one equal to it, which
    takes the stored row before it.
    """
    row = F.struct(*(F.col(c) for c in curve.columns))
    stored = curve.select("family", (F.col("bit_score_threshold_bits") + 0.0).alias("_at"), row.alias("row"), F.lit(None).cast("double").alias("wanted_threshold"), F.lit(False).alias("asked"))
    asked = wanted.select("family", "wanted_threshold").distinct().withColumns({"_at": F.col("wanted_threshold") + 0.0, "asked": F.lit(True)})
    merged = prefix_scan(stored.unionByName(asked, allowMissingColumns=True), ["family"], [F.desc("_at"), F.asc("asked")], lasts=["row"]).filter("asked")
    highest = curve.groupBy("family").agg(F.max_by(row, "bit_score_threshold_bits").alias("highest"))
    found = merged.join(highest, "family").select("wanted_threshold", F.coalesce("last_row", "highest").alias("row"))
    return found.select("wanted_threshold", "row.*")


def wilson(successes: Column, trials: Column, z: float = Z_95) -> tuple[Column, Column]:
    """Lower and upper bound of the two-sided Wilson score interval."""
    n, p = trials.cast("double"), successes / trials
    scale = 1.0 + z * z / n
    centre = (p + z * z / (2.0 * n)) / scale
    margin = z * F.sqrt(p * (1.0 - p) / n + z * z / (4.0 * n * n)) / scale
    return F.greatest(F.lit(0.0), centre - margin), F.least(F.lit(1.0), centre + margin)


def with_intervals(summary: DataFrame) -> DataFrame:
    """Adds Wilson bounds of sensitivity and specificity."""
    low, high = wilson(F.col(COUNTS[0]), F.col("positives"))
    low2, high2 = wilson(F.col(COUNTS[3]), F.col("negatives"))
    return summary.withColumns({"sensitivity_low": low, "sensitivity_high": high, "specificity_low": low2, "specificity_high": high2})


def summarise_thresholds(scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    return with_intervals(confusion_at_thresholds(scores, thresholds))


def robustness(scores: DataFrame, cutoffs: DataFrame, delta: float = 5.0) -> DataFrame:
    """Summaries at each family's cutoff and delta below and above it; step tells which."""
    checks.finite_number(delta, "delta", 0)
    shifted = cutoffs.select("family", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("step"), "threshold")
    return summarise_thresholds(scores, shifted.select("family", "step", (F.col("threshold") + F.col("step") * float(delta)).alias("threshold")))


def score_distribution(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Number, least, exact median, exactly rounded mean and greatest score of each group.

    Equal scores are counted first; the median is where running counts over physical partitions pass the middle, so a
    group isn't one task. The mean is the exact sum, rounded once, over the number. Null keys are groups of their own.
    """
    counted = scores.groupBy(*keys, (F.col("score").cast("double") + 0.0).alias("score")).agg(F.count("*").alias("n"))
    ranked = prefix_scan(counted, keys, [F.asc("score")], ["n"]).withColumn("group", F.struct(*keys))  # equal structs, also of nulls, join
    about = ranked.groupBy("group").agg(F.sum("n").alias("number_of_scores"), F.min("score").alias("minimum_bit_score_bits"), F.max("score").alias("maximum_bit_score_bits"))
    placed = ranked.join(about.select("group", "number_of_scores"), "group")
    # the places (N - 1) div 2 and N div 2, from zero, lie in one or two neighbouring rows
    holds = lambda place: f"(running_n - n <= {place} and {place} < running_n)"
    middle = placed.filter(f"{holds('(number_of_scores - 1) div 2')} or {holds('number_of_scores div 2')}")
    middle = middle.groupBy("group").agg(((F.min("score") + F.max("score")) / 2).alias("median_bit_score_bits"))
    out = about.join(middle, "group").join(exact_sums(ranked, ["group"], "score", "_total", "n"), "group")
    mean = mean_of(F.col("_total"), F.col("number_of_scores")).alias("mean_bit_score_bits")
    return out.select("group.*", "number_of_scores", "minimum_bit_score_bits", "median_bit_score_bits", mean, "maximum_bit_score_bits")


def class_counts(scores: DataFrame, labels: tuple[str, ...] = ("positive", "hard_negative", "easy_negative", "negative")) -> DataFrame:
    """One row for each family with a count for every label, zero where there is none."""
    return scores.groupBy("family").agg(*(F.sum((F.col("class_label") == x).cast("long")).alias(x) for x in labels))


def best_profile_scores(hits: DataFrame, targets: DataFrame) -> DataFrame:
    """target_id, score, had_hit: the greatest score of each target, not below zero, which also stands for no hit."""
    best = hits.groupBy("target_id").agg(F.max("score").alias("best"))
    return targets.select("target_id").join(best, "target_id", "left").select("target_id", F.greatest(F.coalesce("best", F.lit(0.0)), F.lit(0.0)).alias("score"), F.col("best").isNotNull().alias("had_hit"))


def checked_best_scores(hits: DataFrame, targets: DataFrame) -> DataFrame:
    checks.require_unique(targets, "target_id", "expected target")
    stray = hits.join(targets, "target_id", "left_anti").agg(F.min("target_id")).first()[0]
    if stray is not None:
        raise checks.InputError(f"unexpected target: {stray}")
    return best_profile_scores(hits, targets)


def without_domain(scores: DataFrame) -> DataFrame:
    """Numbers of positives and negatives with a score of zero, for each family."""
    none = (F.col("score") == 0.0).cast("long")
    return scores.groupBy("family").agg(F.sum(F.when(F.col("is_positive"), none).otherwise(0)).alias("positives_without_domain"), F.sum(F.when(~F.col("is_positive"), none).otherwise(0)).alias("negatives_without_domain"))


def _nested(row: dict) -> dict:
    out = {k: row[k] for k in ("bit_score_threshold_bits", *COUNTS, *RATES)}
    if "sensitivity_low" in row:
        out["sensitivity_wilson_95_interval"] = [row["sensitivity_low"], row["sensitivity_high"]]
        out["specificity_wilson_95_interval"] = [row["specificity_low"], row["specificity_high"]]
        out["number_of_positive_references"], out["number_of_negative_references"] = row["positives"], row["negatives"]
    return out


def calibration_reports(scores: DataFrame, comparison: float | None = None, delta: float = 5.0, curve: DataFrame | None = None) -> DataFrame:
    """One row for each family that has both classes: roc_auc, selected_cutoff, robustness (at the cutoff, delta below and
    above), the score distributions of both classes and comparison (null without a threshold to compare with)."""
    value = None if comparison is None else checks.finite_number(comparison, "comparison threshold")
    curve = roc_curve(scores) if curve is None else curve
    cutoffs = zero_false_positive_cutoff(curve)
    steps = robustness(scores, cutoffs, delta)
    row = F.struct("step", *(c for c in steps.columns if c not in ("family", "step")))
    tried = steps.groupBy("family").agg(F.array_sort(F.collect_list(row)).alias("robustness"))  # of three
    spread = score_distribution(scores, ["family", "is_positive"])
    own = F.struct(*(c for c in spread.columns if c not in ("family", "is_positive")))
    spread = spread.groupBy("family").agg(F.max(F.when(F.col("is_positive"), own)).alias("positive_scores"), F.max(F.when(~F.col("is_positive"), own)).alias("negative_scores"))
    at = summarise_thresholds(scores, cutoffs.select("family", F.lit(value).cast("double").alias("threshold")).filter("threshold is not null"))
    at = at.select("family", F.struct(*(c for c in at.columns if c != "family")).alias("comparison"))
    out = roc_auc(curve).join(tried, "family").join(spread, "family").join(at, "family", "left")
    return out.select("family", "roc_auc", F.element_at("robustness", 2).alias("selected_cutoff"), "robustness", "positive_scores", "negative_scores", "comparison")


def calibration_report(scores: DataFrame, family: str, comparison: float | None = None, delta: float = 5.0) -> dict:
    """The report of one family as plain values: its rows are thresholds, not scores of targets."""
    own = scores.filter(F.col("family") == family)
    for positive, what in ((True, "positive"), (False, "negative")):
        if own.filter(F.col("is_positive") == positive).isEmpty():
            raise checks.InputError(f"no {what} scores for {family}")
    checks.require_scores(own)
    curve = roc_curve(own).persist()
    found = calibration_reports(own, comparison, delta, curve).first().asDict(recursive=True)
    report = {
        "selection_rule": SELECTION_RULE,
        "scope": SCOPE,
        "receiver_operating_characteristic_auc": found["roc_auc"],
        "positive_score_distribution": found["positive_scores"],
        "negative_score_distribution": found["negative_scores"],
        "selected_cutoff": _nested(found["selected_cutoff"]),
        "robustness": [_nested(r) for r in found["robustness"]],
        "curve": [_nested({k: r[k] for k in CURVE}) for r in curve.orderBy("bit_score_threshold_bits").collect()],
    }
    curve.unpersist()
    return report | ({} if comparison is None else {"comparison_threshold": _nested(found["comparison"])})
