import bisect
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from seqcal.operators import calibration as C
from seqcal.operators.checks import InputError


def scores(spark, positives, negatives, family="alpha"):
    return spark.createDataFrame([(family, float(s), True) for s in positives] + [(family, float(s), False) for s in negatives], "family string, score double, is_positive boolean")


def at(spark, threshold, family="alpha"):
    return spark.createDataFrame([(family, float(threshold))], "family string, threshold double")


def counts(row):
    return tuple(row[c] for c in C.COUNTS)


def test_threshold_is_inclusive(spark):
    (row,) = C.confusion_at_thresholds(scores(spark, [9, 7, 5], [8, 6, 2]), at(spark, 6)).collect()
    assert counts(row) == (2, 1, 2, 1)


def test_step_lookup_takes_the_next_threshold_up(spark):
    curve = C.roc_curve(scores(spark, [10, 20], [5, 7]))
    (row,) = C.confusion_from_curve(curve, at(spark, 7.6).withColumnRenamed("threshold", "wanted_threshold")).collect()
    assert row.bit_score_threshold_bits == 10.0 and counts(row)[0] == 2 and counts(row)[2] == 0


def test_lookup_equals_direct_counts(spark):
    s = scores(spark, [3, 11, 19], [2, 8, 14])
    (a,) = C.confusion_from_curve(C.roc_curve(s), at(spark, 8.25).withColumnRenamed("threshold", "wanted_threshold")).collect()
    (b,) = C.confusion_at_thresholds(s, at(spark, 8.25)).collect()
    assert counts(a) == counts(b)


def test_cutoff_and_area(spark):
    curve = C.roc_curve(scores(spark, [5, 9, 12], [1, 4, 8]))
    assert C.zero_false_positive_cutoff(curve).first().threshold == 9.0
    assert C.roc_auc(curve).first().roc_auc == pytest.approx(8 / 9)


def test_cutoff_above_every_score_if_the_best_is_negative(spark):
    both = scores(spark, [1, 5], [5])
    curve = C.roc_curve(both)
    cut = C.zero_false_positive_cutoff(curve)
    assert cut.first().threshold == math.nextafter(5.0, math.inf)
    # the thresholds come from the same frame as the scores, and no score reaches them
    (row,) = C.summarise_thresholds(both, cut).collect()
    assert counts(row) == (0, 2, 0, 1)


def brute_curve(pos, neg):
    observed = sorted(set(pos) | set(neg))
    out = {}
    for t in [math.nextafter(observed[0], -math.inf), *observed, math.nextafter(observed[-1], math.inf)]:
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        out[t] = (tp, len(pos) - tp, fp, len(neg) - fp)
    return out


def brute_area(curve, p, n):
    points = sorted({(fp / n, tp / p) for tp, _, fp, _ in curve.values()})
    return sum((x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in zip(points, points[1:]))


@pytest.mark.parametrize("seed", range(3))
def test_curves_and_areas_against_brute_force_with_ties(spark, seed):
    rng = random.Random(seed)
    families = {f: ([round(rng.gauss(3, 2), 1) for _ in range(rng.randint(1, 120))], [round(rng.gauss(2, 2), 1) for _ in range(rng.randint(1, 120))]) for f in "abc"}
    df = None
    for f, (p, n) in families.items():
        own = scores(spark, p, n, f)
        df = own if df is None else df.union(own)
    for parts in (1, 7):
        curve = C.roc_curve(df.repartition(parts)).persist()
        area = {r.family: r.roc_auc for r in C.roc_auc(curve).collect()}
        for f, (p, n) in families.items():
            expected = brute_curve(p, n)
            got = {r.bit_score_threshold_bits: counts(r) for r in curve.filter(curve.family == f).collect()}
            assert {t + 0.0: c for t, c in expected.items()} == got
            assert area[f] == pytest.approx(brute_area(expected, len(p), len(n)), abs=1e-12)


def test_wilson_interval(spark):
    low, high = C.wilson(F.lit(0), F.lit(453))
    row = spark.range(1).select(low.alias("low"), high.alias("high")).first()
    assert row.low == 0.0 and row.high == pytest.approx(0.008408, abs=1e-6)


def test_summary_counts_and_sizes(spark):
    (row,) = C.summarise_thresholds(scores(spark, [12, 10, 4], [7, 3]), at(spark, 8)).collect()
    assert counts(row) == (2, 1, 0, 2) and (row.positives, row.negatives) == (3, 2) and 0 <= row.sensitivity_low <= row.sensitivity <= row.sensitivity_high <= 1


def test_report(spark):
    report = C.calibration_report(scores(spark, [12, 10, 7], [6, 3, 1]), "alpha", comparison=8, delta=2)
    assert report["selected_cutoff"]["bit_score_threshold_bits"] == 7.0
    assert [r["bit_score_threshold_bits"] for r in report["robustness"]] == [5.0, 7.0, 9.0]
    assert report["comparison_threshold"]["correctly_detected_positives"] == 2
    assert len(report["curve"]) == 8 and report["receiver_operating_characteristic_auc"] == 1.0
    for bad in ({"delta": -1}, {"delta": math.nan}, {"comparison": math.inf}):
        with pytest.raises(InputError):
            C.calibration_report(scores(spark, [2], [1]), "alpha", **bad)
    for p, n in (([], [1]), ([1], []), ([math.nan, 2], [1])):
        with pytest.raises(InputError):
            C.calibration_report(scores(spark, p, n), "alpha")


def test_reports_of_several_families_in_one_job(spark):
    both = scores(spark, [12, 10, 7], [6, 3, 1]).union(scores(spark, [5, 9, 12], [1, 4, 8], "beta")).union(scores(spark, [1], [], "gamma"))
    got = {r.family: r for r in C.calibration_reports(both, 8, 2).collect()}
    assert set(got) == {"alpha", "beta"}
    for family, row in got.items():
        one = C.calibration_report(both, family, 8, 2)
        assert row.roc_auc == one["receiver_operating_characteristic_auc"] and row.comparison.correctly_detected_positives == one["comparison_threshold"]["correctly_detected_positives"]
        assert [r.bit_score_threshold_bits for r in row.robustness] == [r["bit_score_threshold_bits"] for r in one["robustness"]]
        assert row.positive_scores.asDict() == one["positive_score_distribution"]
    assert C.calibration_reports(both).filter("comparison is not null").isEmpty()


def test_counts_and_lookups_at_many_thresholds(spark):
    rng = random.Random(3)
    families = {f: ([round(rng.gauss(3, 2), 3) for _ in range(700)], [round(rng.gauss(2, 2), 3) for _ in range(700)]) for f in "ab"}
    df = scores(spark, *families["a"], "a").union(scores(spark, *families["b"], "b"))
    wanted = spark.range(100_000).selectExpr("explode(array('a', 'b', 'none')) AS family", "id / 10000e0 - 3e0 AS threshold", "id").selectExpr("family", "cast(threshold AS double) AS threshold", "id")
    direct = C.confusion_at_thresholds(df, wanted).collect()
    curve = C.roc_curve(df)
    looked_up = C.confusion_from_curve(curve, wanted.select("family", F.col("threshold").alias("wanted_threshold")).union(wanted.select("family", F.lit(1e9).alias("t")))).collect()
    assert len(direct) == 200_000 and len(looked_up) == 200_002
    ordered = {f: (sorted(p), sorted(n)) for f, (p, n) in families.items()}
    for r in direct:
        p, n = (len(x) - bisect.bisect_left(x, r.bit_score_threshold_bits) for x in ordered[r.family])
        assert counts(r) == (p, 700 - p, n, 700 - n) and r.bit_score_threshold_bits == r.id / 10000.0 - 3.0
    stored = {f: sorted(brute_curve(*x)) for f, x in families.items()}
    for r in looked_up:
        at = bisect.bisect_left(stored[r.family], r.wanted_threshold)
        assert r.bit_score_threshold_bits == stored[r.family][min(at, len(stored[r.family]) - 1)]


def test_distributions_against_plain_statistics(spark):
    rng = random.Random(9)
    groups = {(f, y): [rng.choice([rng.gauss(0, 1), 1e16, -1e16, 0.1, -0.0, 5e-324]) for _ in range(n)] for f, y, n in (("a", 1, 300), ("a", None, 51), (None, 2, 4), ("b", 1, 1))}
    df = spark.createDataFrame([(f, y, s) for (f, y), own in groups.items() for s in own], "family string, year int, score double")
    got = {(r.family, r.year): tuple(r)[2:] for r in C.score_distribution(df.repartition(5), ["family", "year"]).collect()}
    assert got == {k: (len(v), min(v), statistics.median(v), statistics.fmean(v), max(v)) for k, v in groups.items()}


def test_distribution(spark):
    row = C.score_distribution(scores(spark, [1, 4, 8, 20], []), ["family"]).first()
    assert (row.number_of_scores, row.median_bit_score_bits, row.mean_bit_score_bits) == (4, 6.0, 8.25)


def test_best_scores(spark):
    hits = spark.createDataFrame([("a", 14.0), ("a", 17.5), ("c", -2.0)], "target_id string, score double")
    targets = spark.createDataFrame([("a",), ("b",), ("c",)], "target_id string")
    assert {r.target_id: (r.score, r.had_hit) for r in C.checked_best_scores(hits, targets).collect()} == {"a": (17.5, True), "b": (0.0, False), "c": (0.0, True)}
    with pytest.raises(InputError):
        C.checked_best_scores(hits, targets.union(targets))
    with pytest.raises(InputError):
        C.checked_best_scores(hits, targets.filter("target_id <> 'c'"))
