import math
import random

import numpy as np
import pytest

from seqcal.operators import classify, hits as H, overlap
from seqcal.operators.checks import InputError, search_options


def raw(spark, rows):
    """rows: (i_evalue, score, from, to) of profiles with 100 states."""
    data = [(i, " alpha.hmm", "t1", 1e6 if i == 1 else 1e-9, 500, e, s, a, b, 100, 1, 50, 500) for i, (e, s, a, b) in enumerate(rows)]
    return spark.createDataFrame(data, "ordinal long, " + H.RAW_DOMAIN)


def test_both_limits_are_inclusive_and_target_evalue_does_not_filter(spark):
    df = raw(spark, [(1e-20, 73.25, 1, 40), (1e-15, 60.0, 1, 35), (1e-4, 90.0, 1, 90), (1e-30, 50.0, 1, 20)])
    got = H.checked_domain_hits(df).orderBy("hmm_end_match_state").collect()
    assert [(r.profile_name, r.hmm_alignment_coverage_fraction) for r in got] == [("alpha", 0.35), ("alpha", 0.4)]


def test_coordinates_of_dropped_domains_are_not_checked(spark):
    assert H.checked_domain_hits(raw(spark, [(1.0, 1.0, 50, 10)])).count() == 0
    for bad in [(1e-20, 1.0, 50, 10), (1e-20, 1.0, 1, 101), (-1.0, 1.0, 1, 50), (1e-20, math.nan, 1, 50)]:
        with pytest.raises(InputError):
            H.checked_domain_hits(raw(spark, [bad]))


def test_percent_column(spark):
    rows = H.hit_rows(H.domain_hits(raw(spark, [(1e-20, 7.0, 1, 80)])))
    assert rows.columns == H.HIT_COLUMNS and rows.first().hmm_alignment_coverage_percent == 80.0


@pytest.mark.parametrize("bad", [{"target_evalue": 0}, {"domain_evalue": -1}, {"independent_evalue": math.inf}, {"coverage": 1.1}, {"coverage": math.nan}, {"search_space": 0}, {"cpus": -1}, {"cpus": True}, {"search_space": None}])
def test_search_parameters(bad):
    with pytest.raises(InputError):
        search_options(**({"search_space": 10.0} | bad))


def hits(spark, rows):
    return spark.createDataFrame(rows, "target_id string, start long, end long, evalue double, score double, coverage double, ordinal long, profile_name string")


def test_overlap_of_shorter(spark):
    df = hits(spark, [("t", 10, 20, 1.0, 0.0, 0.0, 0, "a"), ("t", 20, 29, 1.0, 0.0, 0.0, 1, "b"), ("u", 10, 20, 1.0, 0.0, 0.0, 2, "a")])
    assert [tuple(r) for r in overlap.overlapping_pairs(df).collect()] == [(0, 1, 0.1)]


def test_weaker_of_two_overlapping_domains_goes(spark):
    df = hits(spark, [("t", 10, 30, 1e-10, 0.0, 0.0, 0, "a"), ("t", 60, 80, 1e-12, 0.0, 0.0, 1, "b"), ("t", 12, 32, 1e-30, 0.0, 0.0, 2, "c")])
    assert sorted(r.ordinal for r in overlap.distinct_domains(df).collect()) == [1, 2]


def brute(rows, most=0.5):
    kept = []
    for r in sorted(rows, key=lambda r: (r[3], -(r[4] or 0.0), -(r[5] or 0.0), r[1], r[2], r[6])):
        for k in kept:
            if (k[0] or "") == (r[0] or "") and max(0, min(k[2], r[2]) - max(k[1], r[1]) + 1) / min(k[2] - k[1] + 1, r[2] - r[1] + 1) > most:
                break
        else:
            kept.append(r)
    return sorted(k[6] for k in kept)


@pytest.mark.parametrize("most", [0.0, 0.5, 1.0])
def test_suppression_against_brute_force(spark, most):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        start = rng.randint(1, 300)
        rows.append((rng.choice(["a", "b", "c", None]), start, start + rng.randint(0, 60), rng.choice([1e-9, 1e-8, 1e-7]), rng.choice([None, 1.0, 2.0]), rng.choice([None, 0.5]), i, "p"))
    for parts in (1, 7):
        assert sorted(r.ordinal for r in overlap.distinct_domains(hits(spark, rows).repartition(parts), most).collect()) == brute(rows, most)
    found = {(r.first, r.second) for r in overlap.overlapping_pairs(hits(spark, rows), most).collect()}
    named = [r for r in rows if r[0]]
    share = lambda x, y: max(0, min(x[2], y[2]) - max(x[1], y[1]) + 1) / min(x[2] - x[1] + 1, y[2] - y[1] + 1)
    assert found == {(x[6], y[6]) for x in named for y in named if x[0] == y[0] and x[6] < y[6] and share(x, y) > most}


@pytest.mark.parametrize("region,kind", [(16, "random"), (64, "random"), (512, "random"), (16, "chain"), (32, "long"), (16, "stacked")])
def test_suppression_of_a_target_over_many_regions(spark, region, kind):
    """All hits lie on one target, and no task holds them: see the rows of a region."""
    rng = random.Random(region)
    rows = []
    for i in range(600):
        start, length, e = rng.randint(1, 4000), rng.randint(1, 60), 10.0 ** -rng.randint(1, 9)
        if kind == "chain":  # each hit overlaps the next, and the best come first
            start, length, e = 1 + 5 * i, 12, 1e-3 * (i + 1)
        elif kind == "long":
            length = rng.choice([3, 50, 1000, 3500])
        elif kind == "stacked":
            start, length = rng.randint(1, 30), rng.randint(1, 30)
        rows.append(("t", start, start + length - 1, e, rng.choice([None, 1.0]), 0.5, i, "p"))
    for most in (0.0, 0.3):
        got = overlap.distinct_domains(hits(spark, rows), most, region)
        assert sorted(r.ordinal for r in got.collect()) == brute(rows, most)


def test_states_of_one_region():
    start, end = np.array([1, 5, 9, 30]), np.array([6, 10, 14, 35])
    one = np.ones(4, dtype=int)
    no = np.zeros(4, dtype=bool)
    same = np.zeros(4, dtype=int)
    assert overlap.decided(same, start, end, one, no, 0.1).tolist() == [overlap.KEPT, overlap.DROPPED, overlap.KEPT, overlap.KEPT]
    across = np.array([2, 1, 1, 1])  # the best one has another region, so its neighbour and that one's wait
    assert overlap.decided(same, start, end, across, no, 0.1).tolist() == [overlap.CLEAR, overlap.WAITING, overlap.WAITING, overlap.KEPT]
    assert overlap.decided(same, start, end, across, np.array([True, False, False, False]), 0.1).tolist() == [overlap.KEPT, overlap.DROPPED, overlap.KEPT, overlap.KEPT]


def test_pairs_on_one_position_are_dealt_to_bounded_tasks(spark, monkeypatch):
    """400 hits start at one position: they are dealt to several ranges, whose blocks meet."""
    monkeypatch.setattr(overlap, "PAIRS", 100)
    rng = random.Random(2)
    rows = [("t", 10, 10 + rng.randint(0, 40), 1.0, 0.0, 0.0, i, "p") for i in range(400)] + [("t", rng.randint(1, 300), 0, 1.0, 0.0, 0.0, i, "p") for i in range(400, 500)] + [("u", 10, 30, 1.0, 0.0, 0.0, 500, "p")]
    rows = [r if r[2] else (*r[:2], r[1] + rng.randint(0, 200), *r[3:]) for r in rows]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    sizes = []
    real = overlap.written
    monkeypatch.setattr(overlap, "written", lambda df, *a, **k: sizes.append(real(df, *a, **k)) or sizes[-1])
    try:
        got = overlap.overlapping_pairs(hits(spark, rows), 0.3).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = sizes[0].groupBy("part").count().collect()
    assert len(parts) > 5 and max(r["count"] for r in parts) < 150
    share = lambda x, y: max(0, min(x[2], y[2]) - max(x[1], y[1]) + 1) / min(x[2] - x[1] + 1, y[2] - y[1] + 1)
    want = {(x[6], y[6]): share(x, y) for x in rows for y in rows if x[0] == y[0] and x[6] < y[6] and share(x, y) > 0.3}
    assert len(got) == len(want) and {(r.first, r.second): r.overlap for r in got} == want
    assert overlap.overlapping_pairs(hits(spark, [])).count() == 0


def test_classification_at_the_boundary(spark):
    df = spark.createDataFrame([(" alpha ", 31.5, "x"), ("alpha", 31.49, "y"), ("beta", 90.0, "z")], "profile_name string, domain_bit_score_bits double, note string")
    cut = spark.createDataFrame([("alpha", 31.5)], "family string, cutoff double")
    got = classify.apply_cutoffs(df, cut)
    assert {r.note: (r[classify.CUTOFF_COLUMN], r[classify.CLASS_COLUMN]) for r in got.collect()} == {"x": (31.5, classify.PASSES), "y": (31.5, classify.BELOW), "z": (None, classify.UNCALIBRATED)}
    assert classify.apply_cutoffs(got, cut).columns == got.columns
    with pytest.raises(InputError):
        classify.require_calibrated(df, cut)
    classify.require_calibrated(df.filter("note <> 'z'"), cut)
