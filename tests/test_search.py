import math
import random

import numpy as np
import pytest

from seqcal.operators import profiles as calibrate
from seqcal.operators.checks import InputError
from seqcal.search import kernel, model

LETTERS = model.RESIDUES


def small_profile(rng, m):
    match = np.array([rng.dirichlet(np.ones(20)) for _ in range(m)])
    moves = np.zeros((m + 1, 7))
    for k in range(m + 1):
        moves[k, :3], moves[k, 3:5], moves[k, 5:] = rng.dirichlet([5, 1, 1]), rng.dirichlet([1, 1]), rng.dirichlet([1, 1])
    return model.Profile("p", match, moves, -3.0, 0.7)


def all_paths(p, sequence):
    """(log-probability, domains) of every path, by plain recursion over states."""
    c = kernel.Compiled(p)
    m, n = p.match_states, len(sequence)
    stay, leave, _ = kernel.length_model(float(n))
    half = math.log(0.5)
    lp = np.log(p.moves)
    out = []

    def core(kind, k, i, score, start, done):
        """In state kind of node k (0-based) with i letters read."""
        if kind in "MD":
            out_of(i, score, (*done, (*start, i - 1, k)))
        if kind == "M":
            nexts = [("M", k + 1, model.MM), ("I", k, model.MI), ("D", k + 1, model.MD)]
        elif kind == "I":
            nexts = [("M", k + 1, model.IM), ("I", k, model.II)]
        else:
            nexts = [("M", k + 1, model.DM), ("D", k + 1, model.DD)]
        for to, at, move in nexts:
            if at >= m or to == "I" and at == m - 1 or to != "D" and i >= n:
                continue
            gain = lp[k + 1, move] + (c.letters[sequence[i], at] if to == "M" else 0.0)
            core(to, at, i + (to != "D"), score + gain, start, done)

    def begin(i, score, done):
        for k in range(m if i < n else 0):
            core("M", k, i + 1, score + c.enter[k] + c.letters[sequence[i], k], (i, k), done)

    def out_of(i, score, done):
        out.append((score + half + (n - i) * stay + leave, done))
        for j in range(i, n):
            begin(j, score + half + (j - i) * stay + leave, done)

    for j in range(n):
        begin(j, j * stay + leave, ())
    return out


@pytest.mark.parametrize("seed", range(6))
def test_forward_and_viterbi_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    p = small_profile(rng, int(rng.integers(1, 4)))
    text = "".join(rng.choice(list(LETTERS), 5))
    coded = np.frombuffer(text.encode(), np.uint8).astype(np.int64) - 65
    paths = all_paths(p, coded)
    null = kernel.length_model(float(len(text)))[2]
    total = np.logaddexp.reduce([s for s, _ in paths])
    c = kernel.Compiled(p)
    assert kernel.forward_bits(c, [coded])[0] == pytest.approx((total - null) / math.log(2), abs=1e-9)
    best = max(paths, key=lambda x: x[0])
    found = tuple((a, k, b, e) for a, b, k, e in kernel.viterbi_domains(c, coded))
    assert found in {d for s, d in paths if s > best[0] - 1e-9}


def test_batches_do_not_change_scores():
    rng = np.random.default_rng(9)
    c = kernel.Compiled(small_profile(rng, 6))
    coded = sorted((rng.choice([ord(x) - 65 for x in LETTERS], n) for n in (40, 3, 17, 17, 1)), key=lambda s: -len(s))
    assert np.allclose(kernel.forward_bits(c, coded), [kernel.forward_bits(c, [s])[0] for s in coded])


def test_profile_files(tmp_path):
    rng = np.random.default_rng(3)
    p = small_profile(rng, 4)
    text = model.format_profile(p) + model.format_profile(model.Profile("GH13.hmm", p.match, p.moves, -2.0, 0.6))
    a, b = model.parse_profiles(text)
    assert (a.name, b.name, b.mu) == ("p", "GH13", -2.0) and np.allclose(a.match, p.match, atol=1e-4) and np.allclose(a.moves, p.moves, atol=1e-4)
    assert [x.name for x in model.parse_profiles(text, ["GH13", "p"])] == ["p", "GH13"]
    for bad, names in ((text + text, ["p"]), (text, ["x"]), (text, []), (text, ["p", "p"]), ("", None), ("junk", None), (text.replace("LENG  4", "LENG  9"), None)):
        with pytest.raises(InputError):
            model.parse_profiles(bad, names)


def frame(spark, rows):
    return spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(rows)], "ordinal long, target_id string, sequence string")


def planted(n=40):
    rng = random.Random(1)
    any_ = lambda k: "".join(rng.choice(LETTERS) for _ in range(k))
    return [(f"t{i}", any_(rng.randint(20, 90)) + ("MWKCHYWDPFW" if i % 4 == 0 else "") + any_(30)) for i in range(n)]


def test_search_finds_planted_motifs_and_ignores_partitions(spark):
    p = model.consensus_profile("motif", "MWKCHYWDPFW")
    rows = [sorted(tuple(r) for r in kernel.scan_records(frame(spark, planted()).repartition(k), kernel.NumpyBackend([p]), independent_evalue=1e-2, coverage=0.9, search_space=40.0).collect()) for k in (1, 7)]
    assert rows[0] == rows[1] and {r[1] for r in rows[0]} == {f"t{i}" for i in range(0, 40, 4)}
    wide = kernel.scan_records(frame(spark, planted()), kernel.NumpyBackend([p]), independent_evalue=1.0, coverage=0.9, search_space=400.0).collect()
    by_target = {r.target_id: r for r in wide}
    for r in rows[0]:
        assert by_target[r[1]].independent_domain_evalue == pytest.approx(10 * r[3]) and by_target[r[1]].domain_bit_score_bits == pytest.approx(r[4])
    for bad in ([], [("a", "M"), ("a", "K")], [("a", "M1")]):
        with pytest.raises(InputError):
            kernel.scan_records(frame(spark, bad), kernel.NumpyBackend([p]), search_space=1.0)
    raw = kernel.search_frame(frame(spark, planted()), [p], {"Z": 40.0, "iE": 1e-2, "coverage": 0.9})
    again = kernel.scan_records(frame(spark, planted()), kernel.PrecomputedDomains(raw), independent_evalue=1e-2, coverage=0.9, search_space=40.0)
    assert sorted(tuple(r) for r in again.collect()) == rows[0]


def test_profile_calibration(spark):
    import hashlib

    p = model.consensus_profile("motif", "MWKCHYWDPFW")
    rows = [("positive" if i % 4 == 0 else "hard_negative" if i % 2 else "easy_negative", i, n, ["GH13"], s, hashlib.sha256(s.encode()).hexdigest()) for i, (n, s) in enumerate(planted())]
    classes = spark.createDataFrame(rows, "class_label string, slot long, accession string, tags array<string>, sequence string, sequence_sha256 string")
    report = calibrate.calibrate_profile(classes, p, kernel.NumpyBackend([p]), 40.0)
    assert report["receiver_operating_characteristic_auc"] > 0.95 and report["reference_class_counts"] == {"positive": 10, "hard_negative": 20, "easy_negative": 10}
    for bad in (classes.filter("class_label = 'positive'"), classes.filter("class_label <> 'positive'")):
        with pytest.raises(InputError):
            calibrate.calibrate_profile(bad, p, kernel.NumpyBackend([p]), 40.0)
    with pytest.raises(InputError):
        calibrate.calibrate_profile(classes, p, kernel.NumpyBackend([p]), 40.0, family="other")


def plain_forward(p, sequence):
    """Forward bits of one pair in logarithms, state by state."""
    c, (stay, leave, null) = kernel.Compiled(p), kernel.length_model(float(len(sequence)))
    m, plus = p.match_states, np.logaddexp
    match, insert = [kernel.LOW] * m, [kernel.LOW] * m
    delete, flank, join, close = [kernel.LOW] * m, 0.0, kernel.LOW, kernel.LOW
    for letter in sequence:
        begin = plus(flank, join) + leave
        fresh = [begin + c.enter[0]] + [plus(plus(match[k] + c.mm[k], insert[k] + c.im[k]), plus(delete[k] + c.dm[k], begin + c.enter[k + 1])) for k in range(m - 1)]
        insert = [plus(match[k] + c.mi[k], insert[k] + c.ii[k]) for k in range(m)]
        match = [fresh[k] + c.letters[letter, k] for k in range(m)]
        delete = [kernel.LOW]
        for k in range(m - 1):
            delete.append(plus(match[k] + c.md[k], delete[k] + c.dd[k + 1] - c.dd[k]))
        end = plus(np.logaddexp.reduce(match), np.logaddexp.reduce(delete)) + math.log(0.5)
        flank, join, close = flank + stay, plus(join + stay, end), plus(close + stay, end)
    return (close + leave - null) / math.log(2)


def test_pairs_of_many_sizes_side_by_side():
    rng = np.random.default_rng(4)
    profiles = [small_profile(rng, m) for m in (7, 1, 3, 30, 5, 2)] + [model.consensus_profile("w", "W" * 12)]
    coded = sorted((rng.choice([ord(x) - 65 for x in LETTERS + "BX"], n) for n in (1, 2, 9, 60, 60, 33)), key=lambda s: -len(s))
    coded = [np.full(400, ord("W") - 65), *coded]  # far beyond what a double holds
    stack = kernel.Stack([kernel.Compiled(p) for p in profiles])
    bits = kernel.stack_bits(stack, coded)
    assert bits.max() > 1100
    for c, row in zip(stack.compiled, bits, strict=True):
        assert row == pytest.approx([plain_forward(c.profile, s) for s in coded], abs=1e-8)
    pairs = [(c, s) for s in coded for c in stack.compiled]
    assert kernel.pair_domains([c for c, _ in pairs], [s for _, s in pairs]) == [kernel.viterbi_domains(c, s) for c, s in pairs]
    some = sorted(((c, s, a, b) for c, s in pairs for a, b, _, _ in kernel.viterbi_domains(c, s)), key=lambda x: x[2] - x[3])
    scores = kernel.segments_bits([c for c, *_ in some], [s[a : b + 1] for _, s, a, b in some], np.array([len(s) for _, s, _, _ in some]))
    assert scores.tolist() == [kernel.segment_bits(*x) for x in some]


def test_cost_of_a_pair_is_small():
    rng, clock = random.Random(2), __import__("time").process_time
    texts = ["".join(rng.choice(LETTERS) for _ in range(400)) for _ in range(250)]
    names = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(4, 13))) for _ in range(25)]
    (stack,) = kernel.stacks([kernel.Compiled(model.consensus_profile(n, n)) for n in names])
    start = clock()
    assert kernel.search_batch(texts, texts, stack, {"Z": 25.0, "iE": 10.0, "coverage": 0.0})
    assert clock() - start < 6  # a step of Python for each letter and hit took over 20 s


def test_models_of_one_partition_are_written_by_many_tasks(spark):
    from seqcal.sources import profiles

    rows = spark.createDataFrame([(f"p{i}", "MWKC") for i in range(200)], "name string, letters string").coalesce(1)
    texts = profiles.written_models(rows)
    assert sum(n > 0 for n in texts.rdd.glom().map(len).collect()) >= 8  # a file of one row group went through one task
    assert {r.value for r in texts.collect()} == {model.format_profile(model.consensus_profile(f"p{i}", "MWKC")).removesuffix("\n") for i in range(200)}
