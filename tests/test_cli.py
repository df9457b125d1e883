import csv
import json

import pytest

from pyspark.sql import functions as F

from seqcal.cli import main
from seqcal.operators import checks, classify, hits
from seqcal.search import model

from .test_search import planted


def rows(path):
    return list(csv.DictReader(open(path), delimiter="\t"))


def table(path, *lines):
    path.write_text("\n".join("\t".join(map(str, x)) for x in lines) + "\n")
    return str(path)


def test_calibrate(spark, tmp_path):
    scores = table(
        tmp_path / "s.tsv", ("profile_name", "class_label", "domain_bit_score_bits"), ("alpha", "positive", 12), (" alpha", "Positive ", 10), ("alpha", "hard_negative", 8), ("alpha", "easy_negative", 3), ("beta", "odd", "x")
    )
    out = tmp_path / "o.json"
    assert main(["calibrate-score", "--scores", scores, "--family", "alpha", "--output", str(out), "--comparison-threshold-bits", "8.5"], spark) == 0
    got = json.loads(out.read_text())
    assert got["cutoffs"]["alpha"]["bit_score_threshold_bits"] == 10.0
    assert got["input"]["class_counts"] == {"positive": 2, "hard_negative": 1, "easy_negative": 1, "negative": 0}
    assert got["calibration"]["comparison_threshold"]["incorrectly_accepted_negatives"] == 0
    for family in ("beta", "gamma"):
        with pytest.raises(SystemExit) as stop:
            main(["calibrate-scores", "--scores", scores, "--family", family, "--output", str(tmp_path / "no")], spark)
        assert stop.value.code == 2 and not (tmp_path / "no").exists()


def test_apply(spark, tmp_path):
    found = table(tmp_path / "h.tsv", ("profile_name", "note", "domain_bit_score_bits"), ("alpha", "n1", 10), ("alpha", "n2", 9.9), ("beta", "n3", 90))
    (tmp_path / "c.json").write_text(json.dumps({"cutoffs": {"alpha": 10.0}}))
    out = tmp_path / "o.tsv"
    arguments = ["apply-cutoff", "--hits", found, "--cutoffs", str(tmp_path / "c.json"), "--output"]
    assert main([*arguments, str(out)], spark) == 0
    assert [(r["note"], r[classify.CUTOFF_COLUMN], r[classify.CLASS_COLUMN]) for r in rows(out)] == [("n1", "10.0", classify.PASSES), ("n2", "10.0", classify.BELOW), ("n3", "", classify.UNCALIBRATED)]
    for bad in ([*arguments, str(tmp_path / "no"), "--require-calibrated"], [*arguments, found]):
        with pytest.raises(SystemExit) as stop:
            main(bad, spark)
        assert stop.value.code == 2 and not (tmp_path / "no").exists()


def test_checks_ride_on_the_staged_table(spark, tmp_path, capsys):
    """The first bad record is named, nothing is written, and the hits are read once."""
    (tmp_path / "c.json").write_text(json.dumps({"cutoffs": {"alpha": 10.0}}))
    for rows_, said in (
        ([("alpha", 10), ("alpha", "x"), ("alpha", "nan")], "record 3 has a score that is no number"), ([("alpha", "inf"), ("alpha", 1)], "record 2 has a score that is not finite"),
        ([("alpha", "x"), (" ", 1)], "record 3 has no profile_name"), ([("alpha", 1), ("beta", 1), ("gamma", 2)], "record 3 has a profile without a supplied cutoff"),
    ):
        found = table(tmp_path / "h.tsv", ("profile_name", "domain_bit_score_bits"), *rows_)
        with pytest.raises(SystemExit) as stop:
            main(["apply-cutoff", "--hits", found, "--cutoffs", str(tmp_path / "c.json"), "--output", str(tmp_path / "no"), "--require-calibrated"], spark)
        assert stop.value.code == 2 and not (tmp_path / "no").exists() and said in capsys.readouterr().err
    df = spark.range(10).withColumn("n", F.col("id") * 2)
    kept = checks.staged(df, [F.when(F.col("id") > 10, "too much")], "id")
    assert kept.count() == 10 and "parquet" in kept._jdf.queryExecution().executedPlan().toString().lower()


def test_scan(spark, tmp_path):
    fasta, library, out = tmp_path / "p.fasta", tmp_path / "l.hmm", tmp_path / "hits.tsv"
    fasta.write_text("".join(f">{n} text\n{s}\n" for n, s in planted(12)))
    library.write_text(model.format_profile(model.consensus_profile("motif", "MWKCHYWDPFW")))
    arguments = ["scan", "--proteins", str(fasta), "--hmms", str(library), "--output", str(out), "--evalue-search-space", "12", "--independent-domain-evalue-threshold", "0.01"]
    assert main(arguments, spark) == 0
    got = rows(out)
    assert list(got[0]) == hits.HIT_COLUMNS and [r["target_id"] for r in got] == ["t0", "t4", "t8"]
    manifest = json.loads((tmp_path / "hits.manifest.json").read_text())
    assert manifest["output"]["number_of_retained_domain_hits"] == 3 and manifest["inputs"]["protein_fasta"]["sequence_free_summary"]["number_of_records"] == 12
    for bad in ([*arguments[:-2], "--profile", "x"], [*arguments, "--minimum-hmm-coverage-percent", "101"], [*arguments, "--cpus", "-1"], [*arguments[:5], str(fasta), *arguments[7:]]):
        with pytest.raises(SystemExit):
            main(bad, spark)
    fasta.write_text(">a\nMK*\n")
    with pytest.raises(SystemExit):
        main(arguments, spark)


def test_bad_fasta_ends_with_status_2(spark, tmp_path):
    (tmp_path / "p.fasta").write_text("MK\n>a\nM\n")
    (tmp_path / "m.hmm").write_text(model.write_profiles([planted()[0]]) if hasattr(model, "write_profiles") else "HMMER3/f\n")
    with pytest.raises(SystemExit) as stop:
        main(["scan", "--proteins", str(tmp_path / "p.fasta"), "--hmms", str(tmp_path / "m.hmm"), "--output", str(tmp_path / "o.tsv"), "--evalue-search-space", "1"], spark)
    assert stop.value.code == 2 and not (tmp_path / "o.tsv").exists()


def test_audit_command(spark, tmp_path, capsys):
    (tmp_path / "fine.py").write_text("x = 1\n")
    assert main(["audit-tree", str(tmp_path)], spark) == 0
    (tmp_path / "data.fasta").write_text(">a\nM\n")
    assert main(["audit-tree", str(tmp_path)], spark) == 1
    assert "data.fasta: " in capsys.readouterr().err


def test_package_exports(spark):
    import seqcal

    scores = spark.createDataFrame([("a", float(s), p) for s, p in ((9, True), (7, True), (5, True), (8, False), (6, False), (2, False))], "family string, score double, is_positive boolean")
    row = seqcal.confusion_at_threshold(scores, 6).first()
    assert (row.correctly_detected_positives, row.missed_positives, row.incorrectly_accepted_negatives, row.correctly_rejected_negatives) == (2, 1, 2, 1)
    assert seqcal.select_zero_observed_false_positive_cutoff(seqcal.roc_curve(scores)).first().threshold == 9.0
    assert seqcal.DomainHit(*range(12)).profile_name == 0
    assert all(callable(getattr(seqcal, x)) for x in seqcal.__all__)
