import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqcal.functions import draws, text as T
from seqcal.operators import checks, references as R, sampling
from seqcal.operators.checks import InputError


def headers(spark, rows):
    return spark.createDataFrame([(i, h, s) for i, (h, s) in enumerate(rows)], "ordinal long, header string, sequence string")


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x")).alias("v")).first().v


def test_both_header_layouts(spark):
    got = R.parsed(headers(spark, [(">entry_one|CBM20|GH13", "MK"), (">CBM20|entry_two|GH13_5", "ML"), ("a|CBM20 x", "MV"), (" > CBM1 | x | y ", "MW")])).orderBy("ordinal").collect()
    assert [(r.accession, r.tags) for r in got] == [("entry_one", ["CBM20", "GH13"]), ("entry_two", ["CBM20", "GH13_5"]), ("a", []), ("x|y", ["CBM1"])]
    for bad in (">", "", "a||b", "CBM20|GH13", None):
        assert value(spark, bad, T.header_problem) is not None


def test_normalisation(spark):
    assert value(spark, "m k l\x1c*", T.normalised_sequence) == "MKL"
    assert value(spark, "MK**", T.normalised_sequence) == "MK*"
    assert value(spark, "M1é-1", lambda c: T.invalid_symbols(T.normalised_sequence(c))) == ["-", "1", "É"]
    assert value(spark, "　 x.hmm\t", T.profile_name) == "x" and value(spark, "GH13.hmm.hmm", T.profile_name) == "GH13.hmm"
    for text, number in (("1e-3", 0.001), (" 7 ", 7.0), ("1d", None), ("1f", None), ("x", None), ("inf", float("inf"))):
        assert value(spark, text, T.number) == number


def test_preflight(spark):
    frame = lambda rows: spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(rows)], "ordinal long, target_id string, sequence string")
    assert tuple(checks.inspect_proteins(frame([("a", "MK"), ("b", "MKLV")])).first()) == (2, 6, 2, 4)
    for bad in ([("a", "MK*")], [("a", "M"), ("a", "K")], [], [("a b", "M")], [("", "M")], [("a", "")], [("a", "M1")], [("a", None)]):
        with pytest.raises(InputError):
            checks.inspect_proteins(frame(bad))


def library(n=160):
    tags = ["CBM20", "CBM41", "GH13", "GH5"]
    return [(f">r{i}|{tags[i % 4]}", "M" + "".join("ACDEFGHIKL"[int(d)] for d in f"{i:05d}")) for i in range(n)]


def brute_reservoir(items, size, seed):
    draw, kept = random.Random(seed), []
    for n, x in enumerate(items, 1):
        if len(kept) < size:
            kept.append(x)
        elif (at := draw.randrange(n)) < size:
            kept[at] = x
    return kept


def test_pools_do_not_depend_on_the_order_of_families(spark):
    both = [R.build_pools(headers(spark, library()), f, 9, 11, 7, 42) for f in (["CBM20", "CBM41"], ["CBM41", "CBM20"])]
    rows = [sorted(tuple(r) for r in p.records.collect()) for p in both]
    assert rows[0] == rows[1] and both[0].positive_totals == {"CBM20": 40, "CBM41": 40}
    lib = library()
    expected = {
        "positive:CBM20": brute_reservoir([h for h, _ in lib if h.endswith("CBM20")], 9, "42:positive:CBM20"),
        "hard": brute_reservoir([h for h, _ in lib if not h.endswith("GH5")], 11, "42:hard"),
        "easy": brute_reservoir([h for h, _ in lib if h.endswith("GH5")], 7, "42:easy"),
    }
    for pool, want in expected.items():
        got = sorted((r.slot, r.accession) for r in both[0].records.collect() if r.pool == pool)
        assert [a for _, a in got] == [h[1:].split("|")[0] for h in want]


def test_invalid_sequences(spark):
    rows = [(">a|CBM20", "M1"), (">b|CBM20", "MK")]
    with pytest.raises(InputError):
        R.build_pools(headers(spark, rows), ["CBM20"])
    pools = R.build_pools(headers(spark, rows), ["CBM20"], policy="exclude")
    assert (pools.entries, pools.excluded, pools.unique, pools.positive_totals, pools.positive_unique_totals) == (2, 1, 1, {"CBM20": 1}, {"CBM20": 1})


def test_duplicates_are_merged(spark):
    pools = R.build_pools(headers(spark, [(">a|CBM20", "MK"), (">b|GH13", "mk"), (">c|CBM20", "MV"), (">d|CBM20", "MV")]), ["GH13"])
    assert (pools.unique, pools.duplicate_entries, pools.differing_duplicates) == (2, 2, 1)
    assert [(r.accession, r.tags) for r in pools.records.filter("pool = 'positive:GH13'").collect()] == [("a", ["CBM20", "GH13"])]
    with pytest.raises(InputError):
        R.build_pools(headers(spark, [(">a|CBM20", "MK"), (">a|CBM20", "MV")]), ["CBM20"])


@pytest.mark.parametrize("bad", [{"families": []}, {"families": ["GH13_1"]}, {"families": ["GH13", "GH13"]}, {"positives": 0}, {"seed": True}, {"policy": "skip"}])
def test_pool_parameters(spark, bad):
    with pytest.raises(InputError):
        R.build_pools(headers(spark, library(4)), **({"families": ["GH13"]} | bad))


def test_labelled_set(spark):
    record = lambda pool, slot, name, tags: (pool, slot, name, tags, "M" + name.upper(), hashlib.sha256(("M" + name.upper()).encode()).hexdigest())
    rows = [
        record("positive:CBM20", 0, "p", ["CBM20"]), record("positive:CBM20", 1, "p", ["CBM20"]), record("hard", 0, "p", ["CBM20"]), record("hard", 1, "h", ["CBM41"]),
        record("hard", 2, "z", ["CBM0", "GH13"]), record("easy", 0, "e", ["GH5"]),
    ]
    pools = R.Pools(spark.createDataFrame(rows, "pool string, slot long, accession string, tags array<string>, sequence string, sequence_sha256 string"), ["CBM20"], {}, {}, 0, 0, 0, 0, 0, 1)
    got = R.labelled_set(pools, "CBM20")
    assert sorted((r.class_label, r.accession) for r in got.collect()) == [("easy_negative", "e"), ("hard_negative", "h"), ("positive", "p")]
    manifest = R.reference_manifest(got)
    digest = rows[0][5]
    assert manifest["positive"]["aggregate_sequence_sha256"] == hashlib.sha256(f"{digest}\n".encode()).hexdigest()
    assert R.reference_manifest(got.filter("class_label <> 'easy_negative'"))["easy_negative"]["aggregate_sequence_sha256"] == hashlib.sha256(b"\n").hexdigest()
    with pytest.raises(InputError):
        R.labelled_set(pools, "GH13")
    with pytest.raises(InputError):
        R.require_disjoint(got.union(got.withColumn("class_label", F.lit("easy_negative"))))
    wrong = pools.records.withColumn("sequence_sha256", F.lit("0"))
    with pytest.raises(InputError):
        R.labelled_set(R.Pools(wrong, ["CBM20"], {}, {}, 0, 0, 0, 0, 0, 1), "CBM20")


@pytest.mark.parametrize("size,n", [(5, 3), (5, 5), (7, 100), (9, 1000)])
def test_samples_equal_sequential_ones(spark, size, n):
    items = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    df = spark.createDataFrame([("g", i, x) for i, x in enumerate(items)], "g string, ordinal long, x string").repartition(5)
    got = sampling.reservoir(df, "g", ["ordinal"], {"g": size}, {"g": "s"}).orderBy("slot").collect()
    assert [r.x for r in got] == brute_reservoir(items, size, "s")
    order = sorted(items)
    random.Random("s").shuffle(order)
    assert [r.x for r in sampling.shuffled(df, "g", ["x"], {"g": size}, {"g": "s"}).orderBy("slot").collect()] == order[:size]


def test_samples_of_several_groups(spark):
    rows = [(g, i, f"{g}{i}") for g, n in (("a", 300), ("b", 2), ("c", 40), ("unasked", 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, ordinal long, x string").repartition(7)
    got = sampling.reservoir(df, "g", ["ordinal"], {"a": 4, "b": 3, "c": 5, "none": 2}, {g: g + "!" for g in ("a", "b", "c", "none")})
    want = [(g, slot, x) for g, size in (("a", 4), ("b", 3), ("c", 5)) for slot, x in enumerate(brute_reservoir([r[2] for r in rows if r[0] == g], size, g + "!"))]
    assert sorted((r.g, r.slot, r.x) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("chunk", [1 << 20, 300])
def test_draws_equal_those_of_the_standard_generator(monkeypatch, chunk):
    monkeypatch.setattr(draws, "CHUNK", chunk)
    for size, n in ((1, 1), (1, 2), (3, 2), (5, 6), (7, 100), (1, 5000), (4000, 5000), (30, 70_000), (1, 0)):
        assert draws.reservoir_ranks("s", size, n).tolist() == brute_reservoir(list(range(n)), size, "s")
        ranks = list(range(n))
        random.Random("s").shuffle(ranks)
        assert draws.shuffled_ranks("s", size, n).tolist() == ranks[:size]
    for bounds in (range(2**32 - 400, 2**32 + 400), range(2**32 + 400, 2**32 - 400, -1), range(1, 3000), range(2**40, 2**40 + 9)):
        plain = random.Random("s")
        assert np.concatenate([v for _, v, _ in draws.below(draws.Words("s"), bounds.start, bounds.stop, bounds.step)]).tolist() == [plain.randrange(b) for b in bounds]


def test_draws_of_many_rows():
    """Three million draws against the standard generator; the replay holds one chunk of them."""
    assert draws.reservoir_ranks("s", 1500, 3_000_000).tolist() == brute_reservoir(range(3_000_000), 1500, "s")


def test_manifest_of_large_classes_streams(spark):
    classes = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "positive").otherwise("hard_negative").alias("class_label"), F.sha2((F.col("id") % 20_000).cast("string"), 256).alias("sequence_sha256"))
    want = {"easy_negative": set()}
    for i in range(30_000):
        want.setdefault("positive" if i % 3 == 0 else "hard_negative", set()).add(hashlib.sha256(str(i % 20_000).encode()).hexdigest())
    got = {r.class_label: (r.number_of_unique_sequences, r.aggregate_sequence_sha256) for r in R.class_manifest(classes).collect()}
    assert got == {c: (len(x), hashlib.sha256(("\n".join(sorted(x)) + "\n").encode()).hexdigest()) for c, x in want.items()}


def test_annotation_table(spark):
    df = spark.createDataFrame([("P1", "GH13; CBM20;", "mk")], "Entry string, CAZy string, Sequence string")
    row = R.parsed_annotations(df).first()
    assert (row.accession, row.tags, row.sequence_sha256) == ("P1", ["CBM20", "GH13"], hashlib.sha256(b"MK").hexdigest())
    for bad in [("P1", "X9", "MK"), ("", "GH13", "MK"), ("P1", None, "MK"), ("P1", "GH13", None), ("P1", "GH13", "M1")]:
        with pytest.raises(InputError):
            R.parsed_annotations(spark.createDataFrame([bad], df.schema))
    with pytest.raises(InputError):
        R.parsed_annotations(df.union(df))
    with pytest.raises(InputError):
        R.parsed_annotations(df.drop("CAZy"))


def test_samples_by_hash(spark):
    df = spark.createDataFrame([("ab"[i % 2], i) for i in range(200)], "g string, x long")
    one = sampling.sample(df, "g", ["x"], {"a": 10, "b": 500}, "s").collect()
    assert sorted(r.slot for r in one if r.g == "a") == list(range(10)) and sorted(r.x for r in one if r.g == "b") == list(range(1, 200, 2))
    assert {tuple(r) for r in one} == {tuple(r) for r in sampling.sample(df.repartition(7), "g", ["x"], {"a": 10, "b": 500}, "s").collect()}
    assert {r.x for r in one if r.g == "a"} != {r.x for r in sampling.sample(df, "g", ["x"], {"a": 10}, "t").collect()}


def test_only_group_and_order_are_ranked_and_no_sequence_is_shuffled_unasked(spark, monkeypatch):
    rows = [("g", i, None if i == 3 else i // 2, "long text" * i) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, a long, b long, text string").repartition(5)
    seen, ranked = [], sampling.ranked
    monkeypatch.setattr(sampling, "ranked", lambda df, group, order: seen.append(df.columns) or ranked(df, group, order))
    got = sampling.reservoir(df, "g", ["b", "a"], {"g": 9}, {"g": "s"}).orderBy("slot").collect()
    assert seen == [["g", "b", "a"]]  # all columns were sorted and written before
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[1]))
    assert [(r.g, r.a, r.b, r.text) for r in got] == brute_reservoir(order, 9, "s")
    narrow = sampling.reservoir(df.select("a", "g", "b"), "g", ["b", "a"], {"g": 9}, {"g": "s"})
    assert narrow.columns == ["a", "g", "b", "slot"] and [r.a for r in narrow.orderBy("slot").collect()] == [r.a for r in got]
    merged = R.merged(spark.createDataFrame([(2, "b", ["GH1"], "M", "d"), (1, "a", ["GH2"], "M", "d")], "ordinal long, accession string, tags array<string>, sequence string, sequence_sha256 string"))
    assert [tuple(r) for r in merged.collect()] == [(1, "a", ["GH1", "GH2"], "M", "d", 2, True)]
    plan = merged.select("sequence_sha256", "ordinal", "tags")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and "sequence#" not in plan.split("LogicalRDD")[0]


def test_sequences_are_normalised_as_before(spark):
    texts = ["abc*", "ab**", "ABC\n", "A B\tc", "a b", "é*", "　*", "", "*", None, "AB*\n", "ab\x7f", "\x1fa", "~!x"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    plain = F.regexp_replace(F.upper(F.regexp_replace("x", f"[{T.WHITE_SPACE}]+", "")), r"\*$", "")
    assert all(a == b for a, b in df.select(T.normalised_sequence(F.col("x")), plain).collect())
