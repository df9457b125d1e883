"""The pipeline's stages on their own inputs, against plain Python."""

import collections
import shutil

import corpus_pipeline
from seqcal.llm import pii, quality_rules

from .test_contracts import base_counts, base_entities, components


def test_stages_and_run(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = stage(spark, docs, small).persist()
        if name != "packing":
            assert docs.schema.names == inputs[name].schema.names
    rows = {k: [(r.doc_id, r.text) for r in v.collect()] for k, v in inputs.items()}

    kept = {i for i, _ in rows["near_dedup"]}
    for i, text in rows["quality_rules"]:
        n, _, _, _, repeats = base_counts(text)
        if n < 20 or 100 * repeats > 30 * n:
            assert i not in kept
    labels = spark.read.parquet(f"{small}/labels.parquet")
    assert kept == {r.doc_id for r in quality_rules.quality_verdicts(inputs["quality_rules"], labels).collect() if r.kept}
    assert len(kept) > 0.5 * len(rows["quality_rules"])

    assert {i for i, _ in rows["decontamination"]} == {i for i, _, c in components(rows["near_dedup"], 5) if i == c}

    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    holds = {i for i, text in rows["decontamination"] if any(t in text for t in items if len(t.split()) >= 5)}
    left = {i for i, _ in rows["pii"]}
    assert not holds & left and len(left) >= len(rows["decontamination"]) - 2 * len(holds) - 2

    before, after = dict(rows["pii"]), dict(rows["packing"])
    assert before.keys() == after.keys()
    for i, text in after.items():
        assert not [x for x in base_entities(text) if x.startswith(("email", "card"))]
        if not base_entities(before[i]):
            assert text == before[i]

    def plain(rows):
        return sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows if r.start == 0 and r.length == r.doc_tokens)

    packed = docs.collect()
    assert {r.doc_id for r in packed} == set(after)
    full = corpus_pipeline.run(spark, small).collect()
    total = lambda rows: collections.Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0)
    assert total(full) == total(packed)
    assert pii.KINDS[0] == "email"


def test_an_empty_table_and_rows_without_words_pass_all_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    hollow = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, " \n"), (3, "one")], "doc_id long, text string")
    for name, table in (("empty", docs.limit(0)), ("hollow", docs.select(docs.columns).limit(0).unionByName(hollow, allowMissingColumns=True))):
        folder = tmp_path / name
        folder.mkdir()
        for other in ("labels", "benchmark"):
            found = f"{small}/{other}.parquet"
            (shutil.copytree if (tmp_path / found).is_dir() else shutil.copy)(found, folder / f"{other}.parquet")
        table.write.parquet(str(folder / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(folder)).count() == 0
