import importlib
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from seqcal.operators import classify
from seqcal.plans import catalog
from seqcal.streaming import classify as stream

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return None
    return v.item() if hasattr(v, "item") else v


def rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(map(plain, r)) for r in df[names].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_queries_against_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    assert rows(catalog.QUERIES[name](spark, small).toPandas()) == rows(con.execute(catalog.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_queries_without_sql_have_rows(spark, small, name):
    assert catalog.QUERIES[name](spark, small).count() > 0


def test_entry_imports_without_the_training_data_part(monkeypatch):
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith("seqcal.llm") or name == "corpus_pipeline" else find(name, *a))
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    bare = importlib.import_module("__spark_entry__")
    assert set(bare.queries()) == set(catalog.QUERIES)
    sys.modules["__spark_entry__"] = entry


def test_streams_give_the_batch_result(spark, tmp_path):
    df = spark.createDataFrame([("alpha", 10.0, 1), ("alpha", 9.0, 2), ("beta", 1.0, 3)], "profile_name string, domain_bit_score_bits double, id int")
    cut = spark.createDataFrame([("alpha", 10.0)], "family string, cutoff double")
    where = [str(tmp_path / x) for x in ("in", "out", "state")]
    expected = set()
    for part in (df.filter("id < 3"), df.filter("id = 3")):
        part.write.mode("append").parquet(where[0])
        expected |= {tuple(r) for r in classify.apply_cutoffs(part, cut).collect()}
        stream.write_stream(stream.classified_stream(spark, where[0], "profile_name string, domain_bit_score_bits double, id int", cut), where[1], where[2]).awaitTermination()
        assert {tuple(r) for r in spark.read.parquet(where[1]).collect()} == expected
