"""Inputs of the registered queries, derived from the star-schema tables the same way in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import calibration, references


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ordinal, target_id, sequence: the letters of every document."""
    docs = table(spark, sf_dir, "documents")
    letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
    return docs.select(F.col("doc_id").alias("ordinal"), F.concat(F.lit("d"), "doc_id").alias("target_id"), letters.alias("sequence"))


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ordinal, header, sequence: headers in both layouts, tags from source and doc_id."""
    docs = table(spark, sf_dir, "documents")
    source = F.concat(F.lit("CBM"), F.regexp_replace("source", "[^0-9]", ""))
    family = F.concat(F.lit("GH13_"), (F.col("doc_id") % 5).cast("string"))
    name = F.concat(F.lit("d"), "doc_id")
    header = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(">"), source, F.lit("|"), name, F.lit("|"), family)).otherwise(F.concat(F.lit(">"), name, F.lit("|"), source, F.lit("|"), F.when(F.col("doc_id") % 3 == 0, "GH5").otherwise(family)))
    return docs.select(F.col("doc_id").alias("ordinal"), header.alias("header"), F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("sequence"))


HEADERS = """heads AS (
  SELECT doc_id AS ordinal, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS sequence,
    'd' || CAST(doc_id AS VARCHAR) AS accession, 'CBM' || regexp_replace(source, '[^0-9]', '', 'g') AS tag1,
    CASE WHEN doc_id % 2 = 1 AND doc_id % 3 = 0 THEN 'GH5' ELSE 'GH13_' || CAST(doc_id % 5 AS VARCHAR) END AS tag2
  FROM documents)"""
SEQUENCES = "seqs AS (SELECT doc_id AS ordinal, 'd' || CAST(doc_id AS VARCHAR) AS target_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS sequence FROM documents)"


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """family, score, is_positive, class_label of labelled documents, of languages that have both classes."""
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    positive = F.col("quality") == 1
    label = F.when(positive, "positive").when(F.col("toxic") == 1, "hard_negative").otherwise("easy_negative")
    found = joined.select(F.col("lang").alias("family"), (F.col("n_chars").cast("double") / 10.0).alias("score"), positive.alias("is_positive"), label.alias("class_label"))
    return found.join(calibration.class_sizes(found).select("family"), "family")


SCORES = """scores0 AS (
  SELECT d.lang AS family, CAST(d.n_chars AS DOUBLE) / CAST(10 AS DOUBLE) AS score, l.quality = 1 AS is_positive,
    CASE WHEN l.quality = 1 THEN 'positive' WHEN l.toxic = 1 THEN 'hard_negative' ELSE 'easy_negative' END AS class_label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
sizes AS (
  SELECT family, CAST(sum(CASE WHEN is_positive THEN 1 ELSE 0 END) AS BIGINT) AS positives, CAST(sum(CASE WHEN is_positive THEN 0 ELSE 1 END) AS BIGINT) AS negatives
  FROM scores0 GROUP BY family HAVING sum(CASE WHEN is_positive THEN 1 ELSE 0 END) > 0 AND sum(CASE WHEN is_positive THEN 0 ELSE 1 END) > 0),
scores AS (SELECT s.* FROM scores0 s JOIN sizes z ON s.family = z.family)"""


def line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """family, score, is_positive of every line item."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_linestatus").alias("family"), (F.col("l_extendedprice") / 100.0).alias("score"), (F.col("l_returnflag") == "R").alias("is_positive"))


LINE_SCORES = "SELECT l_linestatus AS family, l_extendedprice / CAST(100 AS DOUBLE) AS score, l_returnflag = 'R' AS is_positive FROM lineitem"


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """target_id, profile_name, start, end, score, evalue, coverage, ordinal of every event."""
    e = table(spark, sf_dir, "events")
    start = 1 + F.col("event_id") % 400
    return e.select(
        F.concat(F.lit("u"), "user_id").alias("target_id"), F.col("event_type").alias("profile_name"), start.alias("start"), (start + F.col("event_id") % 60).alias("end"),
        F.col("value").alias("score"), (1.0 / (1 + F.col("event_id") % 997)).alias("evalue"), ((F.col("event_id") % 60 + 1) / 100.0).alias("coverage"), F.col("event_id").alias("ordinal"),
    )


HITS = """hits AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS target_id, event_type AS profile_name, 1 + event_id % 400 AS "start", 1 + event_id % 400 + event_id % 60 AS "end", value AS score,
    CAST(1 AS DOUBLE) / CAST(1 + event_id % 997 AS DOUBLE) AS evalue, CAST(event_id % 60 + 1 AS DOUBLE) / CAST(100 AS DOUBLE) AS coverage, event_id AS ordinal
  FROM events)"""


def raw_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as raw rows of a search."""
    h = hits(spark, sf_dir)
    return h.select(
        F.concat(F.lit(" "), "profile_name", F.lit(".hmm")).alias("profile_name"), "target_id", F.col("evalue").alias("target_evalue"), F.lit(500).alias("target_length"), F.col("evalue").alias("i_evalue"), "score",
        F.lit(1).alias("hmm_from"), (F.col("end") - F.col("start") + 1).cast("int").alias("hmm_to"), F.lit(100).alias("hmm_length"), F.col("start").cast("int").alias("target_from"),
        F.col("end").cast("int").alias("target_to"), F.lit(500).alias("alignment_target_length"), "ordinal",
    )


def hit_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by profile for cutoffs of hits: whole values of events, positive for every third; view has no negatives."""
    h = hits(spark, sf_dir)
    return h.select(F.col("profile_name").alias("family"), "score", ((F.col("ordinal") % 3 == 0) | (F.col("profile_name") == "view")).alias("is_positive"))


HIT_SCORES = HITS + """,
hit_scores AS (SELECT profile_name AS family, score, (ordinal % 3 = 0) OR profile_name = 'view' AS is_positive FROM hits)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """class_label, slot, accession, tags, sequence, sequence_sha256: one class for each tag kind of merged records."""
    unique = references.merged(references.parsed(headers(spark, sf_dir)))
    label = F.when(F.col("ordinal") % 3 == 0, "positive").when(F.col("ordinal") % 3 == 1, "hard_negative").otherwise("easy_negative")
    return unique.select(label.alias("class_label"), F.col("ordinal").alias("slot"), "accession", "tags", "sequence", "sequence_sha256")


# One text for each pattern of the audit, as SQL that Spark and DuckDB read alike.
AUDIT_SAMPLES = [
    "'/Users/' || 'ann/x'", "'/home/' || 'ann/x'", "'C:' || chr(92) || chr(92) || 'Users' || chr(92) || chr(92) || 'ann'", "'at consett' || '.'", "'PS-' || 'ABCD1234'", "rpad('M', 70, 'K')", "rpad('N', 90, 'U')",
    "'-----BEGIN RSA' || ' PRIVATE KEY-----'", "rpad('AKIA', 20, 'Q')", "rpad('ghp_', 40, 'a')", "rpad('sk-', 30, 'b')", "'mysql' || '://user:' || 'word@host'",
]


def audit_sample(key: str) -> str:
    """SQL: the sample that a row of this key holds; one of 13 rows holds none."""
    return f"CASE {key} % {len(AUDIT_SAMPLES) + 1} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(AUDIT_SAMPLES)) + " ELSE '' END"


def audited(spark: SparkSession, sf_dir: str, name: str, key: str, text: str) -> DataFrame:
    """key, text: the texts of a table, each with a sample behind it."""
    return table(spark, sf_dir, name).select(key, F.concat(F.coalesce(text, F.lit("")), F.lit(" "), F.expr(audit_sample(key))).alias("text"))


def shared_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """headers, with names that several documents share."""
    return headers(spark, sf_dir).withColumn("header", F.regexp_replace("header", "d[0-9]+", F.concat(F.lit("d"), F.expr("ordinal % 150").cast("string"))))
