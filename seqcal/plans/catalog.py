"""The registered queries of the engine and their SQL counterparts."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..operators import audit, calibration as C, checks, classify, hits as H, overlap, references as R, sampling
from ..shared import table_path, written
from ..sources import profiles, tables
from . import views as V

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


RATES = ["sensitivity", "specificity", "false_positive_rate", "false_negative_rate"]
RATE_SQL = """round(CAST(tp AS DOUBLE) / positives, 9) AS sensitivity, round(CAST(negatives - fp AS DOUBLE) / negatives, 9) AS specificity,
  round(CAST(fp AS DOUBLE) / negatives, 9) AS false_positive_rate, round(CAST(positives - tp AS DOUBLE) / positives, 9) AS false_negative_rate"""
COUNT_SQL = """CAST(tp AS BIGINT) AS correctly_detected_positives, CAST(positives - tp AS BIGINT) AS missed_positives, CAST(fp AS BIGINT) AS incorrectly_accepted_negatives,
  CAST(negatives - fp AS BIGINT) AS correctly_rejected_negatives"""


def curve_sql(scores: str = "scores", sizes: str = "sizes") -> str:
    return f"""grouped AS (
  SELECT family, score AS threshold, sum(CASE WHEN is_positive THEN 1 ELSE 0 END) AS p, sum(CASE WHEN is_positive THEN 0 ELSE 1 END) AS n FROM {scores} GROUP BY family, score),
curve AS (
  SELECT g.family, g.threshold, sum(g.p) OVER (PARTITION BY g.family ORDER BY g.threshold DESC) AS tp, sum(g.n) OVER (PARTITION BY g.family ORDER BY g.threshold DESC) AS fp, z.positives, z.negatives
  FROM grouped g JOIN {sizes} z ON g.family = z.family
  UNION ALL SELECT g.family, nextafter(min(g.threshold), CAST('-infinity' AS DOUBLE)), z.positives, z.negatives, z.positives, z.negatives FROM grouped g JOIN {sizes} z ON g.family = z.family GROUP BY g.family, z.positives, z.negatives
  UNION ALL SELECT g.family, nextafter(max(g.threshold), CAST('infinity' AS DOUBLE)), 0, 0, z.positives, z.negatives FROM grouped g JOIN {sizes} z ON g.family = z.family GROUP BY g.family, z.positives, z.negatives)"""


LINES = f"""lines AS ({V.LINE_SCORES}),
line_sizes AS (SELECT family, sum(CASE WHEN is_positive THEN 1 ELSE 0 END) AS positives, sum(CASE WHEN is_positive THEN 0 ELSE 1 END) AS negatives FROM lines GROUP BY family
  HAVING sum(CASE WHEN is_positive THEN 1 ELSE 0 END) > 0 AND sum(CASE WHEN is_positive THEN 0 ELSE 1 END) > 0)"""
CURVE = f"WITH {V.SCORES}, {curve_sql()}"
CUT = "cut AS (SELECT family, min(threshold) AS threshold FROM curve WHERE fp = 0 GROUP BY family)"
Z = "1.959963984540054"


def wilson_sql(k: str, n: str, name: str) -> str:
    k, n, z = f"CAST({k} AS DOUBLE)", f"CAST({n} AS DOUBLE)", f"CAST({Z} AS DOUBLE)"
    centre = f"({k} / {n} + {z} * {z} / (2 * {n})) / (1 + {z} * {z} / {n})"
    margin = f"{z} * sqrt({k} / {n} * (1 - {k} / {n}) / {n} + {z} * {z} / (4 * {n} * {n})) / (1 + {z} * {z} / {n})"
    return f"round(greatest(0, {centre} - {margin}), 9) AS {name}_low, round(least(1, {centre} + {margin}), 9) AS {name}_high"


SUMMARY_SQL = f"""counted AS (
  SELECT t.family, t.step, t.threshold, z.positives, z.negatives, sum(CASE WHEN s.is_positive AND s.score >= t.threshold THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN NOT s.is_positive AND s.score >= t.threshold THEN 1 ELSE 0 END) AS fp
  FROM wanted t JOIN sizes z ON t.family = z.family JOIN scores s ON s.family = t.family GROUP BY t.family, t.step, t.threshold, z.positives, z.negatives)
SELECT family, step, round(threshold, 6) AS bit_score_threshold_bits, {COUNT_SQL}, {RATE_SQL}, positives, negatives, {wilson_sql("tp", "positives", "sensitivity")}, {wilson_sql("negatives - fp", "negatives", "specificity")} FROM counted"""
INTERVALS = ["sensitivity_low", "sensitivity_high", "specificity_low", "specificity_high"]


def _summary(df: DataFrame) -> DataFrame:
    df = _rounded(df, *RATES, *INTERVALS).withColumn("bit_score_threshold_bits", F.round("bit_score_threshold_bits", 6))
    return df.select("family", "step", "bit_score_threshold_bits", *C.COUNTS, *RATES, "positives", "negatives", *INTERVALS)


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.roc_curve(V.scores(spark, sf_dir))


@query(f"{CURVE} SELECT family, threshold AS bit_score_threshold_bits, {COUNT_SQL}, {RATE_SQL} FROM curve")
def roc_curve_by_family(spark, sf_dir):
    return _rounded(_curve(spark, sf_dir).select(*C.CURVE), *RATES)


@query(f"WITH {LINES}, {curve_sql('lines', 'line_sizes')} SELECT family, threshold AS bit_score_threshold_bits, {COUNT_SQL}, {RATE_SQL} FROM curve")
def roc_curve_line_items(spark, sf_dir):
    return _rounded(C.roc_curve(V.line_scores(spark, sf_dir)).select(*C.CURVE), *RATES)


AUC_STEPS = """points AS (SELECT DISTINCT family, CAST(fp AS DOUBLE) / negatives AS x, CAST(tp AS DOUBLE) / positives AS y FROM curve),
steps AS (SELECT family, x - lag(x) OVER (PARTITION BY family ORDER BY x, y) AS dx, y + lag(y) OVER (PARTITION BY family ORDER BY x, y) AS sy FROM points)"""
AUC_OF = "SELECT family, round(sum(dx * sy / 2), 9) AS roc_auc FROM steps GROUP BY family"
AUC_SQL = f"{AUC_STEPS} {AUC_OF}"


@query(f"{CURVE}, {AUC_SQL}")
def roc_auc_by_family(spark, sf_dir):
    return _rounded(C.roc_auc(_curve(spark, sf_dir)), "roc_auc")


@query(f"WITH {LINES}, {curve_sql('lines', 'line_sizes')}, {AUC_SQL}")
def roc_auc_line_items(spark, sf_dir):
    return _rounded(C.roc_auc(C.roc_curve(V.line_scores(spark, sf_dir))), "roc_auc")


@query(f"{CURVE}, {CUT} SELECT * FROM cut")
def zero_fp_cutoff(spark, sf_dir):
    return C.zero_false_positive_cutoff(_curve(spark, sf_dir))


@query(f"{CURVE}, {CUT}, wanted AS (SELECT family, 0 AS step, threshold FROM cut), {SUMMARY_SQL}")
def threshold_summary_wilson(spark, sf_dir):
    scores = V.scores(spark, sf_dir)
    cut = C.zero_false_positive_cutoff(C.roc_curve(scores)).select("family", F.lit(0).alias("step"), "threshold")
    return _summary(C.summarise_thresholds(scores, cut))


@query(f"{CURVE}, {CUT}, wanted AS (SELECT family, s.step, threshold + 5 * s.step AS threshold FROM cut CROSS JOIN (VALUES (-1), (0), (1)) s(step)), {SUMMARY_SQL}")
def robustness_table(spark, sf_dir):
    scores = V.scores(spark, sf_dir)
    return _summary(C.robustness(scores, C.zero_false_positive_cutoff(C.roc_curve(scores))))


@query(f"WITH {V.SCORES}, wanted AS (SELECT family, 7 AS step, CAST(123.45 AS DOUBLE) AS threshold FROM sizes), {SUMMARY_SQL}")
def comparison_threshold(spark, sf_dir):
    scores = V.scores(spark, sf_dir)
    wanted = C.class_sizes(scores).select("family", F.lit(7).alias("step"), F.lit(123.45).alias("threshold"))
    return _summary(C.summarise_thresholds(scores, wanted))


@query(f"""{CURVE}, wanted AS (SELECT family, w.t AS wanted_threshold FROM sizes CROSS JOIN (VALUES (CAST(-1 AS DOUBLE)), (CAST(77.77 AS DOUBLE)), (CAST(250.05 AS DOUBLE)), (CAST(1000000 AS DOUBLE))) w(t)),
near AS (SELECT w.family, w.wanted_threshold, coalesce(min(CASE WHEN c.threshold >= w.wanted_threshold THEN c.threshold END), max(c.threshold)) AS threshold FROM wanted w JOIN curve c ON c.family = w.family GROUP BY w.family, w.wanted_threshold)
SELECT n.family, n.wanted_threshold, c.threshold AS bit_score_threshold_bits, {COUNT_SQL} FROM near n JOIN curve c ON c.family = n.family AND c.threshold = n.threshold""")
def curve_step_lookup(spark, sf_dir):
    curve = _curve(spark, sf_dir)
    wanted = curve.select("family").distinct().select("family", F.explode(F.array(*map(F.lit, (-1.0, 77.77, 250.05, 1000000.0)))).alias("wanted_threshold"))
    return C.confusion_from_curve(curve, wanted).select("family", "wanted_threshold", "bit_score_threshold_bits", *C.COUNTS)


@query(f"""WITH {V.SCORES} SELECT family, class_label, count(*) AS number_of_scores, min(score) AS minimum_bit_score_bits, median(score) AS median_bit_score_bits, round(avg(score), 6) AS mean_bit_score_bits, max(score) AS maximum_bit_score_bits
FROM scores GROUP BY family, class_label""")
def score_distribution(spark, sf_dir):
    return C.score_distribution(V.scores(spark, sf_dir), ["family", "class_label"]).withColumn("mean_bit_score_bits", F.round("mean_bit_score_bits", 6))


REPORT_SQL = f"""{CURVE}, {CUT}, {AUC_STEPS}, auc AS ({AUC_OF}),
tried AS (SELECT c.family, c.threshold AS cutoff, sum(CASE WHEN NOT s.is_positive AND s.score >= c.threshold - 5 THEN 1 ELSE 0 END) AS accepted_below, sum(CASE WHEN s.is_positive AND s.score < c.threshold THEN 1 ELSE 0 END) AS missed,
  sum(CASE WHEN s.is_positive AND s.score < c.threshold + 5 THEN 1 ELSE 0 END) AS missed_above, sum(CASE WHEN NOT s.is_positive AND s.score >= 50 THEN 1 ELSE 0 END) AS accepted_at_50 FROM cut c JOIN scores s ON s.family = c.family GROUP BY c.family, c.threshold),
spread AS (SELECT family, is_positive, count(*) AS n, min(score) AS low, median(score) AS mid, round(avg(score), 6) AS mean, max(score) AS high FROM scores GROUP BY family, is_positive)
SELECT a.family, a.roc_auc, t.cutoff, CAST(t.accepted_below AS BIGINT) AS accepted_below, CAST(t.missed AS BIGINT) AS missed, CAST(t.missed_above AS BIGINT) AS missed_above, CAST(t.accepted_at_50 AS BIGINT) AS accepted_at_50,
  p.n AS positives, p.low AS positive_low, p.mid AS positive_median, p.mean AS positive_mean, p.high AS positive_high, n.n AS negatives, n.low AS negative_low, n.mid AS negative_median, n.mean AS negative_mean, n.high AS negative_high
FROM auc a JOIN tried t ON t.family = a.family JOIN spread p ON p.family = a.family AND p.is_positive JOIN spread n ON n.family = a.family AND NOT n.is_positive"""


@query(REPORT_SQL)
def calibration_report(spark, sf_dir):
    """The whole report of each family, flattened: area, cutoff, counts around it and at a threshold of comparison, spreads."""
    found = C.calibration_reports(V.scores(spark, sf_dir), comparison=50.0)
    spread = [
        (F.round(f"{kind}_scores.{column}", 6) if name == "mean" else F.col(f"{kind}_scores.{column}")).alias(f"{kind}s" if name == "n" else f"{kind}_{name}")
        for kind in ("positive", "negative")
        for name, column in (("n", "number_of_scores"), ("low", "minimum_bit_score_bits"), ("median", "median_bit_score_bits"), ("mean", "mean_bit_score_bits"), ("high", "maximum_bit_score_bits"))
    ]
    below, above = F.element_at("robustness", 1), F.element_at("robustness", 3)
    return found.select(
        "family", F.round("roc_auc", 9).alias("roc_auc"), F.col("selected_cutoff.bit_score_threshold_bits").alias("cutoff"), below[C.COUNTS[2]].alias("accepted_below"), F.col(f"selected_cutoff.{C.COUNTS[1]}").alias("missed"),
        above[C.COUNTS[1]].alias("missed_above"), F.col(f"comparison.{C.COUNTS[2]}").alias("accepted_at_50"), *spread,
    )


@query("SELECT doc_id, lang, sha256(coalesce(text, '')) AS digest, CAST(length(coalesce(text, '')) AS BIGINT) AS length FROM documents")
def table_round_trip(spark, sf_dir):
    """Whole texts, with their tabs, quotes and line ends, written as tab-separated files by the executors and read again."""
    path = table_path(spark, "tsv")
    tables.write_tsv_files(V.table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path)
    back = tables.read_tsv(spark, path, ["doc_id", "lang", "text"])
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.sha2("text", 256).alias("digest"), F.length("text").cast("long").alias("length"))


COUNT_CASES = ", ".join(f"CAST(sum(CASE WHEN class_label = '{x}' THEN 1 ELSE 0 END) AS BIGINT) AS {x}" for x in ("positive", "hard_negative", "easy_negative", "negative"))


@query(f"WITH {V.SCORES} SELECT family, {COUNT_CASES} FROM scores GROUP BY family")
def class_counts(spark, sf_dir):
    return C.class_counts(V.scores(spark, sf_dir))


@query(f"""WITH {V.SCORES}, floored AS (SELECT family, is_positive, greatest(score - 50, 0) AS score FROM scores)
SELECT family, CAST(sum(CASE WHEN is_positive AND score = 0 THEN 1 ELSE 0 END) AS BIGINT) AS positives_without_domain, CAST(sum(CASE WHEN NOT is_positive AND score = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives_without_domain FROM floored GROUP BY family""")
def without_domain(spark, sf_dir):
    return C.without_domain(V.scores(spark, sf_dir).withColumn("score", F.greatest(F.col("score") - 50.0, F.lit(0.0))))


@query("""WITH sums AS (SELECT c_custkey, count(o_orderkey) AS k, 1 + c_custkey % 7 AS extra FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT c_custkey AS id, """ + wilson_sql("k", "(k + extra)", "share") + " FROM sums")
def wilson_intervals(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("k"))
    rows = V.table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("k", F.lit(0)).alias("k"))
    low, high = C.wilson(F.col("k"), F.col("k") + 1 + F.col("c_custkey") % 7)
    return rows.select(F.col("c_custkey").alias("id"), F.round(low, 9).alias("share_low"), F.round(high, 9).alias("share_high"))


LANG_CUT = f"{CURVE}, {CUT}"
CLASS_SQL = "CASE WHEN c.threshold IS NULL THEN 'uncalibrated_family' WHEN {score} >= c.threshold THEN 'passes_operational_cutoff' ELSE 'below_operational_cutoff' END"


@query(f"{LANG_CUT} SELECT d.doc_id, d.lang, CAST(d.n_chars AS DOUBLE) / CAST(10 AS DOUBLE) AS score, c.threshold AS operational_cutoff_bit_score_bits, {CLASS_SQL.format(score='CAST(d.n_chars AS DOUBLE) / CAST(10 AS DOUBLE)')} AS operational_cutoff_classification FROM documents d LEFT JOIN cut c ON c.family = d.lang")
def apply_cutoff(spark, sf_dir):
    cut = zero_fp_cutoff(spark, sf_dir).withColumnRenamed("threshold", "cutoff")
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("n_chars").cast("double") / 10.0).alias("score"))
    return classify.apply_cutoffs(docs, cut, "lang", "score")


HIT_CUT = f"""WITH {V.HIT_SCORES}, hit_sizes AS (SELECT family, sum(CASE WHEN is_positive THEN 1 ELSE 0 END) AS positives, sum(CASE WHEN is_positive THEN 0 ELSE 1 END) AS negatives FROM hit_scores GROUP BY family
  HAVING sum(CASE WHEN is_positive THEN 1 ELSE 0 END) > 0 AND sum(CASE WHEN is_positive THEN 0 ELSE 1 END) > 0), {curve_sql('hit_scores', 'hit_sizes')}, {CUT}"""


def _hit_cutoffs(spark, sf_dir):
    return C.zero_false_positive_cutoff(C.roc_curve(V.hit_scores(spark, sf_dir))).withColumnRenamed("threshold", "cutoff")


@query(f"{HIT_CUT} SELECT {CLASS_SQL.format(score='h.score')} AS operational_cutoff_classification, count(*) AS n FROM hits h LEFT JOIN cut c ON c.family = h.profile_name GROUP BY 1")
def apply_cutoff_counts(spark, sf_dir):
    return classify.classified_counts(classify.apply_cutoffs(V.hits(spark, sf_dir), _hit_cutoffs(spark, sf_dir), score="score"))


@query(f"{HIT_CUT} SELECT h.ordinal, h.profile_name FROM hits h LEFT JOIN cut c ON c.family = h.profile_name WHERE c.family IS NULL")
def uncalibrated_rows(spark, sf_dir):
    return classify.uncalibrated(V.hits(spark, sf_dir), _hit_cutoffs(spark, sf_dir)).select("ordinal", "profile_name")


DOMAINS = """, accepted AS (SELECT profile_name, target_id, evalue, score, "start", "end", coverage, ordinal FROM hits WHERE evalue <= CAST(0.01 AS DOUBLE) AND coverage >= CAST(0.35 AS DOUBLE))"""


def _accepted(spark, sf_dir):
    return H.domain_hits(V.raw_domains(spark, sf_dir), 0.01, 0.35)


@query(f"""WITH {V.HITS}{DOMAINS} SELECT ordinal, profile_name, target_id, evalue AS independent_domain_evalue, score AS domain_bit_score_bits, round(coverage, 9) AS hmm_alignment_coverage_fraction,
CAST("start" AS BIGINT) AS target_start, CAST("end" AS BIGINT) AS target_end FROM accepted""")
def domain_filter(spark, sf_dir):
    return _accepted(spark, sf_dir).select(
        "ordinal", "profile_name", "target_id", "independent_domain_evalue", "domain_bit_score_bits", F.round("hmm_alignment_coverage_fraction", 9).alias("hmm_alignment_coverage_fraction"),
        F.col("target_start_amino_acid_position").cast("long").alias("target_start"), F.col("target_end_amino_acid_position").cast("long").alias("target_end"),
    )


@query(f"""WITH {V.HITS}{DOMAINS} SELECT profile_name, target_id, evalue AS independent_domain_evalue, score AS domain_bit_score_bits, round(coverage * 100, 6) AS hmm_alignment_coverage_percent FROM accepted""")
def hit_rows_percent(spark, sf_dir):
    rows = H.hit_rows(_accepted(spark, sf_dir))
    return rows.select("profile_name", "target_id", "independent_domain_evalue", "domain_bit_score_bits", F.round("hmm_alignment_coverage_percent", 6).alias("hmm_alignment_coverage_percent"))


@query(f"""WITH {V.HITS}{DOMAINS} SELECT ordinal, row_number() OVER (PARTITION BY target_id ORDER BY "start", profile_name, evalue, "end", score DESC, ordinal) AS place FROM accepted""")
def hit_order(spark, sf_dir):
    rows = _accepted(spark, sf_dir).withColumn("_s", -F.col("domain_bit_score_bits"))
    return sampling.ranked(rows, "target_id", [*H.ORDER[1:], "_s", "ordinal"]).select("ordinal", (F.col("rank") + 1).alias("place"))


@query(f"""WITH {V.HITS}, targets AS (SELECT DISTINCT 'u' || CAST(c_custkey AS VARCHAR) AS target_id FROM customer)
SELECT t.target_id, greatest(coalesce(max(h.score - 20), 0), 0) AS score, count(h.target_id) > 0 AS had_hit FROM targets t LEFT JOIN hits h ON h.target_id = t.target_id GROUP BY t.target_id""")
def best_profile_scores(spark, sf_dir):
    targets = V.table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), "c_custkey").alias("target_id"))
    return C.best_profile_scores(V.hits(spark, sf_dir).withColumn("score", F.col("score") - 20.0), targets)


OVERLAP = """CAST(greatest(0, least({a}."end", {b}."end") - greatest({a}."start", {b}."start") + 1) AS DOUBLE) / least({a}."end" - {a}."start" + 1, {b}."end" - {b}."start" + 1)"""
FOLD_STEP = """CASE WHEN len(list_filter(kept, lambda k: CAST(greatest(0, least(k.e, hit[1].e) - greatest(k.s, hit[1].s) + 1) AS DOUBLE) / least(k.e - k.s + 1, hit[1].e - hit[1].s + 1) > 0.5)) > 0 THEN kept ELSE list_concat(kept, hit) END"""


@query(f"""WITH {V.HITS}, ranked AS (SELECT target_id, [{{'s': "start", 'e': "end", 'o': ordinal}}] AS hit, evalue, score, coverage, "start" AS s, "end" AS e, ordinal FROM hits),
lists AS (SELECT target_id, list(hit ORDER BY evalue, -score, -coverage, s, e, ordinal) AS l FROM ranked GROUP BY target_id),
folded AS (SELECT target_id, list_reduce(l, lambda kept, hit: {FOLD_STEP}) AS kept FROM lists)
SELECT target_id, unnest(list_transform(kept, lambda k: k.o)) AS ordinal FROM folded""")
def distinct_domains(spark, sf_dir):
    return overlap.distinct_domains(V.hits(spark, sf_dir)).select("target_id", "ordinal")


@query(f"""WITH {V.HITS} SELECT a.ordinal AS first, b.ordinal AS second, round({OVERLAP.format(a='a', b='b')}, 9) AS overlap FROM hits a JOIN hits b ON a.target_id = b.target_id AND a.ordinal < b.ordinal
WHERE {OVERLAP.format(a='a', b='b')} > 0.5""")
def overlap_pairs(spark, sf_dir):
    return _rounded(overlap.overlapping_pairs(V.hits(spark, sf_dir), 0.5), "overlap")


@query(f"WITH {V.SEQUENCES} SELECT count(*) AS number_of_records, CAST(sum(length(sequence)) AS BIGINT) AS total_residues, CAST(min(length(sequence)) AS BIGINT) AS minimum_length, CAST(max(length(sequence)) AS BIGINT) AS maximum_length FROM seqs")
def fasta_summary(spark, sf_dir):
    return checks.protein_summary(V.sequences(spark, sf_dir))


@query(f"WITH {V.SEQUENCES} SELECT sha256(sequence) AS digest, count(*) AS n FROM seqs GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    return checks.duplicates(V.sequences(spark, sf_dir).select(F.sha2("sequence", 256).alias("digest")), "digest")


WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
CLEAN_SQL = f"regexp_replace(upper(regexp_replace(regexp_replace(text, '{WS}+', '', 'g'), 'ß', 'ss', 'g')), '\\*$', '')"


@query(f"SELECT doc_id, length({CLEAN_SQL}) AS length, sha256({CLEAN_SQL}) AS digest, regexp_matches({CLEAN_SQL}, '^[A-Z]+$') AS is_valid FROM documents")
def normalise_sequence(spark, sf_dir):
    clean = T.normalised_sequence(F.col("text"))
    return V.table(spark, sf_dir, "documents").select("doc_id", F.length(clean).cast("long").alias("length"), F.sha2(clean, 256).alias("digest"), clean.rlike("^[A-Z]+$").alias("is_valid"))


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(regexp_replace({CLEAN_SQL}, '[A-Z]', '', 'g'), ''))), ' ') AS symbols FROM documents")
def invalid_symbols(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.invalid_symbols(T.normalised_sequence(F.col("text"))), " ").alias("symbols"))


@query(f"WITH {V.HEADERS} SELECT ordinal, accession, CASE WHEN tag1 < tag2 THEN tag1 || ' ' || tag2 ELSE tag2 || ' ' || tag1 END AS tags, sha256(sequence) AS digest FROM heads")
def parse_header(spark, sf_dir):
    return R.parsed(V.headers(spark, sf_dir)).select("ordinal", "accession", F.array_join("tags", " ").alias("tags"), F.col("sequence_sha256").alias("digest"))


@query(f"WITH {V.HEADERS} SELECT ordinal, tag1 = 'CBM2' OR split_part(tag2, '_', 1) = 'CBM2' AS cbm2, split_part(tag2, '_', 1) = 'GH13' AS gh13 FROM heads")
def has_family(spark, sf_dir):
    tags = F.col("tags")
    return R.parsed(V.headers(spark, sf_dir)).select("ordinal", T.has_family(tags, "CBM2").alias("cbm2"), T.has_family(tags, "GH13").alias("gh13"))


TAGS = f"""WITH {V.HEADERS}, digests AS (SELECT *, sha256(sequence) AS digest FROM heads),
each AS (SELECT digest, ordinal, tag1 AS tag FROM digests UNION ALL SELECT digest, ordinal, tag2 FROM digests),
unioned AS (SELECT digest, string_agg(tag, ' ' ORDER BY tag) AS tags FROM (SELECT DISTINCT digest, tag FROM each) GROUP BY digest),
firsts AS (SELECT digest, min(ordinal) AS ordinal, count(*) AS entries, count(DISTINCT tag1 || ' ' || tag2) > 1 AS differing FROM digests GROUP BY digest),
uniques AS (SELECT f.digest, f.ordinal, h.accession, u.tags, f.entries, f.differing FROM firsts f JOIN unioned u ON u.digest = f.digest JOIN heads h ON h.ordinal = f.ordinal)"""


def _unique(spark, sf_dir):
    return R.merged(R.parsed(V.headers(spark, sf_dir)))


@query(f"{TAGS} SELECT digest, ordinal, accession, tags, entries, differing FROM uniques")
def dedup_union_tags(spark, sf_dir):
    return _unique(spark, sf_dir).select(F.col("sequence_sha256").alias("digest"), "ordinal", "accession", F.array_join("tags", " ").alias("tags"), "entries", "differing")


HARD_TEST = r"regexp_matches(' ' || tags || ' ', ' (CBM6|CBM9|CBM13)(_[0-9]+)? ')"
ROUTES = f"""{TAGS}, routes AS (
  SELECT digest, 'positive:CBM2' AS pool FROM uniques WHERE regexp_matches(' ' || tags || ' ', ' CBM2(_[0-9]+)? ')
  UNION ALL SELECT digest, 'positive:GH13' FROM uniques WHERE regexp_matches(' ' || tags || ' ', ' GH13(_[0-9]+)? ')
  UNION ALL SELECT digest, 'hard' FROM uniques WHERE {HARD_TEST}
  UNION ALL SELECT digest, 'easy' FROM uniques WHERE NOT {HARD_TEST} AND tags <> '' AND NOT regexp_matches(' ' || tags, ' CBM'))"""
FAMILIES, POOL_HARD = ["CBM2", "GH13"], ["CBM6", "CBM9", "CBM13"]


@query(f"{ROUTES} SELECT digest, pool FROM routes")
def pool_routing(spark, sf_dir):
    return R.routed(_unique(spark, sf_dir), FAMILIES, POOL_HARD).select(F.col("sequence_sha256").alias("digest"), "pool")


@query(f"{ROUTES}, own AS (SELECT family, count(*) AS entries FROM (SELECT DISTINCT ordinal, split_part(tag, '_', 1) AS family FROM each) WHERE family IN ('CBM2', 'GH13') GROUP BY family) SELECT o.family, o.entries, count(*) AS uniques FROM own o JOIN routes r ON r.pool = 'positive:' || o.family GROUP BY o.family, o.entries")
def pool_totals(spark, sf_dir):
    entries = R.positive_entries(R.parsed(V.headers(spark, sf_dir)), FAMILIES)
    unique = R.routed(_unique(spark, sf_dir), FAMILIES, POOL_HARD).filter("pool like 'positive:%'").groupBy(F.substring("pool", 10, 99).alias("family")).agg(F.count("*").alias("uniques"))
    return entries.join(unique, "family").select("family", "entries", "uniques")


CLASS_OF = "CASE ordinal % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'hard_negative' ELSE 'easy_negative' END"


@query(f"""{TAGS}, classes AS (SELECT DISTINCT digest, {CLASS_OF} AS label FROM digests)
SELECT a.label AS first, b.label AS second, count(*) AS n FROM classes a JOIN classes b ON a.digest = b.digest AND a.label < b.label GROUP BY 1, 2""")
def class_overlap(spark, sf_dir):
    label = F.when(F.col("ordinal") % 3 == 0, "positive").when(F.col("ordinal") % 3 == 1, "hard_negative").otherwise("easy_negative")
    return R.shared_sequences(R.parsed(V.headers(spark, sf_dir)).withColumn("class_label", label))


SAMPLED = f"""{TAGS}, labelled AS (SELECT {CLASS_OF} AS class_label, accession, digest FROM uniques),
places AS (SELECT *, row_number() OVER (PARTITION BY class_label ORDER BY md5('{R.SEED}:' || digest), digest) - 1 AS slot FROM labelled), sampled AS (SELECT * FROM places WHERE slot < 100)"""


@query(f"{SAMPLED} SELECT class_label, slot, accession, digest FROM sampled")
def keyed_sample(spark, sf_dir):
    found = sampling.sample(V.labelled(spark, sf_dir).drop("slot"), "class_label", ["sequence_sha256"], dict.fromkeys(R.CLASSES, 100), str(R.SEED))
    return found.select("class_label", "slot", "accession", F.col("sequence_sha256").alias("digest"))


@query(f"{SAMPLED} SELECT class_label, count(*) AS number_of_unique_sequences, sha256(string_agg(digest, chr(10) ORDER BY digest) || chr(10)) AS aggregate_sequence_sha256 FROM labelled GROUP BY 1")
def class_manifest(spark, sf_dir):
    return R.class_manifest(V.labelled(spark, sf_dir))


@query(f"{TAGS} SELECT 'd' || CAST(ordinal % 150 AS VARCHAR) AS accession FROM digests GROUP BY 1 HAVING min(digest) <> max(digest)")
def accession_conflicts(spark, sf_dir):
    return R.inconsistent_accessions(R.parsed(V.shared_headers(spark, sf_dir)))


POOL_SIZES = {"positive:CBM2": 20, "positive:GH13": 150, "hard": 100, "easy": 30}


DRAWN_ROWS = 20_000  # more than the test tables have


def _takeovers(pool: str, size: int) -> list[str]:
    """Which item takes which slot of a reservoir, drawn one after the other: the same however many items follow."""
    draw = random.Random(f"{R.SEED}:{pool}")
    return [f"('{pool}', {slot}, {n})" for n in range(size, DRAWN_ROWS) if (slot := draw.randrange(n + 1)) < size]


SLOTS = ", ".join(row for p, n in POOL_SIZES.items() for row in [*(f"('{p}', {i}, {i})" for i in range(n)), *_takeovers(p, n)])


@query(f"""{ROUTES}, takeovers(pool, slot, place) AS (VALUES {SLOTS}),
ranked AS (SELECT r.pool, u.ordinal, row_number() OVER (PARTITION BY r.pool ORDER BY u.ordinal) - 1 AS place FROM routes r JOIN uniques u ON u.digest = r.digest),
held AS (SELECT t.pool, t.slot, max(t.place) AS place FROM takeovers t JOIN ranked r ON r.pool = t.pool AND r.place = t.place GROUP BY t.pool, t.slot)
SELECT h.pool, CAST(h.slot AS BIGINT) AS slot, r.ordinal FROM held h JOIN ranked r ON r.pool = h.pool AND r.place = h.place""")
def reservoir_sample(spark, sf_dir):
    return _reservoirs(R.routed(_unique(spark, sf_dir), FAMILIES, POOL_HARD).select("pool", "ordinal"))


def _reservoirs(pools: DataFrame) -> DataFrame:
    return sampling.reservoir(pools, "pool", ["ordinal"], POOL_SIZES, {p: f"{R.SEED}:{p}" for p in POOL_SIZES}).select("pool", "slot", "ordinal")


@query()
def labelled_sample(spark, sf_dir):
    return _labelled(V.labelled(spark, sf_dir).select("class_label", "accession", "sequence_sha256")).select("class_label", "slot", "accession", "sequence_sha256")


def _labelled(rows: DataFrame) -> DataFrame:
    sizes = dict.fromkeys(R.CLASSES, 100)
    return sampling.shuffled(rows, "class_label", ["sequence_sha256"], sizes, {c: f"{R.SEED}:labelled:GH13:{c}" for c in sizes})


def _of_sample(sample: DataFrame, group: str, key: str) -> DataFrame:
    """How many rows, slots and keys a group's sample has, and its last slot."""
    return sample.groupBy(group).agg(F.count("*").alias("n"), F.count_distinct("slot").alias("slots"), F.count_distinct(key).alias("keys"), F.max("slot").alias("last"))


SIZE_CASES = " ".join(f"WHEN '{p}' THEN {n}" for p, n in POOL_SIZES.items())
OF_SAMPLE = "SELECT {0}, n, n AS slots, n AS keys, n - 1 AS last FROM sizes"


@query(f"{ROUTES}, sizes AS (SELECT pool, least(count(*), CASE pool {SIZE_CASES} END) AS n FROM routes GROUP BY pool) {OF_SAMPLE.format('pool')}")
def reservoir_sizes(spark, sf_dir):
    members = written(R.routed(_unique(spark, sf_dir), FAMILIES, POOL_HARD).select("pool", "ordinal"), "members")  # so the texts are read once
    return _of_sample(_reservoirs(members).join(members, ["pool", "ordinal"]), "pool", "ordinal")


@query(f"{TAGS}, sizes AS (SELECT {CLASS_OF} AS class_label, least(count(*), 100) AS n FROM uniques GROUP BY 1) {OF_SAMPLE.format('class_label')}")
def labelled_sizes(spark, sf_dir):
    members = written(V.labelled(spark, sf_dir).select("class_label", "sequence_sha256"), "members")  # so the texts are read once
    return _of_sample(_labelled(members).join(members, ["class_label", "sequence_sha256"]), "class_label", "sequence_sha256")


def _audit_sql(table: str, key: str, text: str) -> str:
    tests = [f"SELECT {key}, '{reason}' AS reason FROM t WHERE regexp_matches(text, '{pattern.replace(chr(39), chr(39) * 2)}')" for pattern, reason in audit.PATTERNS]
    return f"WITH t AS (SELECT {key}, coalesce({text}, '') || ' ' || {V.audit_sample(key)} AS text FROM {table}) " + " UNION ALL ".join(tests)


@query(_audit_sql("documents", "doc_id", "text"))
def content_audit(spark, sf_dir):
    return audit.audit_texts(V.audited(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")


@query(_audit_sql("pages", "page_id", "html"))
def page_audit(spark, sf_dir):
    return audit.audit_texts(V.audited(spark, sf_dir, "pages", "page_id", "html"), "page_id")


@query("""SELECT 'part' || CAST(p_partkey AS VARCHAR) AS name, CAST(length(substr(regexp_replace(p_name, '[^A-Za-z]', '', 'g'), 1, 6)) AS INTEGER) AS match_states,
CAST(20 * length(substr(regexp_replace(p_name, '[^A-Za-z]', '', 'g'), 1, 6)) AS INTEGER) AS probabilities FROM part""")
def profile_catalogue(spark, sf_dir):
    """A library with a model for each part, written as text and parsed again by tasks."""
    path = table_path(spark, "library")
    parts = V.table(spark, sf_dir, "part").select(F.concat(F.lit("part"), "p_partkey").alias("name"), F.upper(F.substring(F.regexp_replace("p_name", "[^A-Za-z]", ""), 1, 6)).alias("letters"))
    profiles.written_models(parts).write.text(path)
    return profiles.read_profiles(spark, path).select("name", "match_states", F.size("match").alias("probabilities"))


@query()
def profile_scan(spark, sf_dir):
    from ..search import kernel, model

    # one profile for each nation, a table of fixed size
    names = [r[0] for r in V.table(spark, sf_dir, "nation").select(F.upper(F.regexp_replace("n_name", "[^A-Za-z]", ""))).distinct().orderBy(F.lit(1)).collect()]
    turns = V.table(spark, sf_dir, "conversations")
    records = turns.select(F.concat_ws(":", "conv_id", "turn").alias("target_id"), F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("sequence"))
    return kernel.search_frame(records, [model.consensus_profile(n, n) for n in names if n], {"Z": float(len(names)), "iE": 10.0, "coverage": 0.0})
