"""Quality rules: decision lists learned by sequential covering, emitted as one ordered Spark conditional.

Statistics of every whole text come from one Arrow pass. A bounded sample of labelled rows (FIT_ROWS, by hash of the
doc_id, so the same rows each time) trains the list on the driver: conjunctions of thresholds that cover documents of
quality 0 grow by information gain on two thirds of the sample and are pruned on the rest (RIPPER style). The list then
is a CASE expression over statistics columns, evaluated in the JVM for all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .storage import prepare, written
from .words import Slice, covered, mix, repeated, slices

FIT_ROWS = 20_000
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
MAX_RULES, MAX_CONDITIONS, MIN_PRECISION, CUTS = 16, 3, 0.9, 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks", "n_distinct"]
STATISTICS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
SYMBOLS, UPPER, LETTERS, MARKS, CONTINUES, BLANK = (np.zeros(256, dtype=bool) for _ in range(6))
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER[65:91] = True
LETTERS[65:91] = LETTERS[97:123] = True
MARKS[list(b"!?")] = True
CONTINUES[0x80:0xC0] = True
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: The features of the rules, as SQL over the counts.
FEATURES = {
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(n_letters, 1)",
    "words": "cast(n_words as double)",
}


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])


def slice_statistics(part: Slice) -> np.ndarray:
    """One row of COUNTS for each document."""
    n, words = part.documents, part.counts()
    out = np.zeros((n, len(COUNTS)), dtype=np.int64)
    out[:, 0] = words
    out[:, 1] = _sums(~(CONTINUES | BLANK)[part.data], part.bounds)
    out[:, 2] = _sums(SYMBOLS[part.data], part.bounds)
    for d in range(n):
        if words[d]:
            lines = [x for x in part.text(d).split(b"\n") if x.strip()]
            out[d, 5] = len(lines)
            out[d, 3] = len(lines) - len(set(lines))
    for column, table in ((6, UPPER), (7, LETTERS), (8, MARKS)):
        out[:, column] = _sums(table[part.data], part.bounds)
    hashes = part.word_hashes()
    owner = np.repeat(np.arange(n), words)
    salt = mix(np.arange(1, n + 1, dtype=np.uint64))  # words of different documents never meet
    if len(hashes):
        own = hashes ^ salt[owner]
        order = np.argsort(own, kind="stable")
        heads = np.concatenate([[True], own[order][1:] != own[order][:-1]])
        out[:, 9] = np.bincount(owner[order][heads], minlength=n)
    first, found = part.window_hashes(hashes, REPEAT_WINDOW)
    if len(first):
        twice = repeated(found ^ salt[owner[first]])
        out[:, 4] = np.bincount(owner, weights=covered(first[twice], REPEAT_WINDOW, len(hashes)), minlength=n).astype(np.int64)
    return out


@F.arrow_udf(STATISTICS)
def text_statistics(texts: pa.Array) -> pa.Array:
    found = [slice_statistics(part) for part in slices(texts)]
    table = np.concatenate(found) if found else np.zeros((0, len(COUNTS)), dtype=np.int64)
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(COUNTS))], names=COUNTS)


def with_statistics(docs: DataFrame, name: str = "statistics") -> DataFrame:
    """docs with a struct of COUNTS of its text; null counts as the empty text."""
    prepare(docs.sparkSession)
    return docs.withColumn(name, text_statistics(F.coalesce("text", F.lit(""))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.feature] >= self.cut if self.above else table[self.feature] <= self.cut

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>=' if self.above else '<='} {self.cut!r}D"


Rule = tuple[Condition, ...]


def covers(rule: Rule, table: dict[str, np.ndarray]) -> np.ndarray:
    return np.logical_and.reduce([c.holds(table) for c in rule])


def _grow(table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds the condition of highest information gain until only bad rows are covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < MAX_CONDITIONS and not bad[inside].all():
        before = np.log2(bad[inside].mean())
        best, gain = None, 0.0
        for feature, values in table.items():
            order = np.argsort(values[inside], kind="stable")
            v, b = values[inside][order], bad[inside][order]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, CUTS), method="nearest"))
            low, hits = np.searchsorted(v, cuts), np.concatenate([[0], np.cumsum(b)])
            high = np.searchsorted(v, cuts, side="right")
            for above, p, n in ((True, hits[-1] - hits[low], len(v) - low), (False, hits[high], high)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(p > 0, p * (np.log2(p / np.maximum(n, 1)) - before), 0.0)
                if gains.max() > gain + 1e-9:
                    gain, best = float(gains.max()), Condition(feature, above, float(cuts[gains.argmax()]))
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(table)
    return tuple(rule)


def _worth(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> float:
    inside = covers(rule, table)
    p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(table: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """An ordered list of rules for bad rows; without bad or good rows it is empty and every document passes."""
    rules: list[Rule] = []
    held = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), dtype=bool)
    least = max(3, int(0.002 * len(bad)))
    while len(rules) < MAX_RULES and bad[left & ~held].sum() >= least and (~bad[left & ~held]).any():
        part = lambda mask: ({k: v[mask] for k, v in table.items()}, bad[mask])
        rule = _grow(*part(left & ~held))
        if not rule:
            break
        check = part(left & held)
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (_worth(r, *check), -len(r)))
        inside = covers(rule, table) & left
        if bad[inside].sum() < least or bad[inside].mean() < MIN_PRECISION or (inside & held).any() and bad[inside & held].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list over columns of COUNTS: false where a rule holds, else true."""
    out: Column | None = None
    for rule in rules:
        condition = F.expr(" and ".join(c.sql() for c in rule))
        out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words")


def fit(statistics: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> list[Rule]:
    """Learns from at most rows labelled rows; statistics has doc_id and COUNTS, labels doc_id and quality."""
    labels = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    labelled = statistics.join(labels, "doc_id").withColumn("order", F.xxhash64("doc_id", *COUNTS))
    # in a fixed order that has nothing to do with how the rows are stored; most rows beyond the bound drop out where
    # they lie, so tasks send the driver little more than the sample
    share = 1.5 * rows / max(labels.count(), 1)
    if share < 1:
        labelled = labelled.filter(F.pmod("order", F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = labelled.orderBy(F.pmod("order", F.lit(1 << 30)), "order", "doc_id").limit(rows)
    found = sample.select("quality", *(F.expr(e).alias(f) for f, e in FEATURES.items())).toPandas()
    return learn({f: found[f].to_numpy(dtype=float) for f in FEATURES}, found["quality"].to_numpy() == 0)


def quality_verdicts(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept for every row of docs(doc_id, text).

    A null or empty text has no words and fails the base rules. Rows without doc_id and repeated rows get their verdict
    like others; labels without doc_id or quality are left out, of several the highest counts.
    """
    counted = written(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics.*"), "statistics", merge=False)
    rules = fit(counted, labels, fit_rows)
    return counted.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def quality_filter(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of docs that quality_verdicts keeps, with their own columns."""
    labels = labels.select("doc_id", "quality")
    labelled = docs.select("doc_id", "text").join(labels.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    rules = fit(with_statistics(labelled).select("doc_id", "statistics.*"), labels, fit_rows)
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    counted = with_statistics(docs.select("text", own)).select("row", "statistics.*")
    return counted.filter(~base_failed() & verdict(rules)).select("row.*")
