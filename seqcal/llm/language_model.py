"""Quality classifier: interpolated modified Kneser-Ney model of bytes, trained on trusted text of each language.

A document is one stream of bytes in lower case with one space for every run of white space and at its end; a symbol's
probability follows from the ORDER - 1 before it, over the ends of words. Plan: (1) one pass counts the n-grams of the
trusted documents, but for a held-out fifth, each task's sums meeting in one shuffle; (2) continuation counts, discounts
(Chen and Goodman, 1999), back-off weights and probabilities are group-bys and joins on the n-gram tables; (3) the
model is dealt to shards by the last two symbols of the context, about SHARD_ROWS rows in each, and the shards are
joined one after another with the documents' n-grams where these lie: a pass adds up the log-probabilities of one shard,
and a sum over the shards gives each document's perplexity. (4) Quantiles of a language's held-out documents bound the
perplexity by symbol from above, where scrambled text is, and that by word on both sides, as repetition is below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .storage import prepare, row_key, written
from .words import LOWER, SPACE, Slice, slices

ORDER, SYMBOL_BITS, START, BLANK, SYMBOLS = 5, 8, 0x09, 0x20, 256
MOST, WORD_LEAST, WORD_MOST = 0.99, 0.005, 0.995  # quantiles
HELD_OUT, SHARD_ROWS, COUNT_SLICE = 5, 1_000_000, 1 << 20

GRAMS = "lang string, gram long, n long"


def stream_grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(packed n-grams of ORDER symbols, document) of every symbol of a slice; a document without words has none."""
    inside = ~SPACE[part.data]
    inside[part.ends[part.ends < len(part.data)]] = True  # the space behind a word
    document = np.repeat(np.arange(part.documents), np.diff(part.bounds))
    last = part.ends[part.first_word[1:][part.counts() > 0] - 1]
    symbol, owner = np.where(SPACE[part.data], BLANK, part.data)[inside], document[inside]
    # a text that ends with a word gets its last space, and no other text's first byte is one
    place = np.cumsum(np.concatenate([[0], inside]))
    at = place[last]
    bare = np.ones(len(last), dtype=bool)
    within = last < part.bounds[1:][part.counts() > 0]
    bare[within] = False
    symbol = np.insert(symbol, at[bare], BLANK)
    owner = np.insert(owner, at[bare], np.flatnonzero(part.counts() > 0)[bare])
    gram = symbol.astype(np.int64)
    for back in range(1, ORDER):
        before = np.full(len(symbol), START, dtype=np.int64)
        same = owner[back:] == owner[:-back]
        before[back:][same] = symbol[:-back][same]
        gram |= before << (SYMBOL_BITS * back)
    return gram, owner


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        codes, names = langs.indices.to_numpy(zero_copy_only=False), pa.array(langs.dictionary, pa.string())
        for part in slices(batch["text"], table=LOWER, limit=COUNT_SLICE):
            gram, owner = stream_grams(part)
            counts = pc.value_counts(pa.array(gram | codes[part.first_row + owner].astype(np.int64) << (SYMBOL_BITS * ORDER)))
            both, n = (counts.field(i).to_numpy() for i in (0, 1))
            yield pa.RecordBatch.from_arrays([names.take(pa.array(both >> (SYMBOL_BITS * ORDER))), pa.array(both & ((1 << (SYMBOL_BITS * ORDER)) - 1)), pa.array(n)], names=["lang", "gram", "n"])


def gram_counts(trusted: DataFrame) -> DataFrame:
    """lang, gram, n of the ORDER-grams of trusted(lang, text)."""
    prepare(trusted.sparkSession)
    texts = trusted.select("lang", F.coalesce("text", F.lit("")).alias("text")).filter("lang is not null")
    return texts.mapInArrow(_count, GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def lower_counts(grams: DataFrame, order: int) -> DataFrame:
    """Continuation counts of order - 1: in how many contexts a gram stands; grams at a text's start keep their counts."""
    keep = (1 << (SYMBOL_BITS * (order - 1))) - 1
    shorter = F.col("gram").bitwiseAND(F.lit(keep))
    start = (F.shiftright(shorter, SYMBOL_BITS * (order - 2)) == START) if order > 2 else F.lit(False)
    return grams.groupBy("lang", shorter.alias("gram")).agg(F.sum(F.when(start, F.col("n")).otherwise(1)).alias("n"))


def interpolated(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, gram, part), (lang, context, weight): discounted shares of a context and what is left for lower orders."""
    kinds = grams.groupBy("lang").agg(*(F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)))
    y = F.expr("if(n1 > 0, n1 / (n1 + 2 * n2), 0.5D)")

    def discount(i: int):
        return F.greatest(F.lit(0.05), F.least(F.lit(float(i)) - 0.05, F.coalesce(F.expr(f"{i} - {i + 1} * y * n{i + 1} / nullif(n{i}, 0)"), F.lit(i * 0.5))))

    discounts = kinds.withColumn("y", y).select("lang", *(discount(i).alias(f"d{i}") for i in (1, 2, 3)))
    rows = grams.withColumn("context", F.shiftright("gram", SYMBOL_BITS)).join(F.broadcast(discounts), "lang")  # a row for each language
    taken = F.expr("case n when 1 then d1 when 2 then d2 else d3 end")
    context = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum(taken).alias("left"))
    shares = rows.join(context, ["lang", "context"]).select("lang", "gram", ((F.col("n") - taken) / F.col("total")).alias("part"))
    return shares, context.select("lang", "context", (F.col("left") / F.col("total")).alias("weight"))


def model_table(trusted: DataFrame) -> DataFrame:
    """lang, kind, gram, value: log-probabilities of seen grams (kind: their order) and log-weights of contexts (kind:
    minus the order of the grams that they begin)."""
    counts = {ORDER: written(gram_counts(trusted), "grams")}
    for order in range(ORDER, 1, -1):
        counts[order - 1] = written(lower_counts(counts[order], order), "grams")
    out, below = None, None
    for order in range(1, ORDER + 1):
        shares, weights = interpolated(counts[order])
        if below is None:
            known = shares.join(weights.select("lang", "weight"), "lang").select("lang", "gram", (F.col("part") + F.col("weight") / SYMBOLS).alias("p"))
        else:
            keep = (1 << (SYMBOL_BITS * (order - 1))) - 1
            lower = below.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("q"))
            joined = shares.withColumn("context", F.shiftright("gram", SYMBOL_BITS)).withColumn("shorter", F.col("gram").bitwiseAND(F.lit(keep)))
            known = joined.join(weights, ["lang", "context"]).join(lower, ["lang", "shorter"]).select("lang", "gram", (F.col("part") + F.col("weight") * F.col("q")).alias("p"))
        below = written(known, "probabilities")
        rows = below.select("lang", F.lit(order).alias("kind"), "gram", F.log("p").alias("value"))
        rows = rows.union(weights.select("lang", F.lit(-order).alias("kind"), F.col("context").alias("gram"), F.log("weight").alias("value")))
        out = rows if out is None else out.union(rows)
    return out


def _pair_shard(pair: np.ndarray, shards: int) -> np.ndarray:
    """The shard of two symbols; shard_of says it to Spark."""
    return (pair * 40503 >> 4) % shards


def shard_of(shards: int) -> Column:
    gram = F.when(F.col("kind") < 0, F.col("gram")).otherwise(F.shiftright("gram", SYMBOL_BITS))
    return F.shiftright(gram.bitwiseAND(F.lit((1 << 2 * SYMBOL_BITS) - 1)) * 40503, 4) % shards


class Shard:
    """Sorted (language, gram) keys with their values, by kind; owns the contexts whose last two symbols it is dealt."""

    def __init__(self, rows: pa.Table, number: int, shards: int):
        names = rows["lang"].combine_chunks().dictionary_encode()
        self.languages = {x: i for i, x in enumerate(names.dictionary.to_pylist())}
        self.number, self.shards = number, shards
        lang, (kind, gram, value) = names.indices.to_numpy().astype(np.int64), (rows[c].to_numpy() for c in ("kind", "gram", "value"))
        self.tables = {}
        for k in np.unique(kind).tolist():
            own = kind == k
            keys = self.pack(lang[own], gram[own])
            order = np.argsort(keys)
            self.tables[k] = keys[order], value[own][order]

    @staticmethod
    def pack(language: np.ndarray, gram: np.ndarray) -> np.ndarray:
        return language << (SYMBOL_BITS * ORDER) | gram

    def find(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = self.tables.get(kind, (np.empty(0, np.int64), np.empty(0)))
        if not len(known):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, values[at].astype(float)

    def log_probability(self, language: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """Of each gram's last symbol after the others, with back-off; 0 for contexts of other shards."""
        out = np.zeros(len(gram))
        open_ = np.flatnonzero(_pair_shard(gram >> SYMBOL_BITS & (1 << 2 * SYMBOL_BITS) - 1, self.shards) == self.number)
        for order in range(ORDER, 0, -1):
            g, lang = gram[open_] & (1 << SYMBOL_BITS * order) - 1, language[open_]
            seen, value = self.find(order, self.pack(lang, g))
            out[open_[seen]] += value[seen]
            open_, g, lang = open_[~seen], g[~seen], lang[~seen]
            known, weight = self.find(-order, self.pack(lang, g >> SYMBOL_BITS))
            out[open_[known]] += weight[known]
        out[open_] -= np.log(SYMBOLS)  # a symbol that no trusted text has
        return out


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: Shard = shared.value
        for batch in batches:
            codes = np.array([shard.languages.get(x, -1) for x in batch["lang"].to_pylist()], dtype=np.int64)
            totals, symbols, words = np.zeros(len(codes)), np.zeros(len(codes), dtype=np.int64), []
            for part in slices(batch["text"], table=LOWER, limit=COUNT_SLICE):
                gram, owner = stream_grams(part)
                owner = owner + part.first_row
                symbols += np.bincount(owner, minlength=len(codes))
                words.append(part.counts())
                some = codes[owner] >= 0
                distinct = pa.array(Shard.pack(codes[owner[some]], gram[some])).dictionary_encode()
                both, inverse = distinct.dictionary.to_numpy(), distinct.indices.to_numpy()
                score = shard.log_probability(both >> (SYMBOL_BITS * ORDER), both & ((1 << SYMBOL_BITS * ORDER) - 1))
                totals += np.bincount(owner[some], weights=score[inverse], minlength=len(codes))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], batch["lang"], pa.array(np.concatenate([np.empty(0, np.int64), *words])), pa.array(symbols), pa.array(totals, mask=codes < 0)], names=["doc_id", "key", "lang", "n_words", "n_symbols", "log_probability"])

    return run


def perplexities(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, lang, n_words, n_symbols and the perplexity by symbol and by word for every row of docs(doc_id, text, lang);
    null without words or model."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", row_key("doc_id", "text", "lang"))
    shards = max(1, -(-model.count() // SHARD_ROWS))
    parts = []
    for number in range(shards):  # one shard at a time on the driver and the executors; orders 1 and 2 are in each
        rows = model.filter((F.abs("kind") <= 2) | (shard_of(shards) == number)).select("lang", F.col("kind").cast("int").alias("kind"), "gram", F.col("value").cast("float").alias("value")).toArrow()
        shard = spark.sparkContext.broadcast(Shard(rows, number, shards))
        parts.append(written(texts.mapInArrow(_score(shard), "doc_id long, key binary, lang string, n_words long, n_symbols long, log_probability double"), "scores", merge=False).withColumn("number", F.lit(number)))
        shard.unpersist()
    out = parts[0].select("doc_id", "key", "lang", "n_words", "n_symbols")
    for part in parts[1:]:
        parts[0] = parts[0].union(part)
    total = parts[0].groupBy("key", "number").agg(F.max("log_probability").alias("l")).groupBy("key").agg(F.sum("l").alias("l"))  # repeated rows have one key
    by = lambda n: F.when(F.col(n) > 0, F.exp(-F.col("l") / F.col(n)))
    return out.join(total, "key").select("doc_id", "lang", "n_words", "n_symbols", by("n_symbols").alias("perplexity"), by("n_words").alias("word_perplexity"))


def good_labels(labels: DataFrame) -> DataFrame:
    """doc_id of the documents that a label calls good and none calls bad or toxic."""
    return labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.expr("quality = 1 and coalesce(toxic, 0) = 0")).alias("good")).filter("good").select("doc_id")


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a good label.

    Labels grow with the documents, so this is one shuffle of the texts at every size and never a broadcast.
    """
    return docs.join(good_labels(labels).hint("merge"), "doc_id", "left_semi")


def held_out() -> Column:
    """Whether a document is one of the fifth that the model isn't trained on."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0


def quality_by_perplexity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_words, n_symbols, perplexity, word_perplexity, most, word_least, word_most, kept for every row of
    docs(doc_id, text, lang).

    A document is kept if its perplexities are within the quantiles MOST, WORD_LEAST and WORD_MOST of its language's
    trusted documents (labels: quality 1, not toxic); for the upper bounds of the held-out ones where there are any. Null and empty texts
    have no perplexity and aren't kept; a language without trusted documents, also a null one, has no quantiles and its
    documents are kept. Repeated rows are scored alike.
    """
    docs = docs.select("doc_id", "text", "lang")
    model = written(model_table(trusted_documents(docs, labels).filter(~held_out())), "model")
    scored = written(perplexities(docs, model), "perplexities")
    known = trusted_documents(scored, labels).filter("perplexity is not null")

    def level(column: str, q: float) -> Column:
        return F.coalesce(F.percentile_approx(F.when(held_out(), F.col(column)), q, 10_000), F.percentile_approx(column, q, 10_000))

    # documents that the model was trained on are below held-out ones, so the lower bound is that of all
    least = F.percentile_approx("word_perplexity", WORD_LEAST, 10_000)
    levels = known.groupBy("lang").agg(level("perplexity", MOST).alias("most"), least.alias("word_least"), level("word_perplexity", WORD_MOST).alias("word_most"))
    within = F.expr("perplexity <= most and word_perplexity between word_least and word_most")
    kept = (F.col("n_symbols") > 0) & F.coalesce(within, F.lit(True))
    return scored.join(levels, "lang", "left").select(*scored.columns, "most", "word_least", "word_most", kept.alias("kept"))
