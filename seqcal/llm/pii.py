"""PII: patterns find protected entities; corpus co-occurrence finds the terms that give them away.

A term is a word without ASCII punctuation at its ends. (1) One pass over the texts finds entities, the terms within
CONTEXT words of each and the distinct terms of every document that has an entity. (2) Pairs of a term and an entity are
counted by mentions and, for entities of MIN_SUPPORT documents or more, by documents, one for all terms and one for all
entities that stand in the same documents. For pairs that meet MIN_SUPPORT
times or more, and that may disclose by what these documents tell, a second pass counts every occurrence of the term in
the corpus and its documents; a bit array of fixed size lets it skip other words, an exact join follows. (3) A term discloses an entity if it seldom stands elsewhere,
p(entity | term) >= GENERALISE, and says much about it, log2(p(entity | term) / p(entity)) >= MIN_BITS, by mentions or
by documents. (4) A third pass, by bit array and exact join again, finds every occurrence of such terms in the corpus;
they are generalised, or removed from REMOVE on. No text is shuffled to find spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .storage import prepare, row_key, written
from .words import U64, Slice, byte_hashes, fresh_key, mix, slices

KINDS = ("email", "ip", "card", "phone", "term")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
MARGIN = "".join(chr(b) for b in range(0x21, 0x7F) if not chr(b).isalnum())
PUNCTUATION = np.isin(np.arange(256), [ord(c) for c in MARGIN])

CONTEXT, MIN_SUPPORT, GENERALISE, REMOVE, MIN_BITS = 5, 3, 0.5, 0.8, 6.0
LEAST_BITS, MOST_BITS, BITS_EACH, BIT_GROUP, SUMS_HELD, FIRST_SLICE = 1 << 20, 1 << 29, 16, 1 << 12, 500_000, 32
MARKED = ["mark_a", "mark_b", "mark_c", "mark_d"]  # halves of two random marks of a row
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

FOUND = "doc_id long, key binary, entities array<struct<rank: int, start: int, stop: int>>, near array<struct<term: long, entity: long>>, own array<long>, terms array<long>, n_words long"


def luhn(digits: str) -> bool:
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each @ has one longest local part before it, so no start needs a second try."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers each of every run of numbers with a dot between; no start inside a run can match if the run does not."""
    for m in DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            own = parts[k : k + 4]
            stop = at + sum(map(len, own)) + 3
            if all(len(x) <= 3 and int(x) <= 255 or not x.lstrip("0") or len(x.lstrip("0")) <= 3 and int(x.lstrip("0")) <= 255 for x in own):
                yield at, stop
            at = stop + 1


def entities(text: str) -> list[tuple[int, int, int]]:
    """(rank in KINDS, start, stop) of every protected entity, by rank and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(1, a, b) for a, b in addresses(text)]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() < 40 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15] if "+" in text else []
    return out


def _hashes(values: list[str]) -> np.ndarray:
    """Of strings in which white space is taken out, as each is one word to the kernel."""
    out = [np.empty(0, dtype=np.uint64)]
    for part in slices(pa.array([re.sub(r"[\x20\x09-\x0D]", "", v) for v in values], pa.string()), lower=True):
        out.append(part.word_hashes())
    return np.concatenate(out).view(np.int64)


def _terms(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, whether it is a term, first byte, end) of every word of a slice; words of punctuation alone are no terms."""
    n = len(part.data)
    inner = ~PUNCTUATION[part.data]
    after = np.minimum.accumulate(np.where(inner, np.arange(n), n)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(inner, np.arange(n), -1))
    starts, ends = after[part.starts], before[part.ends - 1] + 1
    some = starts < ends
    return byte_hashes(part.data, starts, np.maximum(starts, ends)), some, starts, ends


def _places(part: Slice, d: int, found: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends in the slice of the entities of its document d."""
    low, high = part.bounds[d], part.bounds[d + 1]
    points = np.append(np.flatnonzero((part.data[low:high] & 0xC0) != 0x80), high - low) + low
    return points[[x[1] for x in found]], points[[x[2] for x in found]]


def _met(part: Slice, d: int, places: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which words of document d overlap one of its entities."""
    starts, ends = (x[part.first_word[d] : part.first_word[d + 1]] for x in (part.starts, part.ends))
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(change, np.searchsorted(ends, places[0], side="right"), 1)
    np.add.at(change, np.searchsorted(starts, places[1]), -1)
    return np.cumsum(change[:-1]) > 0


def _nearby(part: Slice, d: int, places: tuple[np.ndarray, np.ndarray], free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word of the document, entity) for the words within CONTEXT words of an entity that are free, by entity. A word
    that touches an entity is part of it."""
    starts, ends = (x[part.first_word[d] : part.first_word[d + 1]] for x in (part.starts, part.ends))
    before, after = np.searchsorted(ends, places[0]), np.searchsorted(starts, places[1], side="right")
    word = np.concatenate([before[:, None] - 1 - np.arange(CONTEXT), after[:, None] + np.arange(CONTEXT)], axis=1).ravel()
    entity = np.repeat(np.arange(len(before)), 2 * CONTEXT)
    some = (word >= 0) & (word < len(starts))
    some[some] = free[word[some]]
    return word[some], entity[some]


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    bounds = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.empty(0, np.int64), *values])))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.empty(0, dtype=np.int64)
    for batch in batches:
        texts = batch["text"].to_pylist()
        found = [entities(x) for x in texts]
        bounds = np.cumsum([0, *map(len, found)])
        values = _hashes([f"{KINDS[k]}:{x[a:b]}" for x, f in zip(texts, found, strict=True) for k, a, b in f])
        near_term, near_entity, terms, words = [none] * len(texts), [none] * len(texts), [none] * len(texts), []
        for part in slices(batch["text"], lower=True):
            words.append(part.counts())
            mine = [d for d in range(part.documents) if found[part.first_row + d]]
            if not mine:
                continue
            hashes, some, _, _ = _terms(part)
            for d in mine:
                row, own = part.first_row + d, slice(part.first_word[d], part.first_word[d + 1])
                places = _places(part, d, found[row])
                free = some[own] & ~_met(part, d, places)
                word, entity = _nearby(part, d, places, free)
                near_term[row], near_entity[row] = hashes[own][word].view(np.int64), values[bounds[row] + entity]
                terms[row] = np.unique(hashes[own][free]).view(np.int64)
        flat = [np.array([x[i] for f in found for x in f], dtype=np.int32) for i in range(3)]
        spans = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays([pa.array(x) for x in flat], names=["rank", "start", "stop"]))
        near, entity = _lists(near_term), _lists(near_entity)
        near = pa.ListArray.from_arrays(near.offsets, pa.StructArray.from_arrays([near.values, entity.values], names=["term", "entity"]))
        own = _lists([np.unique(values[a:b]) for a, b in zip(bounds, bounds[1:])])
        n_words = pa.array(np.concatenate([none, *words]).astype(np.int64))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], spans, near, own, _lists(terms), n_words], names=["doc_id", "key", "entities", "near", "own", "terms", "n_words"])


class Bits:
    """A bit array that tells most values that were not put in from those that were."""

    def __init__(self, size: int):
        self.size, self.table = size, np.zeros(size // 8, dtype=np.uint8)

    def places(self, values: np.ndarray) -> np.ndarray:
        return (mix(values.view(np.uint64)) % U64(self.size)).astype(np.int64)

    def has(self, values: np.ndarray) -> np.ndarray:
        at = self.places(values)
        return (self.table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _bits_of(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Bits(size)
        for batch in batches:
            at = bits.places(batch["term"].to_numpy(zero_copy_only=False).copy())
            yield pa.RecordBatch.from_arrays([pa.array(at // BIT_GROUP), pa.array((at % BIT_GROUP).astype(np.int32))], names=["part", "at"])

    return run


def _bits(values: DataFrame) -> Bits:
    """Bits of all values(term), BITS_EACH for each up to MOST_BITS; beyond that more values pass, and joins stay exact."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << int(values.count() * BITS_EACH).bit_length()))
    parts = values.distinct().mapInArrow(_bits_of(size), "part long, at int").groupBy("part").agg(F.collect_set("at").alias("at"))
    bits = Bits(size)
    for row in parts.toLocalIterator():  # of BIT_GROUP bits each
        at = row.part * BIT_GROUP + np.array(row.at)
        np.bitwise_or.at(bits.table, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits


class Sums:
    """Sums of numbers by key, of a bounded number of keys at a time."""

    def __init__(self, keys: list[str], values: list[str]):
        self.names, self.n_keys, self.parts, self.held, self.summed = keys + values, len(keys), [], 0, 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(np.stack([x.view(np.int64) for x in columns]))
        self.held += len(columns[0])
        if self.held > self.summed + SUMS_HELD:
            self._sum()
            if self.held > SUMS_HELD:
                yield from self.rest()

    def _sum(self) -> None:
        rows = np.concatenate(self.parts, axis=1) if self.parts else np.empty((len(self.names), 0), dtype=np.int64)
        keys = rows[: self.n_keys]
        order = np.lexsort(keys)
        rows, keys = rows[:, order], keys[:, order]
        heads = np.flatnonzero(np.append(np.ones(min(1, keys.shape[1]), dtype=bool), (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        sums = [np.add.reduceat(x, heads) if len(heads) else x for x in rows[self.n_keys :]]
        self.parts, self.held = [np.concatenate([keys[:, heads], np.stack(sums)])], len(heads)
        self.summed = self.held

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._sum()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in self.parts[0]], names=self.names)
        self.parts, self.held, self.summed = [], 0, 0


def _count(shared):
    """term, n, docs: occurrences and rows of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: Bits = shared.value
        sums = Sums(["term"], ["n", "docs"])
        for batch in batches:
            for part in slices(batch["text"], lower=True):
                hashes, some, _, _ = _terms(part)
                some = np.flatnonzero(some)
                some = some[bits.has(hashes[some])]
                hashes, document = hashes[some], part.documents_of(some)
                order = np.lexsort((hashes, document))
                hashes, document = hashes[order], document[order]
                fresh = np.ones(len(hashes), dtype=np.int64)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1])
                yield from sums.add(hashes, np.ones(len(hashes), dtype=np.int64), fresh)
        yield from sums.rest()

    return run


def _postings(shared):
    """term, docs and sums of the rows' marks, of rows with an entity that has a bit, summed in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: Bits = shared.value
        sums = Sums(["term"], ["docs", *MARKED])
        for batch in batches:
            marks = np.array([batch[c].to_numpy() for c in MARKED])
            for row, (t, e) in enumerate(zip(batch["terms"], batch["own"], strict=True)):
                t, e = t.values.to_numpy(), e.values.to_numpy()
                if len(t) and bits.has(e).any():
                    yield from sums.add(t, np.ones(len(t), dtype=np.int64), *(np.full(len(t), x) for x in marks[:, row]))
        yield from sums.rest()

    return run


def _document_pairs(terms, entities):
    """term, entity, docs of the rows' terms and entities that have bits, summed in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["term", "entity"], ["docs"])
        for batch in batches:
            for t, e in zip(batch["terms"], batch["own"], strict=True):
                t, e = t.values.to_numpy(), e.values.to_numpy()
                t, e = t[terms.value.has(t)], e[entities.value.has(e)]
                for value in e if len(t) else ():
                    yield from sums.add(t, np.full(len(t), value), np.ones(len(t), dtype=np.int64))
        yield from sums.rest()

    return run


def _occurrences(shared):
    """key, term, start, stop of the terms that have a bit, none that overlaps an entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: Bits = shared.value
        for batch in batches:
            row, term, start, stop = ([np.empty(0, dtype=np.int64)] for _ in range(4))
            for part in slices(batch["text"], lower=True):
                hashes, some, starts, ends = _terms(part)
                some &= bits.has(hashes)
                document = part.documents_of(np.flatnonzero(some))
                for d in np.unique(document).tolist():
                    own = slice(part.first_word[d], part.first_word[d + 1])
                    found = entities(batch["text"][part.first_row + d].as_py())
                    if found:
                        some[own] &= ~_met(part, d, _places(part, d, found))
                at = np.flatnonzero(some)
                if not len(at):
                    continue
                document = part.documents_of(at)
                points = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])  # code points before each byte
                base = points[part.bounds[document]]
                row.append(document + part.first_row)
                term.append(hashes[at].view(np.int64))
                start.append(points[starts[at]] - base)
                stop.append(points[ends[at]] - base)
            keys = batch["key"].take(pa.array(np.concatenate(row)))
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate(term)), *(pa.array(np.concatenate(x).astype(np.int32)) for x in (start, stop))], names=["key", "term", "start", "stop"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", row_key("doc_id", "text"))


def _by_document(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """entity, seen of all entities; term, both, seen, held: in how many rows a term stands with an entity of so many rows;
    and term, held: in how many rows with an entity of MIN_SUPPORT rows a term stands, where these are MIN_SUPPORT.

    Terms that stand in the same rows have the same counts, and so have such entities. Each set of rows is named by its
    size and sums of random marks of its rows; only the first term and the first entity of a set are counted with each
    other, row by row, and the counts go to all terms of the set. So copies of a text, of however many terms and
    entities, cost one pair a copy.
    """
    context = found.sparkSession.sparkContext
    marks = []
    for i in range(0, len(MARKED), 2):
        mark = f"xxhash64({fresh_key() >> 1}L, key)"
        marks += [F.expr(f"{mark} & 4294967295L").alias(MARKED[i]), F.expr(f"shiftrightunsigned({mark}, 32)").alias(MARKED[i + 1])]
    rows = found.filter("size(own) > 0").select("terms", "own", *marks)
    summed = [F.sum(c).alias(c) for c in MARKED]
    entity = written(rows.select(F.explode("own").alias("entity"), *MARKED).groupBy("entity").agg(F.count("*").alias("seen"), *summed), "seen")
    often = entity.filter(f"seen >= {MIN_SUPPORT}")
    postings = rows.mapInArrow(_postings(context.broadcast(_bits(often.select(F.col("entity").alias("term"))))), "term long, docs long, " + ", ".join(f"{c} long" for c in MARKED))
    terms = written(postings.groupBy("term").agg(F.sum("docs").alias("docs"), *summed).filter(f"docs >= {MIN_SUPPORT}"), "postings")
    first_terms = written(terms.groupBy("docs", *MARKED).agg(F.min("term").alias("first")), "first_terms")
    first_entities = written(often.groupBy("seen", *MARKED).agg(F.min("entity").alias("entity")).select("entity", "seen"), "first_entities")
    bits = [context.broadcast(_bits(x)) for x in (first_terms.select(F.col("first").alias("term")), first_entities.select(F.col("entity").alias("term")))]
    pairs = rows.select("terms", "own").mapInArrow(_document_pairs(*bits), "first long, entity long, docs long").groupBy("first", "entity").agg(F.sum("docs").alias("both")).filter(f"both >= {MIN_SUPPORT}")
    counts = pairs.join(first_entities, "entity").select("first", "both", "seen").distinct()
    sets = first_terms.join(counts, "first")
    held = terms.select("term", F.col("docs").alias("held"))
    return entity.select("entity", "seen"), terms.join(sets, ["docs", *MARKED]).select("term", "both", "seen", F.col("docs").alias("held")), held


def _tells(share: Column, prior: Column) -> Column:
    return (share >= GENERALISE) & (F.log2(share / prior) >= MIN_BITS)


def _totals(texts: DataFrame, terms: list[DataFrame], name: str) -> DataFrame:
    """term, n, docs of the terms (and of other words with their bits) in texts."""
    shared = texts.sparkSession.sparkContext.broadcast(_bits(terms[0].select("term").union(terms[1].select("term"))))
    return written(texts.select("text").mapInArrow(_count(shared), "term long, n long, docs long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), name)


def _candidates(found: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """term, together, prior by mentions and term, both, prior by documents, of pairs whose term may disclose its entity.

    The rows with entities, and then one of FIRST_SLICE rows of all, tell how often a term stands in the corpus at least,
    so at most what share is one entity's. A pair that could not disclose even so is left out, as its term's other
    occurrences only lower that share. So no result changes, but common words, which every task would count, are not
    counted in all texts: of a term that is, a slice holds no more than its pairs' own occurrences by 1 / GENERALISE.
    """
    entity, both, held = _by_document(found)
    rows, words = found.agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    share = lambda own, least: F.least(F.lit(1.0), F.col(own) / F.coalesce(*least))
    both = both.withColumn("prior", F.col("seen") / float(max(rows, 1)))
    both = written(both.filter(_tells(share("both", [F.col("held")]), F.col("prior"))).select("term", "both", "prior"), "both")
    near = found.select(F.explode("near").alias("x")).groupBy("x.term", "x.entity").agg(F.count("*").alias("together")).filter(f"together >= {MIN_SUPPORT}")
    near = near.join(entity, "entity").join(held, "term", "left").withColumn("prior", F.col("seen") * float(2 * CONTEXT) / float(max(words, 1)))
    near = written(near.filter(_tells(share("together", [F.col("held"), F.lit(1)]), F.col("prior"))).select("term", "together", "prior"), "near")
    slice_ = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_SLICE)) == 0)
    first = _totals(slice_, [near, both], "first_totals")
    near, both = near.join(first, "term", "left"), both.join(first, "term", "left")
    near = near.filter(_tells(share("together", [F.col("n"), F.lit(1)]), F.col("prior"))).select("term", "together", "prior")
    both = both.filter(_tells(share("both", [F.col("docs"), F.lit(1)]), F.col("prior"))).select("term", "both", "prior")
    return written(near, "near"), written(both, "both")


def disclosing(found: DataFrame, texts: DataFrame) -> DataFrame:
    """term, share: the terms that disclose an entity, with the greatest share of one."""
    near, both = _candidates(found, texts)
    totals = _totals(texts, [near, both], "totals")
    # one occurrence may stand near two mentions of an entity, so a share is 1 at most
    near = near.join(totals, "term").withColumn("share", F.least(F.lit(1.0), F.col("together") / F.col("n")))
    both = both.join(totals, "term").withColumn("share", F.least(F.lit(1.0), F.col("both") / F.col("docs")))
    shares = near.select("term", "share", "prior").union(both.select("term", "share", "prior"))
    return shares.filter(_tells(F.col("share"), F.col("prior"))).groupBy("term").agg(F.max("share").alias("share"))


def _term_spans(found: DataFrame, texts: DataFrame) -> DataFrame:
    """key and its term spans, of every occurrence in the corpus; rows that repeat have one key and the same spans."""
    terms = written(disclosing(found, texts), "disclosing")
    shared = texts.sparkSession.sparkContext.broadcast(_bits(terms.select("term")))
    places = texts.select("key", "text").mapInArrow(_occurrences(shared), "key binary, term long, start int, stop int")
    best = places.join(terms, "term").groupBy("key", "start", "stop").agg(F.max("share").alias("share"))
    return best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "stop", F.expr(f"share >= {REMOVE}D").alias("remove")))).alias("terms"))


def pii_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans for every row of docs(doc_id, text): arrays of (rank, start, stop), sorted, rank being the
    place in KINDS, offsets in code points, stop exclusive. base has the entities, spans also the disclosing terms. A
    null text is empty and has no spans; rows without doc_id and repeated rows are treated like others.
    """
    texts = _keyed(docs)
    found = written(texts.mapInArrow(_find, FOUND), "entities", merge=False)
    terms = _term_spans(found, texts)
    extra = F.expr("transform(coalesce(terms, array()), x -> named_struct('rank', 4, 'start', x.start, 'stop', x.stop))")
    joined = found.select("doc_id", "key", "entities").join(terms, "key", "left")
    return joined.select("doc_id", F.col("entities").alias("base"), F.array_sort(F.concat("entities", extra)).alias("spans"))


def spans_text(column: str):
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({column}, x -> concat({names}[x.rank], ':', x.start, ':', x.stop)), ',')")


def pii_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_term of every row."""
    count = lambda rank: F.expr(f"cast(size(filter(spans, x -> x.rank = {rank})) as bigint)")
    return pii_spans(docs).select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"))


def sanitised_text(text: str, terms: list[dict]) -> str:
    """Entities become their kind's mark, disclosing terms a general mark or nothing; overlapping spans one mark."""
    spans = sorted([(a, b, MARKS[KINDS[k]]) for k, a, b in entities(text)] + [(t["start"], t["stop"], "" if t["remove"] else MARKS["term"]) for t in terms])
    out, at = [], 0
    for start, stop, mark in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, stop)
    return "".join(out) + text[at:]


@F.arrow_udf(T.StringType())
def _sanitise(texts: pa.Array, terms: pa.Array) -> pa.Array:
    return pa.array([x if x is None else sanitised_text(x, t or []) for x, t in zip(texts.to_pylist(), terms.to_pylist(), strict=True)], pa.string())


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with entities and disclosing terms taken out of text; n_chars, if there is one, follows the text.

    A null text stays null. Other columns, rows without doc_id and repeated rows are kept as they are.
    """
    texts = _keyed(docs)
    found = written(texts.mapInArrow(_find, FOUND), "entities", merge=False)
    terms = _term_spans(found, texts)
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.select(own, "doc_id", F.coalesce("text", F.lit("")).alias("text")).select("row", row_key("doc_id", "text").alias("key"))
    clean = keyed.join(terms, "key", "left").withColumn("clean", _sanitise("row.text", "terms"))
    new = {"text": F.col("clean")} | ({"n_chars": F.length("clean").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return clean.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
