"""Labelled reference sets: parsed headers, merged duplicates, pools, samples and checksum manifests."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..shipping import ship
from . import checks, sampling

# Families whose members are hard negatives, and tags that are no label.
HARD_FAMILIES = ["CBM1", "CBM2", "CBM3", "CBM4", "CBM5", "CBM6", "CBM9", "CBM13", "CBM20", "CBM32", "CBM34", "CBM37", "CBM41", "CBM48", "CBM50", "CBM69", "GH13"]
AMBIGUOUS_TAGS = ["CBM0"]
POSITIVES, HARD, EASY, SEED = 1500, 12000, 3000, 20260923
CLASSES = ["positive", "hard_negative", "easy_negative"]


def family_names(families: list[str]) -> list[str]:
    """Sorted base families; no subfamily, none twice, one at least."""
    found = checks.unique_names(families, "families")
    for f in found:
        if not re.fullmatch(T.BASE_FAMILY.strip("^$"), f):
            raise checks.InputError(f"not a base family: {f}")
    return sorted(found)


def parsed(headers: DataFrame) -> DataFrame:
    """headers(ordinal, header, sequence) with accession, tags, clean sequence and digest."""
    fields, clean = T.header_fields(F.col("header")), T.normalised_sequence(F.col("sequence"))
    return headers.select("ordinal", T.header_accession(fields).alias("accession"), T.header_tags(fields).alias("tags"), clean.alias("sequence"), F.sha2(clean, 256).alias("sequence_sha256"))


def valid(headers: DataFrame, policy: str = "error") -> DataFrame:
    """headers without invalid sequences under policy exclude; raises on the first problem otherwise."""
    if policy not in ("error", "exclude"):
        raise checks.InputError("policy must be error or exclude")
    bad = T.sequence_problem(F.col("sequence"), F.col("header"))
    if policy == "exclude":
        headers = headers.filter(bad.isNull())
    checks.require(headers, F.coalesce(T.header_problem(F.col("header")), bad))
    return headers


def inconsistent_accessions(records: DataFrame) -> DataFrame:
    """Accessions that stand for more than one sequence."""
    return records.groupBy("accession").agg(F.min("sequence_sha256").alias("low"), F.max("sequence_sha256").alias("high")).filter("low <> high").select("accession")


def merged(records: DataFrame) -> DataFrame:
    """One row for each sequence: the first record's accession and ordinal, all records' tags, entries and whether the
    records' tag sets differ. Equal tag sets are merged before they meet in one row. The sequence is a value of its own, so
    who doesn't ask for it shuffles none."""
    first = F.struct("ordinal", "accession")
    sets = records.groupBy("sequence_sha256", "tags").agg(F.min(first).alias("first"), F.min_by("sequence", first).alias("sequence"), F.count("*").alias("entries"))
    whole = sets.groupBy("sequence_sha256").agg(F.min("first").alias("first"), F.min_by("sequence", "first").alias("sequence"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags")))).alias("tags"), F.sum("entries").alias("entries"), (F.count("*") > 1).alias("differing"))
    return whole.select(F.col("first.ordinal").alias("ordinal"), F.col("first.accession").alias("accession"), "tags", "sequence", "sequence_sha256", "entries", "differing")


def positive_entries(records: DataFrame, families: list[str]) -> DataFrame:
    """family, entries: records by their own tags, before duplicates are merged."""
    base = F.array_distinct(F.transform("tags", T.base_family))
    return records.select(F.explode(base).alias("family")).filter(F.col("family").isin(families)).groupBy("family").agg(F.count("*").alias("entries"))


def routed(unique: DataFrame, families: list[str], hard: list[str] | None = None) -> DataFrame:
    """unique with a row for each pool that it belongs to: positive:<family>, hard, or easy for what isn't hard."""
    is_hard = T.has_any_family(F.col("tags"), HARD_FAMILIES if hard is None else hard)
    is_easy = ~is_hard & (F.size("tags") > 0) & ~F.exists("tags", lambda t: t.startswith("CBM"))
    base = F.transform("tags", T.base_family)
    own = F.transform(F.array_intersect(F.array(*map(F.lit, families)), base), lambda f: F.concat(F.lit("positive:"), f))
    other = F.array_compact(F.array(F.when(is_hard, "hard"), F.when(is_easy, "easy")))
    return unique.withColumn("pool", F.explode(F.concat(own, other)))


@dataclass
class Pools:
    """records(pool, slot, accession, tags, sequence, sequence_sha256) and the counts of what they come from."""

    records: DataFrame
    families: list[str]
    positive_totals: dict[str, int]
    positive_unique_totals: dict[str, int]
    entries: int
    unique: int
    duplicate_entries: int
    differing_duplicates: int
    excluded: int
    seed: int


def build_pools(headers: DataFrame, families: list[str], positives: int = POSITIVES, hard: int = HARD, easy: int = EASY, seed: int = SEED, hard_families: list[str] | None = None, policy: str = "error") -> Pools:
    """Reservoirs of a labelled FASTA frame headers(ordinal, header, sequence), the same for any order of families."""
    for n, name in ((positives, "positives"), (hard, "hard pool size"), (easy, "easy pool size")):
        checks.whole_number(n, name, 1)
    if isinstance(seed, bool) or not isinstance(seed, int):
        raise checks.InputError("seed must be an integer")
    families = family_names(families)
    hard_families = HARD_FAMILIES if hard_families is None else family_names(list(hard_families))
    total = headers.count()
    kept = valid(headers, policy)
    records = parsed(kept).persist()
    clash = inconsistent_accessions(records).agg(F.min("accession")).first()[0]
    if clash is not None:
        raise checks.InputError(f"accession with several sequences: {clash}")
    unique = merged(records).persist()
    numbers = unique.agg(F.count("*"), F.coalesce(F.sum("entries"), F.lit(0)), F.coalesce(F.sum(F.col("differing").cast("long")), F.lit(0))).first()
    pools = routed(unique, families, hard_families)
    sizes = {f"positive:{f}": positives for f in families} | {"hard": hard, "easy": easy}
    seeds = {p: f"{seed}:{p}" for p in sizes}
    taken = sampling.reservoir(pools, "pool", ["ordinal"], sizes, seeds).select("pool", "slot", "accession", "tags", "sequence", "sequence_sha256")
    by_family = {r.pool[9:]: r[1] for r in pools.filter(F.col("pool").startswith("positive:")).groupBy("pool").count().collect()}
    entries = {r.family: r.entries for r in positive_entries(records, families).collect()}
    return Pools(taken, families, {f: entries.get(f, 0) for f in families}, {f: by_family.get(f, 0) for f in families}, total, numbers[0], numbers[1] - numbers[0], numbers[2], total - numbers[1], seed)


def first_of_each_sequence(records: DataFrame, group: str, order: str = "slot") -> DataFrame:
    """The first record by order of each sequence in a group, digests recomputed and compared."""
    stored = F.when(F.col("sequence_sha256") != F.sha2("sequence", 256), F.concat(F.lit("checksum does not match: "), "accession"))
    checks.require(records, stored, order)
    row = F.struct(order, *(c for c in records.columns if c not in (order, group, "sequence_sha256")))
    return records.groupBy(group, "sequence_sha256").agg(F.min_by(row, order).alias("r")).select(group, "sequence_sha256", "r.*")


def labelled_set(pools: Pools, family: str, positives: int = 500, hard: int = 1000, easy: int = 500, seed: int = SEED) -> DataFrame:
    """class_label, slot, accession, tags, sequence, sequence_sha256 of disjoint reference classes for one family."""
    (family,) = family_names([family])
    if family not in pools.families:
        raise checks.InputError(f"unknown family: {family}")
    numbers = [checks.whole_number(n, "sample size") for n in (positives, hard, easy)]
    label = F.when(F.col("pool") == f"positive:{family}", "positive").when(F.col("pool") == "hard", "hard_negative").when(F.col("pool") == "easy", "easy_negative")
    named = pools.records.withColumn("class_label", label).filter("class_label is not null").drop("pool")
    clean = ~T.has_family(F.col("tags"), family) & ~F.arrays_overlap("tags", F.array(*map(F.lit, AMBIGUOUS_TAGS)))
    unique = first_of_each_sequence(named.filter((F.col("class_label") == "positive") | clean), "class_label").drop("slot")
    sample = sampling.shuffled(unique, "class_label", ["sequence_sha256"], dict(zip(CLASSES, numbers, strict=True)), {c: f"{seed}:labelled:{family}:{c}" for c in CLASSES})
    require_disjoint(sample)
    return sample


def shared_sequences(classes: DataFrame) -> DataFrame:
    """first, second, n: exact sequences that two classes share."""
    own = classes.select("class_label", "sequence_sha256").distinct()
    labels = own.groupBy("sequence_sha256").agg(F.array_sort(F.collect_set("class_label")).alias("labels")).filter(F.size("labels") > 1)
    pairs = F.expr("flatten(transform(labels, (a, i) -> transform(slice(labels, i + 2, size(labels)), b -> struct(a as first, b as second))))")
    return labels.select(F.explode(pairs).alias("p")).groupBy("p.first", "p.second").agg(F.count("*").alias("n"))


def require_disjoint(classes: DataFrame) -> None:
    double = classes.groupBy("class_label", "sequence_sha256").count().filter("count > 1")
    if not double.isEmpty():
        raise checks.InputError("a class holds a sequence twice")
    row = shared_sequences(classes).orderBy(F.desc("second"), F.desc("first")).first()
    if row:
        raise checks.InputError(f"classes {row.first} and {row.second} share {row.n} sequences")


def _class_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by class and digest; a digest of digests is carried on from batch to batch."""
    now, n, total = None, 0, hashlib.sha256()

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([n]), pa.array([total.hexdigest()])], names=["class_label", "n", "digest"])

    for batch in batches:
        labels, digests = batch["class_label"].to_pylist(), batch["sequence_sha256"].to_pylist()
        for label, own in groupby(zip(labels, digests, strict=True), key=lambda x: x[0]):
            if n and label != now:
                yield row()
                n, total = 0, hashlib.sha256()
            now = label
            lines = [d + "\n" for _, d in own]
            total.update("".join(lines).encode())
            n += len(lines)
    if n:
        yield row()


def class_manifest(classes: DataFrame) -> DataFrame:
    """class_label, number_of_unique_sequences, aggregate_sequence_sha256: the digest of the class's sorted digests.

    A digest is sequential, so each class is one task; its digests stream through it, sorted by Spark, and none are held.
    Every class has a row, also an empty one.
    """
    ship(classes.sparkSession)
    unique = classes.select("class_label", "sequence_sha256").distinct().repartition("class_label").sortWithinPartitions("class_label", "sequence_sha256")
    found = unique.mapInArrow(_class_digests, "class_label string, n long, digest string")
    named = classes.sparkSession.createDataFrame([(c,) for c in CLASSES], "class_label string")
    empty = F.lit(hashlib.sha256(b"\n").hexdigest())
    joined = named.join(found, "class_label", "left")
    return joined.select("class_label", F.coalesce("n", F.lit(0)).cast("long").alias("number_of_unique_sequences"), F.coalesce("digest", empty).alias("aggregate_sequence_sha256"))


def reference_manifest(classes: DataFrame) -> dict:
    """The sequence-free manifest of a labelled set as plain values."""
    require_disjoint(classes)
    out: dict = {"schema_version": "1.0", "hash_algorithm": "SHA-256", "cross_class_exact_sequence_overlap_count": 0}
    members = classes.select("class_label", "sequence_sha256", "accession").orderBy("sequence_sha256", "accession").collect()
    for row in class_manifest(classes).collect():
        own = [{"accession": m.accession, "class_label": m.class_label, "sequence_sha256": m.sequence_sha256} for m in members if m.class_label == row.class_label]
        out[row.class_label] = {"number_of_unique_sequences": row.number_of_unique_sequences, "aggregate_sequence_sha256": row.aggregate_sequence_sha256, "members": own}
    return out


def labelled_targets(classes: DataFrame) -> DataFrame:
    """ordinal, target_id "<label>:<slot>", class_label, sequence, in the order of the classes."""
    rank = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("class_label"))
    return classes.select((rank * 10**12 + F.col("slot")).cast("long").alias("ordinal"), F.format_string("%s:%08d", "class_label", "slot").alias("target_id"), "class_label", "sequence")


def parsed_annotations(table: DataFrame) -> DataFrame:
    """accession, tags, sequence, sequence_sha256 from a remote table's Entry, CAZy and Sequence columns."""
    missing = sorted({"Entry", "CAZy", "Sequence"} - set(table.columns))
    if missing:
        raise checks.InputError(f"missing columns: {', '.join(missing)}")
    fields = F.filter(F.transform(F.split("CAZy", ";"), T.trim_space), lambda x: x != "")
    entry = T.trim_space(F.col("Entry"))
    table = table.withColumn("ordinal", F.monotonically_increasing_id())
    problem = (
        F.when(F.coalesce(entry, F.lit("")) == "", "incomplete row").when(F.coalesce(F.size(fields), F.lit(0)) < 1, F.concat(F.lit("incomplete row: "), entry)).when(F.col("Sequence").isNull(), F.concat(F.lit("incomplete row: "), entry))
    ).when(~F.forall(fields, T.is_tag), F.concat(F.lit("bad tags: "), entry))
    checks.require(table, F.coalesce(problem, T.sequence_problem(F.col("Sequence"), entry)))
    checks.require_unique(table.select(entry.alias("entry")), "entry", "accession")
    clean = T.normalised_sequence(F.col("Sequence"))
    return table.select(entry.alias("accession"), F.array_sort(F.array_distinct(fields)).alias("tags"), clean.alias("sequence"), F.sha2(clean, 256).alias("sequence_sha256"))
