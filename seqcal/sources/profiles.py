"""Profile libraries as tables: files of any store, cut at the records' ends by Spark's reader, parsed in tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import checks
from ..operators.checks import InputError
from ..search.model import Profile, clean_name, consensus_profile, format_profile, parse_profiles
from ..shared import spread
from ..shipping import ship

PARSED = "ordinal long, name string, match_states int, mu double, decay double, match array<double>, moves array<double>, problem string"
RESIDUES, MOVES = 20, 7


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """ordinal (rising in file order), name, match_states, text of every record of ASCII model files."""
    try:
        rows = spark.read.option("lineSep", "\n//").option("recursiveFileLookup", "true").text(path)
    except AnalysisException as error:
        raise InputError(f"profile file does not exist: {path}") from error
    found = rows.select(F.monotonically_increasing_id().alias("ordinal"), F.regexp_replace("value", r"^\s+", "").alias("text")).filter("text <> ''")
    tag = lambda key: F.trim(F.regexp_extract("text", rf"(?m)^{key}[ \t]+([^\r\n]*)", 1))
    return found.select("ordinal", F.regexp_replace(tag("NAME"), r"\.hmm$", "").alias("name"), tag("LENG").try_cast("int").alias("match_states"), "text")


def select_profiles(catalogue: DataFrame, selected: Iterable[str] | None = None) -> DataFrame:
    """The records of catalogue, or those of the selected names, after checks of all: each is a model with a name of its
    own, each selected one is there, and there is one at least."""
    wanted = None
    if selected is not None:
        wanted = [clean_name(n) for n in selected]
        if not wanted or len(set(wanted)) < len(wanted):
            raise InputError("requested profiles must be present and unique")
    record = F.concat(F.lit("record "), F.col("ordinal").cast("string"))
    checks.require(catalogue, F.when(~F.col("text").startswith("HMMER3/"), F.concat(record, F.lit(" is no ASCII model"))).when(F.col("name") == "", F.concat(record, F.lit(" has no profile name"))))
    checks.require_unique(catalogue, "name", "profile")
    if wanted is None:
        if catalogue.isEmpty():
            raise InputError("no profiles")
        return catalogue
    names = catalogue.sparkSession.createDataFrame([(n,) for n in wanted], "name string")
    missing = [r.name for r in names.join(catalogue, "name", "left_anti").orderBy("name").collect()]  # names of the request
    if missing:
        raise InputError(f"profiles not found: {', '.join(missing)}")
    return catalogue.join(names, "name", "left_semi")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for ordinal, name, text in zip(*(batch[c].to_pylist() for c in ("ordinal", "name", "text")), strict=True):
            try:
                (p,) = parse_profiles(text)
                rows.append((ordinal, p.name, p.match_states, p.mu, p.decay, p.match.ravel().tolist(), p.moves.ravel().tolist(), None))
            except (InputError, KeyError, ValueError) as error:
                rows.append((ordinal, name, None, None, None, None, None, f"broken profile {name}: {error}"))
        types = [pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in PARSED.split(", ")])


def read_profiles(spark: SparkSession, path: str, selected: Iterable[str] | None = None) -> DataFrame:
    """ordinal, name, match_states, mu, decay, match (20 probabilities a state), moves (7 a state and 7 before) of a library,
    parsed by tasks, each record for itself, and checked on the way to a staged table."""
    ship(spark)
    chosen = select_profiles(read_catalogue(spark, path), selected)
    return checks.staged(chosen.select("ordinal", "name", "text").mapInArrow(_parsed, PARSED), [F.col("problem")]).drop("problem")


def written_models(sequences: DataFrame) -> DataFrame:
    """value: the ASCII model around each of sequences(name, letters), without its last line end, as Spark's text writer adds it."""
    ship(sequences.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [format_profile(consensus_profile(n, x)).removesuffix("\n") for n, x in zip(batch["name"].to_pylist(), batch["letters"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])

    return spread(sequences.select("name", "letters")).mapInArrow(run, "value string")


def collected(profiles: DataFrame) -> list[Profile]:
    """The profiles as parameters of a search, in file order."""
    rows = profiles.orderBy("ordinal").collect()
    return [Profile(r.name, np.array(r.match).reshape(-1, RESIDUES), np.array(r.moves).reshape(-1, MOVES), r.mu, r.decay) for r in rows]
