"""Checks that fail on the driver, before any output: the lowest ordinal's problem is reported."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions import text as T
from ..shared import written


class InputError(ValueError):
    """The input or a parameter can't be used."""


def require(df: DataFrame, problem: Column, ordinal: str = "ordinal") -> None:
    """Raises the problem of the first row that has one."""
    row = df.select(problem.alias("problem"), ordinal).filter("problem is not null").agg(F.min_by("problem", ordinal)).first()
    if row[0] is not None:
        raise InputError(row[0])


def staged(df: DataFrame, problems: list[Column], ordinal: str = "ordinal") -> DataFrame:
    """df, written once to the shared folder. The checks ride on that write: if rows have a problem, the first of problems
    that occurs is raised, as the row of the lowest ordinal tells it, and nothing is passed on."""
    found = Observation()
    first = [F.min_by(p, F.when(p.isNotNull(), F.col(ordinal))).alias(f"p{i}") for i, p in enumerate(problems)]
    table = written(df.observe(found, F.count("*").alias("rows"), *first), "staged")
    for i in range(len(problems)):
        if (said := found.get[f"p{i}"]) is not None:
            raise InputError(said)
    return table


def duplicates(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, column: str, what: str) -> None:
    row = duplicates(df, column).agg(F.min(column)).first()
    if row[0] is not None:
        raise InputError(f"{what} is not unique: {row[0]}")


def record_problem() -> Column:
    return F.coalesce(T.identifier_problem(F.col("target_id")), T.sequence_problem(F.col("sequence"), F.col("target_id")))


def protein_summary(records: DataFrame) -> DataFrame:
    """One row: number of records and residues, least and greatest length, of normalised sequences."""
    length = F.length(T.normalised_sequence(F.col("sequence"))).cast("long")
    return records.select(length.alias("n")).agg(F.count("*").alias("number_of_records"), F.sum("n").alias("total_residues"), F.min("n").alias("minimum_length"), F.max("n").alias("maximum_length"))


def inspect_proteins(records: DataFrame) -> DataFrame:
    """protein_summary after the preflight: no terminal stop symbol, valid records, unique identifiers, one at least."""
    stop = F.when(T.trim_space(F.col("sequence")).endswith("*"), F.concat(F.lit("terminal stop symbol in "), "target_id"))
    require(records, F.coalesce(stop, record_problem()))
    require_unique(records.select(T.trim_space(F.col("target_id")).alias("target_id")), "target_id", "identifier")
    summary = protein_summary(records)
    if not summary.first()["number_of_records"]:
        raise InputError("no protein records")
    return summary


def require_scores(scores: DataFrame, column: str = "score") -> None:
    row = scores.agg(F.count("*").alias("n"), F.sum((~T.finite(F.col(column))).cast("long")).alias("bad")).first()
    if not row.n:
        raise InputError("no scores")
    if row.bad:
        raise InputError("scores must be finite")


def finite_number(value: object, name: str, least: float = -math.inf, most: float = math.inf, above: bool = False) -> float:
    try:
        found = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError, OverflowError) as error:
        raise InputError(f"{name} is not a number: {value!r}") from error
    if isinstance(value, bool) or not math.isfinite(found) or not least <= found <= most or above and found == least:
        raise InputError(f"{name} is out of range: {value!r}")
    return found


def whole_number(value: object, name: str, least: int = 0) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < least:
        raise InputError(f"{name} must be a whole number of at least {least}: {value!r}")
    return value


def search_options(target_evalue: float = 10.0, domain_evalue: float = 10.0, independent_evalue: float = 1e-15, coverage: float = 0.35, search_space: float | None = None, cpus: int = 0) -> dict[str, float]:
    """Checked search parameters; the search space has no default, as E-values depend on it."""
    return {
        "E": finite_number(target_evalue, "target E-value threshold", 0, above=True),
        "domE": finite_number(domain_evalue, "domain E-value threshold", 0, above=True),
        "iE": finite_number(independent_evalue, "independent E-value threshold", 0, above=True),
        "coverage": finite_number(coverage, "coverage", 0, 1),
        "Z": finite_number(search_space, "search space", 0, above=True),
        "cpus": whole_number(cpus, "cpus"),
    }


def unique_names(names: Iterable[str], what: str) -> list[str]:
    found = [str(n).strip() for n in names]
    if not found or "" in found or len(set(found)) < len(found):
        raise InputError(f"{what} must be present, non-empty and unique")
    return found
