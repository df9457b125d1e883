"""A page of a remote reference table: fetched by a transport that the caller may replace, parsed by Spark."""

from __future__ import annotations

import csv
import io
import time
import urllib.parse
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import references
from ..operators.checks import InputError, finite_number, whole_number

# The service's address, the fields asked for and its largest page.
ADDRESS = "https://rest.uniprot.org/uniprotkb/search"
FIELDS = "accession,xref_cazy,sequence"
LARGEST_PAGE = 500


def get(url: str, timeout: float) -> str:
    with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
        return answer.read().decode("utf-8")


def fetch_references(spark: SparkSession, query: str, size: int = LARGEST_PAGE, delay: float = 1.0, timeout: float = 60.0, transport: Callable[[str, float], str] = get, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """One page of at most 500 rows as accession, tags, sequence, sequence_sha256; waits before it asks."""
    if not query.strip():
        raise InputError("query is empty")
    if whole_number(size, "size", 1) > LARGEST_PAGE:
        raise InputError(f"size is at most {LARGEST_PAGE}")
    delay, timeout = finite_number(delay, "delay", 0), finite_number(timeout, "timeout", 0, above=True)
    sleep(delay)
    url = ADDRESS + "?" + urllib.parse.urlencode({"query": query, "format": "tsv", "fields": FIELDS, "size": size})
    rows = list(csv.reader(io.StringIO(transport(url, timeout)), delimiter="\t"))
    if not rows or not {"Entry", "CAZy", "Sequence"} <= set(rows[0]):
        raise InputError("the answer lacks required columns")
    width = len(rows[0])
    data = [tuple((r + [None] * width)[:width]) for r in rows[1:] if r]
    return references.parsed_annotations(spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in rows[0])))
