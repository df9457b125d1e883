"""Checksums and run manifests; they name files, not where these lie."""

from __future__ import annotations

import datetime
import hashlib
import platform
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.fs
import pyspark
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import __version__
from ..shipping import ship
from .checks import InputError, finite_number, unique_names

# Parameters that a manifest must hold, and the words by which it tells its coordinates.
REQUIRED = ["target_reporting_evalue_threshold", "domain_reporting_evalue_threshold", "independent_domain_evalue_threshold", "evalue_search_space_Z"]
WHOLE_BYTES, CHUNK_BYTES = 64 << 20, 8 << 20
COORDINATES = "protein and HMM positions are one-based and end-inclusive"


def sha256_file(path: str) -> str:
    with open(path, "rb") as data:
        return hashlib.file_digest(data, "sha256").hexdigest()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path in batch["path"].to_pylist():
            store, name = pa.fs.FileSystem.from_uri(path)
            total = hashlib.sha256()
            with store.open_input_stream(name) as data:
                while part := data.read(CHUNK_BYTES):
                    total.update(part)
            digests.append(total.hexdigest())
        yield pa.RecordBatch.from_arrays([batch["path"], batch["size_bytes"], pa.array(digests, pa.string())], names=["path", "size_bytes", "sha256"])


def file_digests(spark: SparkSession, root: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """path, size_bytes, sha256 of every file below root, hashed by tasks. Files of at most whole bytes come through Spark's
    reader, of which longer ones only take the size: they are read in chunks, however long, through Arrow's file systems."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    small = files.filter(F.col("length") <= whole).select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > whole).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), F.col("length").alias("size_bytes"))
    # a task for a few files: their bytes are the work
    large = large.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(_streamed, "path string, size_bytes long, sha256 string")
    return small.unionByName(large)


def file_record(path: str) -> dict[str, Any]:
    own = Path(path)
    return {"file_name": own.name, "size_bytes": own.stat().st_size, "sha256": sha256_file(path)}


def scan_manifest(proteins: str, profiles: str, names: list[str], parameters: dict[str, Any], output: str, backend: str) -> dict[str, Any]:
    """What a search read, with which parameters, and what it wrote if that is there yet."""
    checked = {k: finite_number(parameters[k], k, 0, above=True) for k in REQUIRED if k in parameters}
    if lacking := [k for k in REQUIRED if k not in checked]:
        raise InputError("a manifest needs " + " and ".join(lacking))
    software = {"package": "seqcal", "package_version": __version__, "python_version": platform.python_version(), "spark_version": pyspark.__version__, "search_backend": backend}
    own = unique_names([x.strip().removesuffix(".hmm") for x in names], "profile names")
    written = file_record(output) if Path(output).exists() else {"file_name": Path(output).name}
    # fixed values: the keys of the format
    return {
        "schema_version": "1.0",
        "created_at_utc": datetime.datetime.now(datetime.UTC).isoformat(),
        "software": software,
        "inputs": dict(zip(("protein_fasta", "hmm_file"), map(file_record, (proteins, profiles)), strict=True)),
        "profiles": {"number_searched": len(own), "names": own},
        "parameters": dict(parameters),
        "coordinate_convention": COORDINATES,
        "output": written,
    }
