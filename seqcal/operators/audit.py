"""Audit of a file tree that should hold code only: violations as a table, contents checked where the files lie."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..shipping import ship
from . import checks

# Limits, names, suffixes and patterns of the audit.
LARGEST = 5 * 1024 * 1024
SKIPPED_DIRECTORIES = [".git", ".mypy_cache", ".pytest_cache", ".ruff_cache", ".tox", ".venv", "__pycache__", "build", "dist"]
DATA_SUFFIXES = [
    ".2bit", ".a2m", ".aln", ".bam", ".bz2", ".cram", ".db", ".dmnd", ".fa", ".faa", ".fast5", ".fasta", ".fastq", ".fna", ".fq", ".ffn", ".gb", ".gbk", ".gz", ".h3f", ".h3i", ".h3m", ".h3p", ".hdf5",
    ".hmm", ".mmi", ".npy", ".npz", ".pickle", ".pkl", ".sam", ".sra", ".sqlite", ".sqlite3", ".sto", ".tar", ".vcf", ".xz", ".zip",
]
SECRET_NAMES = [".env", "credentials.json", "id_dsa", "id_ed25519", "id_rsa", "secrets.json"]
TEXT_SUFFIXES = ["", ".cfg", ".cff", ".csv", ".ini", ".json", ".lock", ".md", ".py", ".rst", ".toml", ".tsv", ".txt", ".yaml", ".yml"]
HOME_PATH = "contains an absolute user-home path"
# Beside its pattern and reason, what a text must hold for the pattern to be worth a search; lower-case words count in any case.
SEARCHED = [
    ("/Users/", HOME_PATH, None),
    ("/home/", HOME_PATH, None),
    (r"[A-Za-z]:\\\\Users\\\\", HOME_PATH, "Users"),
    (r"(?i)\bConsett\b", "contains the study-site name", "consett"),
    (r"\bPS-[A-Z0-9]{8}\b", "contains a project-specific protein identifier", "PS-"),
    ("[ACDEFGHIKLMNPQRSTVWY]{60,}", "contains a long protein-like character string", None),
    ("[ACGTUN]{80,}", "contains a long nucleotide-like character string", None),
    ("-----BEGIN [A-Z ]*PRIVATE KEY-----", "contains private-key material", "PRIVATE KEY-----"),
    (r"\bAKIA[0-9A-Z]{16}\b", "contains an AWS access-key identifier", "AKIA"),
    (r"\bgh[pousr]_[A-Za-z0-9]{30,}\b", "contains a GitHub credential-like value", "gh"),
    (r"\bsk-[A-Za-z0-9]{20,}\b", "contains an API credential-like value", "sk-"),
    (r"(?i)\b(?:postgres(?:ql)?|mysql|mariadb|mongodb)://[^\s/:@]+:[^\s/@]+@", "contains a database URL with embedded credentials", "://"),
]
PATTERNS = [(pattern, reason) for pattern, reason, _ in SEARCHED]
NEEDED = {pattern: word for pattern, _, word in SEARCHED if word}
#: Not among the fixed patterns: home paths with single backslashes.
WINDOWS_HOME = (r"[A-Za-z]:\\Users\\", HOME_PATH)


def content_reasons(text: Column, patterns: list[tuple[str, str]] = PATTERNS) -> Column:
    """One entry for each pattern that text holds, null for the others."""

    def found(p: str) -> Column:
        word = NEEDED.get(p)
        return text.rlike(p) if word is None else (F.lower(text) if p.startswith("(?i)") else text).contains(word) & text.rlike(p)

    return F.array(*(F.when(found(p), F.lit(reason)) for p, reason in patterns))


def audit_texts(df: DataFrame, key: str, text: str = "text", patterns: list[tuple[str, str]] = PATTERNS) -> DataFrame:
    """key, reason for every pattern found in a text."""
    return df.select(key, F.explode(F.array_compact(content_reasons(F.col(text), patterns))).alias("reason"))


def _file_reasons(largest: int) -> Column:
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    suffix = F.regexp_extract(name, r"^\.*[^.].*(\.[^.]+)$", 1)
    sample = name == ".env.example"
    secret = F.when(name.isin(SECRET_NAMES) | (name.startswith(".env.") & ~sample), "prohibited secret-bearing file name")
    data = F.when(suffix.isin(DATA_SUFFIXES), "prohibited data, model or archive extension")
    large = F.when(F.col("length") > largest, f"file exceeds {largest} bytes")
    small_text = (F.col("length") <= largest) & (suffix.isin(TEXT_SUFFIXES) | sample)
    other = F.when((F.col("length") <= largest) & ~suffix.isin(TEXT_SUFFIXES) & ~sample & ~suffix.isin(DATA_SUFFIXES), "file type is not allowed in the code-only public tree")
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    broken = F.when(small_text & ~valid, "expected text file is not valid UTF-8")
    return F.array_compact(F.concat(F.array(secret, data, large, other, broken), F.when(small_text & valid, content_reasons(F.col("content").cast("string"))).otherwise(F.array())))


def _read(top: str, largest: int):
    """Contents of listed files; of those beyond the limit the length alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            files = [Path(top, x) for x in batch["path"]]
            sizes = [f.stat().st_size for f in files]
            yield pd.DataFrame({"path": batch["path"], "length": sizes, "content": [f.read_bytes() if n <= largest else b"" for f, n in zip(files, sizes, strict=True)]})

    return run


def audit_tree(spark: SparkSession, root: str, largest: int = LARGEST) -> DataFrame:
    """path (relative), reason for every violation below root."""
    top = Path(root).resolve()
    if not top.is_dir():
        raise checks.InputError(f"not a directory: {root}")
    skipped = "(^|/)(" + "|".join(d.replace(".", r"\.") for d in SKIPPED_DIRECTORIES) + ")/"
    links, hidden = [], []  # the file reader would follow the ones and leave out the others
    for folder, directories, files in os.walk(top):
        directories[:] = [d for d in directories if d not in SKIPPED_DIRECTORIES]
        links += [str((Path(folder) / x).relative_to(top)) for x in directories + files if (Path(folder) / x).is_symlink()]
        here = Path(folder).relative_to(top)
        hidden += [str(here / x) for x in files if any(p.startswith((".", "_")) for p in (here / x).parts) and not (Path(folder) / x).is_symlink()]
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(top.as_uri())
    prefix = top.as_uri().replace("file:///", "file:/")
    relative = F.url_decode(F.regexp_replace(F.substring(F.regexp_replace("path", "^file:/+", "file:/"), len(prefix) + 2, 1 << 20), r"\+", "%2B"))
    # the reader looks at sizes first: it doesn't open the files that one part filters out and whose content the other leaves
    small = files.filter(F.col("length") <= largest).select(relative.alias("path"), "length", "content")
    large = files.filter(F.col("length") > largest).select(relative.alias("path"), "length", F.lit(b"").alias("content"))
    named = small.unionByName(large).filter(~F.col("path").rlike(skipped))
    if hidden:
        listed = spark.createDataFrame([(x,) for x in hidden], "path string").repartition(min(len(hidden), 64))
        named = named.union(listed.mapInPandas(_read(str(top), largest), "path string, length long, content binary"))
    found = named.select("path", F.explode(_file_reasons(largest)).alias("reason"))
    linked = spark.createDataFrame([(x,) for x in links], "path string")
    under = linked.select(F.col("path").alias("link"))
    found = found.join(F.broadcast(under), (found.path == under.link) | found.path.startswith(F.concat("link", F.lit("/"))), "left_anti") if links else found
    return found.union(linked.select("path", F.lit("symbolic links are not allowed")))
