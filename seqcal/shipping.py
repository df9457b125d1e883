"""This package on the executors: sent once a session as a zip file, imported there as usual."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the files of the session, for functions that run in Python workers."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root, folder = Path(__file__).parent, tempfile.mkdtemp(prefix="spark-")
    atexit.register(shutil.rmtree, folder, True)  # executors may ask for it as long as the session lives
    path = Path(folder) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))
    _sent.add(context.applicationId)
