"""What all operators do first, and names of rows; tables between steps go to the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from ..shared import table_path, written
from ..shipping import ship

__all__ = ["prepare", "row_key", "table_path", "written"]
ARROW_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """The package on all executors, and one bound for the Arrow batches of whole texts, the same for every operator."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def row_key(*names: str) -> Column:
    """16 bytes that name a row by the content of its columns (null differs from empty); rows that repeat share them."""
    texts = [F.col(x).cast("string") for x in names]
    return F.unhex(F.md5(F.concat(*(F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts))))
