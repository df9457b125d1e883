"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where it is unset, a temporary folder in local mode and an error on a cluster,
    where executors would write to their own disks."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _local:
        _local["dir"] = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _local["dir"], True)
    return "file://" + _local["dir"]


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, merge: bool = True, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives the loss of executors. With merge, small
    partitions of a shuffle go to the same file: four files for each core, or one for eight partitions if that is more."""
    spark, path = df.sparkSession, table_path(df.sparkSession, name)
    if merge:
        df = df.coalesce(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    df.write.options(**{"parquet.block.size": str(16 << 20)} | options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly to tasks, for steps that cost far more than to move their rows: a file of one row group is read by
    one task, however many rows it has. As many partitions as the session shuffles to, or two for each core if that is more."""
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
