"""Cutoffs and domain limits on streams: both are stateless, so the batch functions serve unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import classify, hits


def classified_stream(spark: SparkSession, folder: str, schema: str, cutoffs: DataFrame) -> DataFrame:
    """Hits from the Parquet files that arrive in folder, each with its class; cutoffs is a static table."""
    return classify.apply_cutoffs(spark.readStream.schema(schema).parquet(folder), cutoffs)


def accepted_stream(spark: SparkSession, folder: str, most_evalue: float = 1e-15, least_coverage: float = 0.35) -> DataFrame:
    return hits.domain_hits(spark.readStream.schema(hits.RAW_DOMAIN).parquet(folder), most_evalue, least_coverage)


def write_stream(df: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Runs over what is there and ends; a later call goes on where this one stopped."""
    return df.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
