"""Incremental ingestion: new or changed documents of a folder, once each, into stage tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.parsing import parse_documents


def documents(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """A stream of whole files: ``path`` and ``text``; files that come later are read by later triggers."""
    rows = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", pattern).load(folder)
    path = F.col("_metadata.file_path")
    return rows.select(path.alias("path"), F.col("value").alias("text")).where(~F.lower("path").endswith(".normalized.md"))


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, stage: Callable[[DataFrame], DataFrame] = parse_documents, pattern: str = "*.md") -> StreamingQuery:
    """Runs ``stage`` on all files not seen yet and ends; the checkpoint remembers them, so a second run does only what is new."""
    rows = stage(documents(spark, folder, pattern))
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
