"""The validator and the cleaner over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from ..operators.validate import Policy, findings, from_lines, with_findings


def arriving_lines(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """``path, line, value, arrived`` of JSON-lines files in a folder. Numbers order lines within a file; a stream can't count the lines before."""
    scan = spark.readStream.option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.jsonl").text(folder)
    return scan.select(F.col("_metadata.file_path").alias("path"), F.lit(0).alias("line"), "value", F.col("_metadata.file_modification_time").alias("arrived"))


def stream_findings(lines: DataFrame, policy: Policy | None = None) -> DataFrame:
    return findings(with_findings(from_lines(lines), policy))


def rates(events: DataFrame, ts: str, kind: str, late: str = "1 hour", width: str = "10 minutes") -> DataFrame:
    """Counts by kind in windows; rows later than ``late`` are left out."""
    timed = events.withWatermark(ts, late)
    out = timed.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), kind, "n")


def first_urls(records: DataFrame, url: str, ts: str, late: str = "1 hour") -> DataFrame:
    """Each url once within the watermark."""
    return records.withWatermark(ts, late).dropDuplicatesWithinWatermark([url])


def cleaned(records: DataFrame, content: str) -> DataFrame:
    return records.withColumn("clean", clean.clean_text(F.col(content)))
