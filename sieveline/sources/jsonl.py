"""JSON-lines scans with line numbers, path expansion, and the tolerant reader."""

from __future__ import annotations

import glob
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrow import arrow_flat_map


def expand_paths(inputs: list[str] | str, spark: SparkSession | None = None) -> list[str]:
    """Folders to their ``*.jsonl``, anything else as a pattern; sorted, each file once.

    With a session, names are looked up in the file system that each input
    belongs to; without one, on the local disk.
    """
    inputs = [inputs] if isinstance(inputs, str) else inputs
    if spark is not None:
        return sorted({f for x in inputs for f in _shared_files(spark, x)})
    found: set[str] = set()
    for x in inputs:
        found.update(glob.glob(os.path.join(x, "*.jsonl")) if os.path.isdir(x) else [p for p in glob.glob(x) if os.path.isfile(p)])
    return sorted(found)


def plain_path(uri: str) -> str:
    """A local file's address as a path; others as they are."""
    return re.sub("^file:/*", "/", uri)


def _shared_files(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: list[str] = []
    for status in fs.globStatus(path) or []:
        if status.isFile():
            found.append(status.getPath().toString())
        elif pattern.rstrip("/") == plain_path(status.getPath().toString()).rstrip("/") or status.getPath().toString().rstrip("/") == pattern.rstrip("/") or not re.search(r"[*?\[{]", pattern):
            found += [x.getPath().toString() for x in fs.globStatus(jvm.org.apache.hadoop.fs.Path(status.getPath(), "*.jsonl")) or [] if x.isFile()]
    return [plain_path(x) for x in found]


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, line, value``: every line with its 1-based number, in universal newlines.

    Long files are read in splits; a split's lines are numbered where they lie
    and the counts of the splits before give the offset, so no file is sorted
    into one task.
    """
    if not paths:
        return spark.createDataFrame([], "path string, line int, value string")
    meta = F.col("_metadata")
    scan = spark.read.text(paths).select(meta["file_path"].alias("_uri"), meta["file_block_start"].alias("_start"), F.monotonically_increasing_id().alias("_id"), "value")
    per = Window.partitionBy("_uri", "_start").orderBy("_id")
    counts = scan.groupBy("_uri", "_start").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_uri", "_start", (F.sum("_n").over(Window.partitionBy("_uri").orderBy("_start")) - F.col("_n")).alias("_before"))
    numbered = scan.withColumn("_row", F.row_number().over(per)).join(before, ["_uri", "_start"])
    path = F.url_decode(F.regexp_replace(F.replace("_uri", F.lit("+"), F.lit("%2B")), "^file:/*", "/"))
    return numbered.select(path.alias("path"), (F.col("_before") + F.col("_row")).cast("int").alias("line"), "value")


def not_utf8(lines: DataFrame) -> DataFrame:
    """``path`` of the files of which a line is no valid UTF-8. Files are read in splits, so they may be of any length."""
    return lines.where(~F.is_valid_utf8("value")).select("path").distinct()


def tolerant(lines: DataFrame) -> DataFrame:
    """``path, line, value, error``: empty lines left out, lines that don't parse kept with their error."""

    def make():
        import json

        def row(path, line, value):
            if not value:
                return
            try:
                json.loads(value)
                error = None
            except ValueError as e:
                error = f"{os.path.basename(path or '')}:{line} JSON decode error: {e}"
            yield path, line, value, error

        return row

    return arrow_flat_map(lines.select("path", "line", "value"), make, "path string, line int, value string, error string")
