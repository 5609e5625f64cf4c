"""Writers: JSON lines, volumes, rolling parts, reports, pages."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import report_line
from ..operators.volumes import rolling_part, global_index


def json_line(record: Column) -> Column:
    """A record as JSON, null members kept, characters as they are."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def ascii_json(text: Column) -> Column:
    """JSON text with characters beyond ASCII escaped, pairs for those beyond the first plane."""
    unit = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))

    def escaped(c: Column) -> Column:
        n = F.ascii(c).cast("bigint")  # the code point, whatever the name says
        pair = F.concat(unit(F.lit(0xD800) + F.floor((n - 0x10000) / 1024)), unit(F.lit(0xDC00) + (n - 0x10000) % 1024))
        return F.when(n < 128, c).when(n < 0x10000, unit(n)).otherwise(pair)

    spelled = F.array_join(F.transform(F.split(text, ""), escaped), "")
    return F.when(text.rlike(r"[^\x00-\x7f]"), spelled).otherwise(text)


def write_jsonl(df: DataFrame, record: str, out: str) -> None:
    df.select(json_line(F.col(record)).alias("value")).write.mode("overwrite").text(out)


def rejected_line(url: Column, reason: Column) -> Column:
    """A rejected record as JSON beyond ASCII escaped, null members kept."""
    return ascii_json(json_line(F.struct(url.alias("url"), reason.alias("reason"))))


def write_rejected(df: DataFrame, out: str) -> None:
    df.select(rejected_line(F.col("url"), F.col("reason")).alias("value")).write.mode("overwrite").text(out)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def write_named(df: DataFrame, name: str, order: list[str], text: str, out: str, always: tuple[str, ...] = ()) -> list[str]:
    """Lines of ``text`` into files of the given names under ``out``, in order; returns the names.

    Each file is written by one task and moved to its name; the driver sees
    names only. Files of these names are replaced, others stay. ``always``:
    names that get an empty file where no row has them.
    """
    spark = df.sparkSession
    fs, folder = _file_system(spark, out)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    apart = path(folder, f"_writing-{uuid.uuid4().hex}")
    rows = df.select(F.col(name).alias("_file"), *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)], F.col(text).alias("value"))
    rows.repartition("_file").sortWithinPartitions("_file", *[f"_order{i}" for i in range(len(order))]).select("value", "_file").write.partitionBy("_file").text(apart.toString())
    names = []
    try:
        for each in fs.listStatus(apart):
            if each.isDirectory() and each.getPath().getName().startswith("_file="):
                own = unescape(each.getPath().getName()[len("_file=") :])
                target = path(folder, own)
                fs.mkdirs(target.getParent())
                fs.delete(target, False)
                for part in fs.listStatus(each.getPath()):
                    if part.getPath().getName().startswith("part-"):
                        fs.rename(part.getPath(), target)
                names.append(own)
    finally:
        fs.delete(apart, True)
    for own in always:
        if own not in names:
            fs.create(path(folder, own), True).close()
            names.append(own)
    return sorted(names)


def write_volumes(merged: DataFrame, value: str, out: str, day: str) -> list[str]:
    """One file for each volume, named by day and number, its rows in order; no row at all gives one empty volume."""
    first = f"{day}_clean_file_1.jsonl"
    return write_named(merged.withColumn("_name", volume_name(day, F.col("volume"))), "_name", ["idx"], value, out, always=(first,))


def write_parts(parts: DataFrame, value: str, out: str, stamp: str) -> list[str]:
    """One file for each rolling part."""
    return write_named(parts.withColumn("_name", part_name(stamp, F.col("part"))), "_name", ["idx"], value, out)


def rolling(df: DataFrame, group: list[str], order: list[str], chunk: int = 10_000) -> DataFrame:
    """``df`` with ``idx`` and ``part``."""
    return global_index(df, group, order).withColumn("part", rolling_part(F.col("idx"), chunk))


def part_name(stamp: str, part: Column) -> Column:
    return F.concat(F.lit(f"site_{stamp}_part"), F.lpad(part.cast("string"), 2, "0"), F.lit(".jsonl"))


def volume_name(day: str, volume: Column) -> Column:
    return F.concat(F.lit(f"{day}_clean_file_"), volume.cast("string"), F.lit(".jsonl"))


def _report(found: DataFrame, totals: DataFrame, head: list[Column]) -> DataFrame:
    """``path, seq, text`` of a report for each row of ``totals``."""
    numbered = lambda start, texts: F.array(*[F.struct(F.lit(start + i).cast("bigint").alias("seq"), t.alias("text")) for i, t in enumerate(texts)])
    end = 2**62
    foot = [F.lit("-" * 80), F.format_string("Summary: total=%d passed=%d pass_rate=%.2f%%", "total", "passed", "pass_rate")]
    frame = totals.select("path", F.explode(F.concat(numbered(0, head), numbered(end, foot))).alias("x"))
    clean = totals.join(found.select("path").distinct(), "path", "left_anti").select("path", F.struct(F.lit(2**40).cast("bigint").alias("seq"), F.lit("[PASS] 无错误").alias("text")).alias("x"))
    lines = found.select("path", F.struct("seq", "text").alias("x"))
    return frame.unionByName(clean).unionByName(lines).select("path", "x.seq", "x.text")


def report_lines(findings: DataFrame, summary: DataFrame, run_time: str) -> DataFrame:
    """``path, seq, text``: the report of every file. Lines, not files: a report may be as long as its file."""
    seq = F.lit(2**40) + F.col("line").cast("bigint") * 1000 + (F.coalesce("ord", F.lit(999)) if "ord" in findings.columns else F.lit(0))
    found = findings.select("path", seq.alias("seq"), report_line(F.col("path"), F.col("line"), F.col("tag"), F.col("msg")).alias("text"))
    head = [F.lit(f"Validate Report ({run_time})"), F.concat(F.lit("File: "), "path"), F.lit("=" * 80)]
    return _report(found, summary.where(F.col("path").isNotNull()), head)


def overall_report(findings: DataFrame, summary: DataFrame, run_time: str) -> DataFrame:
    """``path, line, seq, text`` of the report over all files, in the order path, line, seq; frame lines have no path."""
    files = summary.where(F.col("path").isNotNull()).select(F.lit("").alias("path"), F.lit(0).alias("line"), F.lit(1).cast("bigint").alias("seq"), F.concat(F.lit("  - "), "path").alias("text"))
    body = findings.select("path", "line", F.lit(2).cast("bigint").alias("seq"), report_line(F.col("path"), F.col("line"), F.col("tag"), F.col("msg")).alias("text"))
    total = summary.where(F.col("path").isNull())
    frame = _report(body.select(F.lit(None).cast("string").alias("path"), "seq", "text").limit(0), total, [F.lit(f"Validate Report ({run_time})"), F.lit("Files:")]).where("text NOT LIKE '[PASS]%'")
    bar = total.select(F.lit("").alias("path"), F.lit(1).alias("line"), F.lit(0).cast("bigint").alias("seq"), F.lit("=" * 80).alias("text"))
    none = bar.join(findings.limit(1).select(F.lit("").alias("path")), "path", "left_anti").select("path", F.lit(2).alias("line"), "seq", F.lit("[PASS] 无错误").alias("text"))
    last = F.lit("\U0010ffff")
    ends = frame.select(F.when(F.col("seq") < 2, F.lit("")).otherwise(last).alias("path"), F.lit(0).alias("line"), F.when(F.col("seq") < 2, F.col("seq") - 2).otherwise(F.col("seq")).alias("seq"), "text")
    return ends.unionByName(files).unionByName(bar).unionByName(none).unionByName(body)


def write_files(df: DataFrame, path: str, text: str, out: str) -> int:
    """A few small texts to the driver's own disk, one file each and character by character, streamed one partition at a time; ``write_named`` is for any number, in shared folders."""
    n = 0
    for row in df.select(path, text).toLocalIterator():
        target = os.path.join(out, row[0])
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "w", encoding="utf-8") as f:
            f.write(row[1])
        n += 1
    return n
