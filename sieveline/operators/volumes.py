"""Volumes of bounded size in total order, without sorting into one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint

SOFT_MAX, MIN_LINES, CHUNK = 10_010, 10_000, 10_000
#: ``monotonically_increasing_id`` holds the partition above these bits and the row's place in it below them.
PLACE_BITS = 33


def global_index(df: DataFrame, group: list[str], order: list[str], buckets: int | None = None) -> DataFrame:
    """``df`` with ``idx``, its 0-based place by ``group`` then ``order``, nulls first.

    Rows are range-partitioned, sorted and written once. Range bounds come from
    a sample, so counts and numbers must be taken of one and the same layout:
    the checkpoint. Its partitions are counted, and the counts, one for each
    partition, give the offsets. No window spans all rows. Rows equal in all
    of the columns follow each other in any order; columns of ``df`` that begin
    with ``_at_`` are not allowed.
    """
    parts = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    placed = checkpoint(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)).withColumn("_at_row", F.monotonically_increasing_id())
    part = F.shiftrightunsigned("_at_row", PLACE_BITS).cast("int")
    counts = placed.groupBy(part.alias("_at_part")).agg(F.count(F.lit(1)).alias("_at_n"))
    offsets = counts.select("_at_part", (F.sum("_at_n").over(Window.orderBy("_at_part")) - F.col("_at_n")).alias("_at_before"))  # one row for each partition
    place = F.col("_at_row").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.withColumn("_at_part", part).join(F.broadcast(offsets), "_at_part").withColumn("idx", F.col("_at_before") + place).select(*[F.col(f"`{c}`") for c in df.columns if c != "idx"], "idx")


def volume_of(idx: Column, n: Column, soft_max: int = SOFT_MAX, min_lines: int = MIN_LINES) -> Column:
    """1-based volume: ``soft_max + 1`` rows each, a tail below ``min_lines`` folded into the volume before."""
    width = soft_max + 1
    last = F.ceil(n / width)
    tail = n - (last - 1) * width
    own = F.floor(idx / width) + 1
    return F.when((own == last) & (last > 1) & (tail < min_lines), last - 1).otherwise(own).cast("bigint")


def merge_volumes(df: DataFrame, group: list[str], order: list[str], soft_max: int = SOFT_MAX, min_lines: int = MIN_LINES) -> DataFrame:
    """``df`` with ``idx`` and ``volume``."""
    n = df.agg(F.count(F.lit(1))).scalar()
    return global_index(df, group, order).withColumn("volume", volume_of(F.col("idx"), n, soft_max, min_lines))


def volume_sizes(merged: DataFrame) -> DataFrame:
    """``volume, lines``; an input without rows gives one empty volume."""
    sizes = merged.groupBy("volume").agg(F.count(F.lit(1)).alias("lines"))
    empty = merged.agg(F.count(F.lit(1)).alias("_n")).where("_n = 0").select(F.lit(1).cast("bigint").alias("volume"), F.col("_n").alias("lines"))
    return sizes.unionByName(empty)


def rolling_part(idx: Column, chunk: int = CHUNK) -> Column:
    """1-based part of ``chunk`` rows; there is never an empty last part."""
    return (F.floor(idx / chunk) + 1).cast("bigint")
