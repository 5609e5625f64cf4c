"""Shared plumbing: table readers and Arrow row maps."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import checkpoint, ship  # noqa: F401 - checkpoint for the other modules

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rec_no, content, url`` of the delivery records; only those leaves are read."""
    return table(spark, sf_dir, "example_clean").select(
        "rec_no",
        F.col("meta.data_info.content").alias("content"),
        F.col("meta.data_info.url").alias("url"),
    )


def parsed_schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def arrow_flat_map(df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], ddl: str) -> DataFrame:
    """Rows of ``df`` to any number of rows, in Arrow batches.

    ``make`` runs once in each task and returns the row function, which gets one
    argument for each column of ``df`` and yields tuples in the order of ``ddl``.
    """
    ship(df.sparkSession)
    schema = parsed_schema(ddl)
    arrow = to_arrow_schema(schema)
    width = len(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            cols: list[list] = [[] for _ in range(width)]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for out in fn(*row):
                    for col, value in zip(cols, out):
                        col.append(value)
            if cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow
                )

    return df.mapInArrow(run, schema)


def site_of(url):
    """Lower-case host without ``www.`` and port; null where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#\s]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))
