"""Row functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ship


def arrow_flat_map(df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], ddl: str) -> DataFrame:
    """Rows of ``df`` to any number of rows; ``make`` runs once in each task and returns the row function."""
    ship(df.sparkSession)
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            rows = [out for row in zip(*(c.to_pylist() for c in batch.columns)) for out in fn(*row)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)
