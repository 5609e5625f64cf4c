"""What the library needs of a Spark session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    On a cluster whose machines don't share that folder, submit the package
    with ``--py-files`` or install it; the path then does no harm.
    """
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([*have, ROOT])


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts lineage through the shared folder of ``spark.checkpoint.dir``, so that a lost executor costs nothing written.

    A temporary folder serves only on one machine (a local master), as in
    tests; on a cluster a session without the setting is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), f"sieveline-{os.getpid()}"))
    return df.checkpoint(eager=True)
