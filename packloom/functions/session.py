"""Session helpers shared by all operators: worker import path, durable cut points of a lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder ``spark.checkpoint.dir``; a local temporary one only where that is unset."""
    conf = spark.sparkContext.getConf()
    given = conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    here = getattr(spark.sparkContext, "_packloom_dir", None)
    if here is None:
        path = tempfile.mkdtemp(prefix="packloom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        here = f"file://{path}"
        spark.sparkContext._packloom_dir = here
    return here


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table written by ``settle``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    getattr(spark.sparkContext, "_packloom_kept", {}).pop(path, None)


def _forget(spark: SparkSession, kept: dict[str, None]) -> None:
    """Delete what is left of the settled tables when the driver ends, if its JVM still runs."""
    for path in list(kept):
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - nothing depends on it
            return


def settle(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder and read it back.

    The copy outlives executors, and the plan behind it is cut. Returns the table and its path, for ``delete``.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    path = f"{shared_dir(spark)}/packloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = getattr(sc, "_packloom_kept", None)
    if kept is None:
        kept = sc._packloom_kept = {}
        atexit.register(_forget, spark, kept)
    kept[path] = None
    # the shuffles behind the table are needed no more; Spark deletes their files once the driver collects them
    sc._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path), path
