"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app="replylens", master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder, because there
    the driver and the executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="replylens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Paths written inside of each open `temporary_stages`.
_open_stages: list[list[str]] = []


@contextmanager
def temporary_stages(spark: SparkSession):
    """Delete what `cut_lineage` writes inside of the block at its end.

    For steps that end with a write; a DataFrame that reads a stage must not leave the block.
    """
    _open_stages.append([])
    try:
        yield
    finally:
        for path in _open_stages.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write `df` to the shared folder and go on from there.

    A lost executor then costs no recomputation, and the columns can still be pruned. `partition_by` names the
    columns of which a reader asks for single values.
    """
    path = scratch_path(df.sparkSession, "stage")
    if _open_stages:
        _open_stages[-1].append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
