"""Where intermediate tables go, and how a plan is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is named."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="mixwright-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/mixwright/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet once and read it back.

    Use it for raw files before ordering them: line numbers become stored values, and
    later passes over the key columns read those columns only.
    """
    path = path or new_folder(df.sparkSession, "landed")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give a table scan at least one task per core.

    For per-row work on few files that cannot be split. Large tables have more scan tasks
    than cores and are returned as they are. Pass a plain scan: looking at the tasks of a
    plan with an exchange would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small intermediate result that is used more than once."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
