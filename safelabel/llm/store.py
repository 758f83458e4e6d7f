"""Intermediate tables in the folder that driver and executors share.

The folder is the session's ``spark.checkpoint.dir``; only where the master is local, as in
tests, may it be unset, and a folder below the session's warehouse serves. A written table cuts the lineage: a lost
executor costs its own tasks, not the whole history.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm-stage"


def written(frame: DataFrame) -> DataFrame:
    """The frame, written as Parquet into the shared folder and read back."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out.stage_path = path
    return out


def remove(*frames: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for frame in frames:
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame.stage_path)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(frame: DataFrame, name: str) -> str:
    """The name, or one made from it, that no column of the frame has, whatever its case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def broadcast_if_small(frame: DataFrame, rows: int, limit: int) -> DataFrame:
    """The frame with a broadcast hint if its counted ``rows`` are within ``limit``, else as it is."""
    return F.broadcast(frame) if rows <= limit else frame


#: Stands for a missing id while rows are in pandas, where a null would turn ids into floats.
NO_ID = -(1 << 63)


def named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID)).alias(column)


def unnamed(frame: DataFrame, column: str) -> DataFrame:
    return frame.withColumn(column, F.when(F.col(column) != NO_ID, F.col(column)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
