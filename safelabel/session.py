"""Session settings, shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings for new sessions.  The operators also run without them.
SQL_SETTINGS = {
    # Building expressions is several times faster when no call sites are recorded.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# A side of a join is hinted for broadcast only when it has at most this many rows.
BROADCAST_ROW_LIMIT = 100_000


def build_session(app_name: str = "safelabel", master: str | None = None, **settings) -> SparkSession:
    """Session with the library's settings; ``settings`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and stream state.

    It is the folder named by ``spark.checkpoint.dir``; where that is unset, a folder
    below the session's warehouse, which driver and executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder, never used before."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage of an expensive step that several later passes read; unlike a
    cache it survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def pin(df: DataFrame) -> DataFrame:
    """Compute a result now and keep it with the plan, as a local table.

    Only for results whose size is known to be small, such as one row per quota.
    """
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def pin_if_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> tuple[DataFrame, bool]:
    """``pin`` a table of at most ``max_rows`` rows, else leave it be; and whether it was."""
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df, False
    return df.sparkSession.createDataFrame(head, df.schema), True


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    """Hint a broadcast of a side known to be small.

    Otherwise the join stays a shuffled join, which AQE can split on skewed keys.
    """
    return F.broadcast(df) if small else df


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint a broadcast when ``df`` has at most ``max_rows`` rows, else leave it be."""
    pinned, small = pin_if_small(df, max_rows)
    return broadcast_if(small, pinned)


def collect_config(df: DataFrame, max_rows: int, what: str) -> list:
    """Rows of a configuration table (taxonomy, lexicon, quotas), size-checked."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; it is meant to be a small table")
    return rows
