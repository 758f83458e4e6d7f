"""Shards of near equal bytes by Karmarkar-Karp differencing over indivisible groups.

Rows of equal text form a group and stay together. The corpus is first brought to a bounded
number of units, whatever its size: groups larger than a share of a shard are units of their
own, of which there cannot be many; the others fall by hash into ``UNITS_PER_SHARD`` bundles
a shard. Sums are combined on the map side, so a group with a third of all rows is one row
from each task. Differencing then runs over the units: the two partial partitions with the
largest spread are combined, the largest part of one with the smallest of the other, until
one is left.

Slots are numbered without sorting a shard in one task: rows fall into chunks of bounded
size, chunks are counted, and each is numbered from where the one before it ends.

Null and empty texts are one group of size 8 each row. Rows that repeat a doc_id are rows of
their own; their slots tie on doc_id and checksum, and are then interchangeable. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from safelabel.llm.store import written

OVERHEAD = 8
UNITS_PER_SHARD = 512
CHUNK_ROWS = 50_000


def difference(sizes: list[int], shards: int) -> list[int]:
    """Shard of each unit, by Karmarkar-Karp differencing into ``shards`` parts."""
    # A partial partition: parts from largest to smallest as (size less the smallest, units).
    heap = []
    for i, size in enumerate(sizes):
        parts = [(size, (i,))] + [(0, ())] * (shards - 1)
        heap.append((-size, i, parts))
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # Unit lists are kept as nested pairs, so joining two costs no copying.
        joined = sorted(((x + y, (p, q) if p and q else p or q) for (x, p), (y, q) in zip(a, reversed(b), strict=True)), key=lambda part: -part[0])
        least = joined[-1][0]
        joined = [(x - least, p) for x, p in joined]
        count += 1
        heapq.heappush(heap, (-joined[0][0], count, joined))
    out = [0] * len(sizes)
    for shard, (_, nested) in enumerate(heap[0][2] if heap else ()):
        stack = [nested]
        while stack:
            node = stack.pop()
            for child in node:
                if isinstance(child, int):
                    out[child] = shard
                else:
                    stack.append(child)
    return out


def _assign(frame: pd.DataFrame, shards: int) -> pd.DataFrame:
    frame = frame.sort_values(["size", "unit"], ascending=[False, True], ignore_index=True)
    return pd.DataFrame({"unit": frame["unit"], "shard": difference(frame["size"].tolist(), shards)})


def shard_rows(documents: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, shard) of every row; rows of equal text share a shard."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text).alias("print"),
    )
    rows = written(rows)
    total = rows.agg(F.sum("size")).first()[0] or 0
    bundles = UNITS_PER_SHARD * shards
    large = max(1, total // (shards * 64))  # at most shards * 64 groups and a few reach this size
    bundle = F.concat(F.lit("b"), F.pmod(F.xxhash64("print"), F.lit(bundles)).cast("string"))
    groups = rows.groupBy("print").agg(F.sum("size").alias("size")).where(F.col("size") >= large)
    units = rows.join(F.broadcast(groups.select("print", F.lit(True).alias("own"))), "print", "left").withColumn("unit", F.when(F.col("own"), F.col("print")).otherwise(bundle))
    # At most (512 + 64) units a shard: a bounded table for one task.
    sums = units.groupBy("unit").agg(F.sum("size").alias("size"))
    placed = written(sums.groupBy().applyInPandas(lambda frame: _assign(frame, shards), "unit string, shard int"))
    return units.join(F.broadcast(placed), "unit").select("doc_id", "size", "text_crc32", "shard")


def numbered(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows with ``slot``: 0, 1, ... within each shard."""
    held = written(rows)
    chunks = max(1, -(-held.count() // chunk_rows))
    held = held.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(chunks)))
    counts = held.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32"))
    ranked = held.withColumn("rank", rank)
    return ranked.join(offsets, ["shard", "chunk"]).withColumn("slot", (F.col("before") + F.col("rank") - 1).cast("long")).drop("chunk", "before", "rank")


def balanced_shards(documents: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    return numbered(shard_rows(documents, shards))
