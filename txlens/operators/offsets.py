"""Lost offsets of a log: the ranges that no record has.

Offsets of a topic partition are dense as a broker gives them, so a gap is lost data (retention, deleted files).
The offsets of one partition are cut into blocks of fixed size: gaps inside a block are found there, in tasks dealt
by (topic, partition, block), and the borders of the blocks that have records are stitched in a second step over one row
per block. So a hot partition is many tasks, not one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Offsets in a block.
BLOCK = 1_000_000


def _gap(before: Column, after: Column) -> list[Column]:
    return [(before + 1).alias("first_missing"), (after - 1).alias("last_missing"), (after - before - 1).alias("n_missing")]


def missing_offsets(log: DataFrame, block: int = BLOCK, ends: DataFrame | None = None) -> DataFrame:
    """(topic, partition, first_missing, last_missing, n_missing) of every gap between two records of a
    partition. ``ends`` (topic, partition, start, end; end exclusive) adds what is missing before the first and after
    the last record, and partitions without any record. Records that came twice make no gap."""
    keys = ["topic", "partition"]
    rows = log.select(*keys, "offset").where(F.col("offset").isNotNull()).withColumn("block", F.expr(f"offset div {block}"))
    inside = rows.withColumn("before", F.lag("offset").over(Window.partitionBy(*keys, "block").orderBy("offset")))
    found = inside.where(F.col("offset") > F.col("before") + 1).select(*keys, *_gap(F.col("before"), F.col("offset")))
    borders = rows.groupBy(*keys, "block").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    if ends is not None:
        # the log's ends as blocks of their own, whose neighbours are the offsets outside
        outer = ends.select(*keys, F.explode(F.array(
            F.struct(F.lit(-1).cast("bigint").alias("block"), (F.col("start") - 1).alias("low")),
            F.struct(F.lit((1 << 62)).alias("block"), F.col("end").alias("low")),
        )).alias("e"))
        borders = borders.unionByName(outer.select(*keys, "e.block", "e.low", F.col("e.low").alias("high")))
    before = F.lag("high").over(Window.partitionBy(*keys).orderBy("block"))
    stitched = borders.withColumn("before", before).where(F.col("low") > F.col("before") + 1)
    return found.unionByName(stitched.select(*keys, *_gap(F.col("before"), F.col("low"))))


def loss_by_partition(gaps: DataFrame, log: DataFrame) -> DataFrame:
    """(topic, partition, records, gaps, lost) of every partition that has records or gaps."""
    have = log.groupBy("topic", "partition").agg(F.count_distinct("offset").alias("records"))
    lost = gaps.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("gaps"), F.sum("n_missing").alias("lost"))
    both = have.join(lost, ["topic", "partition"], "full")
    zero = F.lit(0).cast("bigint")
    return both.select("topic", "partition", *[F.coalesce(c, zero).alias(c) for c in ("records", "gaps", "lost")])
