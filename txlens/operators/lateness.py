"""Late rows: what a stream's watermark does to each row, replayed over the batches of a log.

A stateful window aggregate closes windows at the watermark its batch starts with: the newest event
time of all earlier batches less the delay. It drops rows whose window the *previous* batch's watermark
has passed (rows of a window that closed one batch ago would be counted, had the window rows left). The
functions here replay this from a column that says in which micro-batch a row arrived. The
watermark needs one row per batch; rows meet it in a broadcast join of a table that has one row per
micro-batch, so nothing is sorted or shuffled by time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlens.functions.columns import interval_seconds, tumbling_start_sec
from txlens.schema import USER_WINDOW, WATERMARK_DELAY

ON_TIME, LATE, DROPPED = "on_time", "late", "dropped"


def batch_watermarks(rows: DataFrame, batch: str, ts: str = "transaction_timestamp", delay: str = WATERMARK_DELAY) -> DataFrame:
    """(batch, newest, closes, drops) per micro-batch, in epoch seconds: newest event time of the earlier batches,
    the watermark that closes windows in this batch and the one that drops late rows in it; null before there is one."""
    per = rows.groupBy(F.col(batch).alias("batch")).agg(F.max(F.unix_seconds(ts)).alias("top"))
    earlier = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)  # one row per batch
    w = per.withColumn("newest", F.max("top").over(earlier)).withColumn("closes", F.col("newest") - interval_seconds(delay))
    return w.withColumn("drops", F.lag("closes").over(Window.orderBy("batch"))).select("batch", "newest", "closes", "drops")


def with_lateness(
    rows: DataFrame, batch: str, ts: str = "transaction_timestamp", window: str = USER_WINDOW, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Adds ``lateness`` (seconds behind the newest event time of earlier batches, at least 0) and ``status``: ``dropped``
    if the row's tumbling window had closed for late rows, ``late`` if it came behind the watermark
    and is counted, else ``on_time``. A row without event time is in no window: both are null."""
    marks = batch_watermarks(rows, batch, ts, delay).withColumnRenamed("batch", "_batch")
    w = interval_seconds(window)
    joined = rows.join(F.broadcast(marks), F.col(batch) == F.col("_batch"), "left")  # bounded by the number of micro-batches
    sec = F.unix_seconds(ts)
    end = tumbling_start_sec(ts, w) + w
    status = F.when(F.col(ts).isNull(), None).when(F.coalesce(end <= F.col("drops"), F.lit(False)), DROPPED)
    status = status.when(F.coalesce(sec < F.col("closes"), F.lit(False)), LATE).otherwise(ON_TIME)
    lateness = F.when(sec.isNotNull(), F.greatest(F.coalesce(F.col("newest") - sec, F.lit(0)), F.lit(0)))
    return joined.select(*rows.columns, lateness.cast("bigint").alias("lateness"), status.alias("status"))


def counted(rows: DataFrame) -> DataFrame:
    """The rows of :func:`with_lateness` that a stream counts."""
    return rows.where(F.coalesce(F.col("status") != DROPPED, F.lit(False)))


def late_rows_by_batch(rows: DataFrame, batch: str) -> DataFrame:
    """(batch, on_time, late, dropped, untimed, max_lateness) of rows with lateness and status."""
    n = {s: F.count_if(F.coalesce(F.col("status") == s, F.lit(False))).alias(s) for s in (ON_TIME, LATE, DROPPED)}
    return rows.groupBy(F.col(batch).alias("batch")).agg(*n.values(), F.count_if(F.col("status").isNull()).alias("untimed"), F.max("lateness").alias("max_lateness"))


#: Size of the quantile sketch, and its stated error in rank for one quantile (99 % sure).
KLL_K = 200
KLL_ERROR = 0.0133


def delay_for_share(rows: DataFrame, shares: tuple[float, ...] = (0.5, 0.9, 0.99, 0.999)) -> DataFrame:
    """(share, delay_seconds): a delay that so large a share of the rows is not later than, from one mergeable
    quantile sketch of the lateness (its rank is within ``KLL_ERROR`` of the share)."""
    sketch = rows.where("lateness IS NOT NULL").agg(F.kll_sketch_agg_bigint("lateness", F.lit(KLL_K)).alias("s"), F.count(F.lit(1)).alias("n"))
    per = [F.struct(F.lit(float(q)).alias("share"), F.kll_sketch_get_quantile_bigint("s", F.lit(float(q))).alias("delay_seconds")) for q in shares]
    return sketch.where("n > 0").select(F.inline(F.array(*per)))
