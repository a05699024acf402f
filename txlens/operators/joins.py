"""Joins whose broadcast side has a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    IntegerType,
    MapType,
    StringType,
    StructType,
)

from txlens.session import scratch_path

# A statistics row is well under 100 bytes; 1M rows keep a broadcast relation far
# below executor memory while covering e.g. 1,000 users x 1,000 windows.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Beyond the broadcast bound, a key with more rows than this is salted into buckets.
DEFAULT_HOT_KEY_ROWS = 2_000_000


def _estimated_width(dt: DataType) -> int:
    if isinstance(dt, StructType):
        return sum(_estimated_width(f.dataType) for f in dt.fields)
    if isinstance(dt, (StringType, BinaryType)):
        return 24
    if isinstance(dt, ArrayType):
        return 16 + 4 * _estimated_width(dt.elementType)  # a few elements
    if isinstance(dt, MapType):
        return 16 + 4 * (_estimated_width(dt.keyType) + _estimated_width(dt.valueType))
    if isinstance(dt, BooleanType):
        return 1
    if isinstance(dt, IntegerType):
        return 4
    return 8


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of their values (strings and binaries as long as they are)."""
    per_row = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            per_row = per_row + F.lit(8) + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        else:
            per_row = per_row + F.lit(_estimated_width(f.dataType))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()
    return row["n"], row["bytes"]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor does not recompute the upstream job) and gives
    a cheap exact row count from the written table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)



def join_small_side(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "left",
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
    name: str = "join-side",
    small_alias: str | None = None,
    count_col: str | None = None,
    hot_rows: int = DEFAULT_HOT_KEY_ROWS,
    salt_cols: list[str] | None = None,
) -> DataFrame:
    """``big JOIN small``; ``small`` is broadcast only when its measured size fits.

    ``on`` is a list of key columns or a join condition; a condition must refer to
    ``small`` through the alias ``small_alias``, since the side is re-read from its
    written table. ``small`` is written once to the shared folder and counted. Within
    ``max_rows`` and ``max_bytes`` (measured) it is broadcast and ``big`` is never
    shuffled.

    Beyond that it is a shuffle join on the keys. When ``count_col`` gives, per key
    of ``small``, the number of ``big`` rows with that key (as a statistics table
    does), hot keys are split explicitly: a key with more than ``hot_rows`` rows gets
    ceil(rows / hot_rows) salt buckets, its ``big`` rows a deterministic salt
    (hash of ``salt_cols``) and its ``small`` row one copy per bucket, so no task
    receives more than about ``hot_rows`` rows of one key. The hot-key list is
    bounded by total rows / ``hot_rows`` and is itself size-checked before it is
    broadcast. Other keys keep salt 0 (one copy). Adaptive skew splitting stays on
    as a second line.
    """
    small = materialize(small, name)
    n, size = measured_size(small)
    if n <= max_rows and size <= max_bytes:
        s = small.alias(small_alias) if small_alias else small
        return big.join(F.broadcast(s), on, how)
    if count_col is None or not isinstance(on, (list, tuple)):
        # Too big to broadcast by our measure: keep Spark from broadcasting it on the
        # (compressed) file size, and shuffle-join instead.
        s = small.alias(small_alias) if small_alias else small
        return big.join(s.hint("merge"), on, how)

    keys = list(on)
    hot = materialize(
        small.filter(F.col(count_col) > F.lit(hot_rows)).select(
            *keys, F.ceil(F.col(count_col) / F.lit(hot_rows)).cast("int").alias("_buckets")
        ),
        f"{name}-hot",
    )
    n_hot, hot_size = measured_size(hot)
    if n_hot == 0:
        return big.join(small.hint("merge"), keys, how)
    hot_side = F.broadcast(hot) if n_hot <= max_rows and hot_size <= max_bytes else hot
    cols = salt_cols or [c for c in big.columns if c not in keys][:4]
    salted_big = big.join(hot_side, keys, "left").withColumn(
        "_salt",
        F.when(F.col("_buckets").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.col("_buckets")).cast("int")
        ),
    ).drop("_buckets")
    salted_small = small.join(hot_side, keys, "left").select(
        "*", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_buckets"), F.lit(1)) - 1)).alias("_salt")
    ).drop("_buckets")
    return salted_big.join(salted_small.hint("merge"), keys + ["_salt"], how).drop("_salt")
