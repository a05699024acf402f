"""Reproducible synthetic transactions as a Spark job.

Every column is a pure function of (row id, seed): ``xxhash64(id, seed, column#)``.
The result does not depend on partitioning or task order (unlike ``rand()``), so a
rerun after a lost executor regenerates exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.schema import (
    CURRENCIES,
    GENERATOR_MAX_AMOUNT,
    GENERATOR_MIN_AMOUNT,
    GENERATOR_USERS,
    MERCHANTS,
    PAYMENT_METHODS,
    PRODUCER_TARGET_MSGS_PER_SEC,
    TRANSACTION_TYPES,
)


def _pick(values: list[str], h):
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(h, F.lit(len(values))) + 1).cast("int"))


def _hex16(h):
    return F.lpad(F.lower(F.hex(h)), 16, "0")


def generate_transactions(
    spark: SparkSession | None = None,
    n: int | None = None,
    ids: DataFrame | None = None,
    id_col: str = "id",
    users: int = GENERATOR_USERS,
    seed: int = 42,
    start_epoch: int = 1704067200,
    rate_per_sec: int = PRODUCER_TARGET_MSGS_PER_SEC,
    num_partitions: int | None = None,
) -> DataFrame:
    """Transactions of the nine message fields, one per id.

    Ids come from ``spark.range(n)`` or from a column of ``ids`` (so the amount of
    work can follow another table). ``transaction_time`` advances one second per
    ``rate_per_sec`` ids, in epoch seconds; amounts are uniform on
    [10.00, 1000.00] in whole cents.
    """
    if ids is None:
        if spark is None or n is None:
            raise ValueError("give spark and n, or ids")
        base = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
        id_col = "id"
    else:
        base = ids.select(F.col(id_col).cast("long").alias("id"))
        id_col = "id"
    i = F.col(id_col)

    def h(k: int):
        return F.xxhash64(i, F.lit(seed), F.lit(k))

    lo = int(round(GENERATOR_MIN_AMOUNT * 100))
    hi = int(round(GENERATOR_MAX_AMOUNT * 100))
    hex32 = F.concat(_hex16(h(0)), _hex16(h(1)))
    uuid_like = F.concat_ws(
        "-",
        F.substring(hex32, 1, 8),
        F.substring(hex32, 9, 4),
        F.substring(hex32, 13, 4),
        F.substring(hex32, 17, 4),
        F.substring(hex32, 21, 12),
    )
    return base.select(
        uuid_like.alias("transaction_id"),
        F.concat(F.lit("user_"), (F.pmod(h(2), F.lit(users)) + 1).cast("string")).alias("user_id"),
        ((F.pmod(h(3), F.lit(hi - lo + 1)) + lo) / F.lit(100.0)).alias("amount"),
        _pick(CURRENCIES, h(4)).alias("currency"),
        (F.lit(start_epoch) + F.floor(i / F.lit(rate_per_sec))).cast("long").alias("transaction_time"),
        _pick(MERCHANTS, h(5)).alias("merchant"),
        (F.pmod(h(6), F.lit(2)) == 0).alias("is_international"),
        _pick(TRANSACTION_TYPES, h(7)).alias("transaction_type"),
        _pick(PAYMENT_METHODS, h(8)).alias("payment_method"),
    )
