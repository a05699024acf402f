"""Small-row builders for unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from txlens.schema import TRANSACTION_SCHEMA

UTC = dt.timezone.utc


def ts(h: int, m: int, s: int = 0, day: int = 1) -> dt.datetime:
    return dt.datetime(2024, 1, day, h, m, s, tzinfo=UTC)


def epoch(h: int, m: int, s: int = 0, day: int = 1) -> int:
    return int(ts(h, m, s, day).timestamp())


def tx_rows(spark, rows):
    """rows: dicts with any of the nine fields; missing ones are null."""
    names = [f.name for f in TRANSACTION_SCHEMA.fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    schema = TRANSACTION_SCHEMA
    from pyspark.sql.types import StructField, StructType

    schema = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(data, schema)


def prepared(spark, rows):
    from txlens.operators.clean import prepare_transactions

    return prepare_transactions(tx_rows(spark, rows))


def sorted_rows(df, *cols):
    """Rows in a fixed order; doubles to ten digits, since sums depend on the order of rows."""
    rows = (tuple(float(f"{v:.10g}") if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())
    return sorted(map(tuple, ([repr(v) if isinstance(v, float) and v != v else v for v in r] for r in rows)), key=lambda r: tuple((x is None, str(x)) for x in r))


def secs(col):
    return F.unix_seconds(col)
