"""JSON decode/encode of message values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parse_json(col: Column | str, schema: StructType) -> Column:
    """Bytes or text to a struct of ``schema``; malformed input gives all-null fields.

    Spark's ``from_json`` is permissive: unknown fields are ignored, names are
    case-sensitive and a quoted number for a numeric field is null.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c.cast("string"), schema)


def encode_json(*cols: str | Column, keep_nulls: bool = False) -> Column:
    """Columns to one JSON object string. Null fields are left out unless ``keep_nulls``."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else None
    return F.to_json(F.struct(*cols), opts) if opts else F.to_json(F.struct(*cols))
