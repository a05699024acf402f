"""Dead letters: the messages that the processor rejects, each with its reason.

A message counts as the processor counts it: parsed by the fixed schema, with an id and a positive
amount. What does not is looked at once more as VARIANT, which keeps a message's own types, to say
why: no text at all, not JSON, JSON but not an object, a field of another type than the schema's, no id,
no amount, or an amount that is not positive. Valid and rejected messages together are the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType

from txlens.functions.json import parse_json
from txlens.schema import TRANSACTION_SCHEMA

EMPTY, NOT_JSON, NOT_OBJECT, NO_ID, NO_AMOUNT, NOT_POSITIVE, OTHER = (
    "empty", "not_json", "not_an_object", "no_transaction_id", "no_amount", "amount_not_positive", "other",
)
#: Kinds of VARIANT values that the schema's types take.
_TAKES = {DoubleType: ("DOUBLE", "FLOAT", "DECIMAL", "BIGINT"), LongType: ("BIGINT",), BooleanType: ("BOOLEAN",)}


def _kind(variant: Column, field: str) -> Column:
    """Type of a field's value as text (``DECIMAL(5,2)`` is ``DECIMAL``); null if absent, ``VOID`` for JSON null."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(variant, f"$.{field}", "variant")), "^[A-Z]+", 0)


def wrong_types(variant: Column, parsed: Column) -> Column:
    """array<string> of ``field:TYPE`` for present fields whose value the schema's type does not take and the
    parser therefore reads as null."""
    found = []
    for f in TRANSACTION_SCHEMA.fields:
        takes = _TAKES.get(type(f.dataType))
        if takes is None:
            continue  # any JSON value is read as text
        kind = _kind(variant, f.name)
        wrong = ~kind.isin("VOID", *takes) & parsed.getField(f.name).isNull()
        found.append(F.when(F.coalesce(wrong, F.lit(False)), F.concat(F.lit(f"{f.name}:"), kind)))
    return F.array_compact(F.array(*found))


def classify_messages(envelope: DataFrame) -> DataFrame:
    """The envelope's columns and ``reason`` (null for a valid message) and ``wrong`` (fields of another type)."""
    text = F.col("value").cast("string")
    # parsed once, in a one-row generator, as for the processor
    row = F.struct(F.struct(*envelope.columns).alias("record"), parse_json(text, TRANSACTION_SCHEMA).alias("m"), F.try_parse_json(text).alias("v"))
    rows = envelope.select(F.inline(F.array(row)))
    valid = F.coalesce(F.col("m.transaction_id").isNotNull() & (F.col("m.amount") > 0), F.lit(False))
    whole = F.schema_of_variant("v")
    rows = rows.withColumn("valid", valid).withColumn("wrong", F.when(whole.startswith("OBJECT"), wrong_types(F.col("v"), F.col("m"))))
    amount_wrong = F.exists("wrong", lambda w: w.startswith("amount:"))
    reason = (
        F.when(F.col("valid"), None)
        .when(F.col("record.value").isNull() | (F.trim(F.col("record.value").cast("string")) == ""), EMPTY)
        .when(F.col("v").isNull(), NOT_JSON)
        .when(~whole.startswith("OBJECT"), NOT_OBJECT)
        .when(F.col("m.transaction_id").isNull(), NO_ID)
        .when(amount_wrong, "wrong_type")
        .when(F.col("m.amount").isNull(), NO_AMOUNT)
        .when(~(F.col("m.amount") > 0), NOT_POSITIVE)
        .otherwise(OTHER)
    )
    return rows.select("record.*", reason.alias("reason"), F.coalesce("wrong", F.array().cast("array<string>")).alias("wrong"))


def dead_letters(envelope: DataFrame) -> DataFrame:
    """The rejected messages, whole, with their reason and wrong fields."""
    return classify_messages(envelope).where(F.col("reason").isNotNull())


def rejection_report(envelope: DataFrame) -> DataFrame:
    """(reason, messages, first_offset, last_offset) per reason; valid messages as reason null."""
    return classify_messages(envelope).groupBy("reason").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )
