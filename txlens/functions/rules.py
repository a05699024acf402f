"""The three anomaly rules and the reasons array.

Each rule is a boolean column with SQL three-valued logic: a null input is never a
hit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlens.schema import (
    AMOUNT_THRESHOLD_MULTIPLIER,
    INTERNATIONAL_AMOUNT_LIMIT,
    NO_STATS_AMOUNT_LIMIT,
    REASON_HIGH_AMOUNT,
    REASON_HIGH_FREQUENCY,
    REASON_HIGH_INTERNATIONAL,
    TRANSACTION_COUNT_THRESHOLD,
)


def high_amount(
    multiplier: float = AMOUNT_THRESHOLD_MULTIPLIER,
    no_stats_limit: float = NO_STATS_AMOUNT_LIMIT,
    amount: str = "amount",
    avg: str = "avg_transaction_amount",
) -> Column:
    """amount > coalesce(avg * multiplier, no_stats_limit)."""
    return F.col(amount) > F.coalesce(F.col(avg) * F.lit(multiplier), F.lit(no_stats_limit))


def high_frequency(threshold: int = TRANSACTION_COUNT_THRESHOLD, count: str = "transaction_count") -> Column:
    """transaction_count > threshold; a null count is no hit."""
    return F.col(count) > F.lit(threshold)


def high_international(
    limit: float = INTERNATIONAL_AMOUNT_LIMIT, amount: str = "amount", flag: str = "is_international"
) -> Column:
    """is_international = true AND amount > limit."""
    return (F.col(flag) == F.lit(True)) & (F.col(amount) > F.lit(limit))


def reasons_array(amount_rule: Column, frequency_rule: Column, international_rule: Column) -> Column:
    """array<string> of the rules hit, in the fixed order AMOUNT, FREQUENCY, INTERNATIONAL.

    Built as a concatenation of one-element arrays (a null rule adds nothing), which
    stays inside whole-stage codegen; dropping nulls from an array of optional
    reasons would need a lambda, evaluated row by row outside it.
    """
    none = F.array().cast("array<string>")
    return F.concat(
        F.when(amount_rule, F.array(F.lit(REASON_HIGH_AMOUNT))).otherwise(none),
        F.when(frequency_rule, F.array(F.lit(REASON_HIGH_FREQUENCY))).otherwise(none),
        F.when(international_rule, F.array(F.lit(REASON_HIGH_INTERNATIONAL))).otherwise(none),
    )


def any_rule(amount_rule: Column, frequency_rule: Column, international_rule: Column) -> Column:
    """True when at least one rule is hit; a null rule counts as no hit."""
    no = F.lit(False)
    return F.coalesce(amount_rule, no) | F.coalesce(frequency_rule, no) | F.coalesce(international_rule, no)
