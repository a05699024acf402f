"""Sums of doubles that do not depend on the order of rows, rounded once.

A finite double is an integer times a power of two. Cut at multiples of 2^24 it fills at most four
neighbouring 24-bit *limbs*: :func:`with_limbs` gives the number of the highest (its *level*) and the four signed
integers, by exact operations only (scaling by powers of two, floor). Integers add up exactly in any
order, so the limbs of one group and level are summed as bigints (room for 2^37 rows) and the levels
of a group, 89 for all doubles and one or two in practice, are joined at the end (:func:`rounded`): carries
go up, and the leading bits are rounded half to even to 53, with every bit below them looked at. The
result is that of ``math.fsum``. NaN and infinities follow the rules of addition, a sum of zeros is 0.0.

Limb sums merge like counts: partial sums of panes, days or files can be kept and added later
(:func:`limb_sums`, :func:`merge_limb_sums`, :func:`exact_totals`). All of it is column expressions and hash
aggregates with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
#: Level of the smallest doubles.
LOWEST = -45
#: Levels that stand for values that are not finite.
INFINITE, MINUS_INFINITE, NAN = 1001, 1002, 1003
_PARTS = ["a", "b", "c", "d"]


def _scaled(x: Column, power: Column) -> Column:
    """x times 2^power, exact where the result is a double; in two steps, since one power may leave
    the range of doubles."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half.cast("double")) * F.pow(F.lit(2.0), (power - half).cast("double"))


def with_limbs(df: DataFrame, value: str) -> DataFrame:
    """Adds level, a, b, c, d with value = (a + b/2^24 + c/2^48 + d/2^72) * 2^(24 level); null for null.

    The logarithm may miss by one bit at a power of two: the highest limb then holds a 25th bit, or
    none, and four limbs still hold all 53. Steps are columns of their own, each computed once."""
    x, unit, infinite = F.col(value), float(1 << BITS), F.lit(float("inf"))
    ordinary = ~F.isnan(x) & (F.abs(x) != infinite) & (x != 0)
    special = F.when(F.isnan(x), NAN).when(x == infinite, INFINITE).when(x == -infinite, MINUS_INFINITE).otherwise(0)
    df = df.withColumn("_size", F.when(ordinary, F.abs(x)))
    df = df.withColumn("_level", F.when(F.col("_size").isNotNull(), F.greatest(F.floor(F.floor(F.log2("_size")) / BITS), F.lit(LOWEST))))
    df = df.withColumn("_head", _scaled(F.col("_size"), -F.col("_level") * BITS))
    df = df.withColumn("_a", F.floor("_head"))
    df = df.withColumn("_rest", (F.col("_head") - F.col("_a").cast("double")) * (unit * unit))
    df = df.withColumn("_bc", F.floor("_rest"))
    found = {
        "a": F.col("_a"),
        "b": F.shiftright("_bc", BITS),
        "c": F.col("_bc").bitwiseAND((1 << BITS) - 1),
        "d": F.floor((F.col("_rest") - F.col("_bc").cast("double")) * unit),
    }
    sign = F.when(x < 0, -1).otherwise(1)
    df = df.withColumns({n: F.when(x.isNotNull(), F.coalesce((sign * v).cast("bigint"), F.lit(0).cast("bigint"))) for n, v in found.items()})
    df = df.withColumn("level", F.when(x.isNotNull(), F.coalesce("_level", special)).cast("int"))
    return df.drop("_size", "_level", "_head", "_a", "_rest", "_bc")


def limb_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, level, a, b, c, d, n): limb sums and number of the non-null values of each group and
    level; a group without any has one row of level null. Keys have none of these names."""
    rows = with_limbs(df.select(*keys, F.col(value).alias("_x")), "_x")
    return rows.groupBy(*keys, "level").agg(*[F.coalesce(F.sum(p), F.lit(0)).alias(p) for p in _PARTS], F.count("level").alias("n"))


def merge_limb_sums(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Limb sums of coarser groups."""
    return sums.groupBy(*keys, "level").agg(*[F.sum(p).alias(p) for p in _PARTS], F.sum("n").alias("n"))


_LIMB = " ".join(f"WHEN p.level - {j} THEN p.{n}" for j, n in enumerate(_PARTS))


def rounded(df: DataFrame, parts: str, out: str) -> DataFrame:
    """Adds ``out``: the double nearest to the sum of ``parts`` (array of structs level, a, b, c, d of finite
    levels), ties to even; null for no parts. A name that starts with an underscore is taken for steps."""
    b = BITS
    steps = {
        "_low": f"array_min(transform({parts}, p -> p.level)) - {len(_PARTS) - 1}",
        # sums of 63 bits carry into three levels more, and the sign into one
        "_limbs": f"transform(sequence(_low, array_max(transform({parts}, p -> p.level)) + 4), k -> "
        f"aggregate({parts}, 0L, (t, p) -> t + CASE k {_LIMB} ELSE 0L END))",
        "_sign": f"CASE WHEN aggregate(_limbs, 0L, (c, v) -> shiftright(c + v, {b})) < 0 THEN -1L ELSE 1L END",
        "_digits": f"aggregate(_limbs, named_struct('carry', 0L, 'd', cast(array() AS array<bigint>)), (s, v) -> named_struct("
        f"'carry', shiftright(s.carry + _sign * v, {b}), 'd', concat(s.d, array(pmod(s.carry + _sign * v, {1 << b}L)))), s -> s.d)",
        "_top": "aggregate(sequence(0, size(_digits) - 1), -1, (t, i) -> CASE WHEN get(_digits, i) <> 0 THEN i ELSE t END)",
        "_head": f"shiftleft(get(_digits, _top), {b}) + coalesce(get(_digits, _top - 1), 0L)",
        "_tail": f"shiftleft(coalesce(get(_digits, _top - 2), 0L), {b}) + coalesce(get(_digits, _top - 3), 0L)",
        "_sticky": "exists(slice(_digits, 1, greatest(_top - 3, 0)), d -> d <> 0)",
        # bits of the tail that the 53 take in
        "_take": "53 - length(bin(_head))",
        "_whole": f"shiftleft(_head, _take) + shiftright(_tail, {2 * b} - _take)",
        "_left": f"_tail & (shiftleft(1L, {2 * b} - _take) - 1L)",
        "_half": f"shiftleft(1L, {2 * b} - 1 - _take)",
        "_up": "CASE WHEN _left > _half OR (_left = _half AND (_sticky OR _whole & 1L = 1L)) THEN 1L ELSE 0L END",
    }
    for name, sql in steps.items():
        df = df.withColumn(name, F.expr(sql))
    value = _scaled((F.col("_sign") * (F.col("_whole") + F.col("_up"))).cast("double"), (F.col("_low") + F.col("_top") - 1) * b - F.col("_take"))
    value = F.when(F.size(parts) > 0, F.when(F.col("_top") < 0, F.lit(0.0)).otherwise(value))
    return df.withColumn(out, value).drop(*steps)


def exact_totals(sums: DataFrame, keys: Sequence[str], out: str = "total", count: str = "n_values") -> DataFrame:
    """(keys, ``out``, ``count``) from limb sums: the exact total rounded once (null without values) and
    the number of values."""
    part = F.struct("level", *_PARTS)
    finite = F.col("level") < INFINITE
    g = sums.groupBy(*keys).agg(
        F.sum("n").alias(count),
        F.collect_list(F.when(finite, part)).alias("_parts"),
        *[F.coalesce(F.bool_or(F.col("level") == k), F.lit(False)).alias(f"_is{k}") for k in (NAN, INFINITE, MINUS_INFINITE)],
    )
    nan, plus, minus = (F.col(f"_is{k}") for k in (NAN, INFINITE, MINUS_INFINITE))
    g = rounded(g, "_parts", "_total")
    total = F.when(nan | (plus & minus), F.lit(float("nan"))).when(plus, F.lit(float("inf"))).when(minus, F.lit(float("-inf"))).otherwise(F.col("_total"))
    return g.select(*keys, total.alias(out), count)
