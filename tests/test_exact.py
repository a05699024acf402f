"""Order-independent sums against math.fsum."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from txlens.functions import exact


def totals(df):
    return {r["k"]: (r["total"], r["n_values"]) for r in exact.exact_totals(exact.limb_sums(df, ["k"], "x"), ["k"]).collect()}


def same(a, b):
    return a is b is None or struct.pack("<d", a) == struct.pack("<d", b) or (a == b == 0) or (a != a and b != b)


def wide(r):
    return struct.unpack("<d", struct.pack("<Q", r.getrandbits(64) & ~(0x7FF << 52) | r.randrange(0, 2020) << 52))[0]


def groups():
    r = random.Random(3)
    g = {
        "money": [round(r.uniform(-1000, 1000), 2) for _ in range(3000)],
        "mixed": [r.choice([2e17, -2e17, 0.004, 1e-300, 12.34, 0.1]) for _ in range(2000)],
        "cancel": [1e300, 1.0, -1e300, 1e-17, 3.0],
        "zero": [0.0, -0.0, 5.5, -5.5],
        "ties": [1.0, 2.0**-53],
        "above a tie": [1.0, 2.0**-53, 2.0**-1074],
        "below a tie": [1.0, 2.0**-53, -(2.0**-1074)],
        "odd tie": [1.0 + 2.0**-52, 2.0**-53],
        "negative tie": [-1.0 - 2.0**-52, -(2.0**-53)],
        "subnormal": [2.0**-1074] * 7 + [2.0**-1060, -(2.0**-1050)],
        "carry to a power": [float((1 << 53) - 1), 0.5, 0.25, 0.25],
        "one": [-0.1],
    }
    for k in range(40):
        g[f"wide {k}"] = [wide(r) for _ in range(r.randrange(1, 60))]
        g[f"near {k}"] = [r.choice([-1, 1]) * 2.0 ** r.randrange(-60, 60) * (1 + r.random()) for _ in range(r.randrange(1, 200))]
        g[f"power {k}"] = [r.choice([-1, 1]) * 2.0 ** (24 * r.randrange(-44, 42) + r.choice([-1, 0, 1])) for _ in range(r.randrange(1, 30))]
    return g


def test_sums_equal_fsum(spark):
    g = groups()
    df = spark.createDataFrame([(k, x) for k, xs in g.items() for x in xs], "k string, x double")
    got = totals(df)
    wrong = {k: (got[k][0], math.fsum(xs)) for k, xs in g.items() if not same(got[k][0], math.fsum(xs))}
    assert not wrong
    assert all(got[k][1] == len(xs) for k, xs in g.items())


def test_sums_do_not_depend_on_the_order(spark):
    g = {k: v for k, v in groups().items() if k in ("money", "mixed")}
    g["special"] = [math.inf, 1.0, 2e17, 0.004]
    rows = [(k, x) for k, xs in g.items() for x in xs]
    found = set()
    for seed in range(20):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, x double").repartition(1 + seed % 7, F.rand(seed))
        found.add(repr(sorted(totals(df).items())))
    assert len(found) == 1


def test_special_values_and_empty_groups(spark):
    inf, nan = math.inf, math.nan
    g = {"nan": [1.0, nan], "inf": [inf, 2.0], "minus": [-inf, None], "both": [inf, -inf], "null": [None, None], "some": [None, 2.5], None: [1.0, 2.0]}
    got = totals(spark.createDataFrame([(k, x) for k, xs in g.items() for x in xs], "k string, x double"))
    assert same(got["nan"][0], nan) and same(got["both"][0], nan)
    assert got["inf"] == (inf, 2) and got["minus"] == (-inf, 1) and got["null"] == (None, 0) and got["some"] == (2.5, 1) and got[None] == (3.0, 2)
    assert totals(spark.createDataFrame([], "k string, x double")) == {}


def test_every_limb_is_exact(spark):
    r = random.Random(5)
    xs = [2.0**e for e in range(-1074, 1024)] + [wide(r) for _ in range(2000)] + [math.nextafter(2.0**e, 0) for e in range(-1000, 1000, 24)]
    rows = exact.with_limbs(spark.createDataFrame([(x,) for x in xs], "x double"), "x").collect()
    from fractions import Fraction

    for row in rows:
        total = sum(Fraction(row[p]) / (1 << (24 * j)) for j, p in enumerate("abcd")) * Fraction(2) ** (24 * row["level"])
        assert total == Fraction(row["x"]), row


def test_partial_sums_merge(spark):
    g = groups()
    df = spark.createDataFrame([(k, x, i % 5) for k, xs in g.items() for i, x in enumerate(xs)], "k string, x double, part int")
    merged = exact.exact_totals(exact.merge_limb_sums(exact.limb_sums(df, ["k", "part"], "x"), ["k"]), ["k"]).collect()
    assert all(same(r["total"], math.fsum(g[r["k"]])) for r in merged)


def test_plan_has_no_python(spark):
    df = spark.range(10).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("x"))
    plan = exact.exact_totals(exact.limb_sums(df, ["k"], "x"), ["k"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
