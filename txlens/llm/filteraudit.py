"""Interaction of filters over every order of applying them, by difference arrays on Lehmer ranks.

Each row fails a set of the filters, its mask. In an order of the filters it is removed by the first
that it fails, so a mask's removal at step s is settled by the first s letters of the order: those
before the s-th are not in the mask, the s-th is. Orders that share their first s letters have
consecutive lexicographic ranks (the prefix's Lehmer code times (n-s)! and on), so each mask and step
covers some intervals of the ranks. Rows are counted by part and mask, the counts are added at the
starts of these intervals and taken off behind their ends, and a running sum along the ranks gives the
rows removed in every order: work grows with masks times interval ends, not with rows times orders.

The five filters of :func:`quality_masks` (letter, failure condition): A: under 200 words; B: under half
of the words distinct; C: over 2 % of the code points are A-Z; D: holds any of ``#$%&*|``; E: identical
to the text of a smaller id. Texts are told by their SHA-256. Whether E fails is found after equal
texts of one part and label are counted together, so a text in a third of all rows is a few rows a part
wherever rows meet by their text.

Edge cases: a null text is empty (0 words fail A only; identical to other empty texts); a null part is
the empty string. E compares ids: rows of the smallest id (all of them, if repeated) do not fail, a null
id is neither smaller nor larger than another and does not fail. A row is good (toxic) when any label
row of its id says quality 1 (toxic 1); absent and null labels count as neither. Repeated rows count
each time. Parts without failing rows have all their rows (zeros) too; an empty table gives an empty
result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

WHITE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n", "good", "toxic")


def removal_intervals(mask: int, filters: int) -> dict[int, list[tuple[int, int]]]:
    """For each step (from 1) the rank intervals [start, end) in which ``mask`` is removed at it."""
    found: dict[int, list[tuple[int, int]]] = {s: [] for s in range(1, filters + 1)}
    work = [(0, list(range(filters)), 0)]  # rank of the first order with this prefix, letters left, step
    while work:
        start, left, step = work.pop()
        size = factorial(len(left) - 1)
        for k, letter in enumerate(left):
            at = start + k * size
            if mask >> letter & 1:
                found[step + 1].append((at, at + size))
            elif len(left) > 1:
                work.append((at, left[:k] + left[k + 1 :], step + 1))
    merged: dict[int, list[tuple[int, int]]] = {}
    for step, spans in found.items():
        merged[step] = []
        for a, b in sorted(spans):
            if merged[step] and merged[step][-1][1] == a:
                merged[step][-1] = (merged[step][-1][0], b)
            else:
                merged[step].append((a, b))
    return merged


def interval_ends(spark: SparkSession, filters: int) -> DataFrame:
    """(mask, step, rank, sign): where a mask's count is added and taken off. Fixed by ``filters``."""
    orders = factorial(filters)
    rows = [
        (mask, step, rank, sign)
        for mask in range(1, 1 << filters)
        for step, spans in removal_intervals(mask, filters).items()
        for span in spans
        for rank, sign in zip(span, (1, -1))
        if rank < orders
    ]
    return spark.createDataFrame(rows, "mask int, step int, rank int, sign int").coalesce(1)


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """``counts`` (part, mask, n, good, toxic; one row per part and mask) to one row per part, order
    and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    size, orders = len(letters), factorial(len(letters))
    counts = counts.repartition("part")  # at most 2^size rows a part; all that follows stays in its partition
    bit = lambda k: F.col("mask").bitwiseAND(1 << k) != 0
    zero = F.lit(0).cast("bigint")
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(F.when(bit(k), F.col("n")).otherwise(zero)) for k in range(size)]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(zero)) for k in range(size)]).alias("alone"),
    )
    ends = counts.join(F.broadcast(interval_ends(counts.sparkSession, size)), "mask")
    ends = ends.select("part", "step", "rank", *[(F.col("sign") * F.col(c)).alias(c) for c in COUNTS])
    grid = totals.select("part", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
    grid = grid.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("rank"), *[zero.alias(c) for c in COUNTS])
    changes = ends.unionByName(grid).repartition("part").groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])

    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = changes.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS])
    names = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    removed = removed.withColumn("filter_order", F.element_at(names, F.col("rank") + 1))
    removed = removed.withColumn("own", F.expr("substring(filter_order, step, 1)"))
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    place = F.instr(F.lit(letters), F.col("own"))
    done = removed.withColumn("gone", F.sum("n").over(steps)).withColumn("shapley", F.sum("n").over(Window.partitionBy("part", "own")))
    return done.join(totals, "part").select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("gone")).alias("kept"),
        F.col("n").alias("removed"),
        (F.element_at("fails", place) - F.col("n")).alias("redundant"),
        F.element_at("alone", place).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        "shapley",
    )


def text_mask(text: Column) -> Column:
    """Bits 1, 2, 4, 8 for failing A, B, C, D."""
    pieces = F.split(text, WHITE)
    first, last = F.element_at(pieces, 1) == "", F.element_at(pieces, -1) == ""
    words = F.size(pieces) - first.cast("int") - (last & (F.size(pieces) > 1)).cast("int")
    distinct = F.size(F.array_distinct(pieces)) - (first | last).cast("int")
    others = F.char_length(F.translate(text, CAPITALS, ""))
    chars = F.char_length(text)
    failing = (
        words < 200,
        100 * distinct.cast("bigint") < 50 * words.cast("bigint"),
        100 * (chars - others).cast("bigint") > 2 * chars.cast("bigint"),
        text.rlike("[#$%&*|]"),
    )
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failing)), F.lit(0))


def quality_masks(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic) of all rows under the filters A to E, one row per part and mask."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")
    )
    rows = materialize(rows.groupBy("digest", "mask", "part", "id").agg(F.count("*").alias("c")), "audit-rows")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    # rows without an id have no label; a second key deals them over all partitions
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest", "part"), F.lit(1024))).otherwise(0)
    rows = rows.withColumn("spread", spread).join(marks.withColumn("spread", F.lit(0).cast("bigint")), ["id", "spread"], "left")
    good, toxic = (F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic"))
    known = F.when(F.col("id").isNotNull(), F.struct("id", "c"))
    equal = rows.groupBy("digest", "mask", "part", good, toxic).agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("c")).otherwise(0)).alias("unknown"), F.min(known).alias("first")
    )
    least = F.min("first.id").over(Window.partitionBy("digest"))
    stay = F.col("unknown") + F.when(F.col("first.id") == F.col("least"), F.col("first.c")).otherwise(0)
    equal = equal.withColumn("least", least).withColumn("stay", stay)
    sides = F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("stay").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("stay")).alias("n"))))
    split = equal.select("part", "good", "toxic", sides.alias("side")).where("side.n > 0")
    count = F.col("side.n")
    return split.groupBy("part", F.col("side.mask").alias("mask")).agg(
        F.sum(count).alias("n"),
        F.sum(F.when(F.col("good"), count).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), count).otherwise(0)).alias("toxic"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`audit` of the filters A to E."""
    return audit(materialize(quality_masks(docs, labels, part_col, id_col, text_col), "audit-counts"), "ABCDE")
