"""Mixing sources to target weights by Pareto order sampling (DataFrame operations only).

Sources share a budget of words by weight; a target stops at ``most_copies`` times its source's size
and the excess is shared again by weight until none is above. Within a source every document has an
expected number of copies ``min(most_copies, c * importance)`` with ``c`` such that the expected words
meet the target. Whole copies are certain. The fractional part p is the inclusion probability of one
more copy: documents are ranked by random odds over inclusion odds, u/(1-u) * (1-p)/p with u a hash
of the id, and taken in that order while their words fit into the rest of the budget (the fixed
size). Two closing steps put in the document that fills the remaining gap best, or overshoots it by
less than the gap. Where that misses the target by more than ``NEAR`` of it (a long document came up
that did not fit), the draw goes on in rank order instead with the documents that fit into what is
left, again and again until none does, and then closes; of the two the one nearer the target counts.

A source may hold any share of all rows: order statistics per source come from histograms of 256
cells of the rank, refined twice, so a window only sees cells or the documents of one cell of 65,536.

Edge cases: a null text, or one without words, has size 0 and is never drawn (copies 0). A null
source is a source, last in order. Equal ranks (repeated ids) are ordered by size and taken together
or not at all where they tie fully. An empty table gives an empty result. A null or non-positive
importance excludes a document from drawing. Columns of other names are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, unused

WORD = r"[^\x20\x09-\x0D]+"
CELLS = 256
#: A source whose words miss its target by more than this share of it is drawn on.
NEAR = 0.01


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def default_importance(size: Column) -> Column:
    """Bit length of the size: longer documents are somewhat likelier, in whole steps, so that
    every sum over it is exact."""
    return F.length(F.bin(size)).cast("bigint")


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) from the id alone: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null; the right side's key columns go."""
    renamed = right
    for c in on:
        renamed = renamed.withColumnRenamed(c, f"_r_{c}")
    condition = None
    for c in on:
        one = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        condition = one if condition is None else condition & one
    hinted = left.join(broadcast_if_small(renamed), condition, how)
    return hinted.drop(*[f"_r_{c}" for c in on])


def shares(sources: DataFrame, budget: float | int, most_copies: int) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``: the budget by weight, each target
    at most ``most_copies`` sizes, the excess shared by weight until none is above. Every round is
    one aggregate over the sources; only two sums reach the driver."""
    cap = F.col("source_size") * most_copies
    level = 0.0
    while True:
        capped = cap <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum(F.when(capped, cap)).alias("given"), F.sum(F.when(~capped, F.col("weight"))).alias("weight")
        ).first()
        if not row["weight"]:
            return sources.withColumn("target", cap.cast("double"))
        following = (budget - (row["given"] or 0)) / row["weight"]
        if following <= level:
            break
        level = following
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _scales(docs: DataFrame, targets: DataFrame, most_copies: int) -> DataFrame:
    """Per source the factor c of the expected copies. Rounds like those of :func:`shares`, for all
    sources at once, over (source, importance) totals."""
    totals = materialize(
        docs.where("size > 0 AND importance > 0").groupBy("source", "importance").agg(F.sum("size").alias("words")), "mix-totals"
    )
    state = targets.select("source", "target", F.lit(0.0).alias("c"))
    while True:
        joined = _null_safe(totals, state, ["source"])
        capped = F.col("c") * F.col("importance") >= most_copies
        following = materialize(
            joined.groupBy("source")
            .agg(
                F.first("target").alias("target"),
                F.first("c").alias("old"),
                F.sum(F.when(capped, F.col("words")).otherwise(0)).alias("given"),
                F.sum(F.when(~capped, F.col("words") * F.col("importance")).otherwise(0)).alias("rest"),
            )
            .select(
                "source",
                "target",
                "old",
                F.when(F.col("rest") > 0, F.greatest("old", (F.col("target") - F.col("given") * most_copies) / F.col("rest")))
                .otherwise(F.col("old"))
                .alias("c"),
            ),
            "mix-scale",
        )
        state = following.select("source", "target", "c")
        if following.where("c > old").isEmpty():
            return state.select("source", "c")


def _first_that_fit(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, bound_rank, bound_id): where the running words of a source, in order of (rank, id),
    first pass its budget ``left``. Sources whose documents all fit have no row."""
    level, scale, keys = docs, 1, ["source"]
    found = budgets.select("source", "left")
    for _ in range(2):
        scale *= CELLS
        cell = F.floor(F.col("rank") * scale)
        cells = level.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
        bound = (
            _null_safe(cells.withColumn("running", running), found.select("source", "left"), ["source"])
            .where(F.col("running") > F.col("left"))
            .groupBy("source")
            .agg(F.min("cell").alias("cell"), F.min_by(F.col("left") - F.col("running") + F.col("words"), "cell").alias("left"))
        )
        found = materialize(bound, "mix-bound")
        level = _null_safe(level, found.select("source", F.col("cell").alias("_cell")), ["source"]).where(cell == F.col("_cell")).drop("_cell")
    running = F.sum("size").over(Window.partitionBy("source").orderBy("rank", "size", "doc_id"))
    past = _null_safe(level.withColumn("running", running), found.select("source", "left"), ["source"]).where(F.col("running") > F.col("left"))
    return past.groupBy("source").agg(F.min(F.struct("rank", "size", "doc_id")).alias("bound"))


def _without(docs: DataFrame, sources: DataFrame, how: str = "left_anti") -> DataFrame:
    return _null_safe(docs, sources.select("source"), ["source"], how)


def _gaps(taken: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, gap): the words of the budget that the drawn documents leave."""
    used = taken.groupBy("source").agg(F.sum(F.col("size") * F.col("drawn")).alias("used"))
    return _null_safe(budgets, used, ["source"]).select("source", (F.col("left") - F.col("used")).alias("gap"))


def _closed(taken: DataFrame, budgets: DataFrame) -> DataFrame:
    """``taken`` with up to two more documents a source, each the one that leaves the smallest gap."""
    for _ in range(2):
        open_docs = _null_safe(taken.where("drawn = 0 AND rank IS NOT NULL"), _gaps(taken, budgets), ["source"]).where("abs(gap - size) < abs(gap)")
        best = open_docs.groupBy("source").agg(
            F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "rank", "doc_id", "size")).alias("best")
        )
        chosen = (F.col("rank") == F.col("best.rank")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("size") == F.col("best.size"))
        taken = materialize(
            _null_safe(taken, best, ["source"], "left").select(
                "doc_id", "source", "size", "rank", "whole",
                F.when(F.coalesce(chosen, F.lit(False)), 1).otherwise(F.col("drawn")).alias("drawn"),
            ),
            "mix-closed",
        )
    return taken


def _drawn_on(taken: DataFrame, budgets: DataFrame) -> DataFrame:
    """``taken`` drawn on in rank order, past documents larger than what is left, until none fits."""
    while True:
        gaps = materialize(_gaps(taken, budgets), "mix-gaps")
        fitting = _null_safe(taken.where("drawn = 0 AND rank IS NOT NULL"), gaps, ["source"]).where("size <= gap")
        fitting = materialize(fitting.select("doc_id", "source", "size", "rank"), "mix-fitting")
        if fitting.isEmpty():
            return taken
        bounds = _first_that_fit(fitting, gaps.withColumnRenamed("gap", "left"))
        bounded = _null_safe(_null_safe(taken, gaps, ["source"], "left"), bounds, ["source"], "left")
        more = (F.col("size") <= F.col("gap")) & (F.col("bound").isNull() | (F.struct("rank", "size", "doc_id") < F.col("bound")))
        now = F.when(F.col("rank").isNotNull() & F.coalesce(more, F.lit(False)), 1).otherwise(F.col("drawn"))
        following = materialize(bounded.select("doc_id", "source", "size", "rank", "whole", now.alias("drawn")), "mix-drawn")
        if following.agg(F.sum("drawn")).first()[0] == taken.agg(F.sum("drawn")).first()[0]:
            return following  # only rows that tie are left, which do not fit together
        taken = following


def mix(
    sized: DataFrame,
    sources: DataFrame,
    most_copies: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """``sized`` (doc_id, source, size, importance) and ``sources`` (source, target) to
    (doc_id, source, size, copies): how often the mix takes each document."""
    docs = materialize(sized.select("doc_id", "source", "size", "importance"), "mix-sizes")
    scale = _scales(docs, sources, most_copies)
    expected = F.least(F.lit(float(most_copies)), F.col("c") * F.col("importance"))
    p = F.col("expected") - F.col("whole")
    odds = F.col("u") / (1 - F.col("u")) * ((1 - p) / p)
    drawn = (
        _null_safe(docs, scale, ["source"], "left")
        .withColumn("expected", F.when((F.col("size") > 0) & (F.col("importance") > 0), F.coalesce(expected, F.lit(0.0))).otherwise(0.0))
        .withColumn("whole", F.floor("expected"))
        .withColumn("u", uniform(F.col("doc_id"), seed))
        .withColumn("rank", F.when(p > 0, odds / (1 + odds)))
        .select("doc_id", "source", "size", "whole", "rank")
    )
    drawn = materialize(drawn, "mix-ranks")
    certain = drawn.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("certain"))
    budgets = materialize(
        _null_safe(sources.select("source", "target"), certain, ["source"]).select("source", (F.col("target") - F.col("certain")).alias("left")),
        "mix-budgets",
    )
    candidates = drawn.where(F.col("rank").isNotNull())
    bounds = _first_that_fit(candidates, budgets)
    inside = F.col("rank").isNotNull() & (F.col("bound").isNull() | (F.struct("rank", "size", "doc_id") < F.col("bound")))
    taken = _null_safe(drawn, bounds, ["source"], "left").select(
        "doc_id", "source", "size", "rank", "whole", F.coalesce(inside, F.lit(False)).cast("int").alias("drawn")
    )
    taken = materialize(taken, "mix-drawn")
    budgets = materialize(_null_safe(budgets, sources.select("source", "target"), ["source"]), "mix-budgets")
    closed = _closed(taken, budgets)
    misses = _null_safe(_gaps(closed, budgets), budgets.select("source", "target"), ["source"]).withColumn("miss", F.abs("gap"))
    missed = materialize(misses.where(F.col("miss") > NEAR * F.col("target")).select("source", "miss"), "mix-missed")
    if not missed.isEmpty():
        whole = _closed(_drawn_on(materialize(_without(taken, missed, "left_semi"), "mix-drawn"), budgets), budgets)
        nearer = _null_safe(_gaps(whole, budgets), missed, ["source"]).where("abs(gap) < miss")
        nearer = materialize(nearer.select("source"), "mix-nearer")
        closed = _without(closed, nearer).unionByName(_without(whole, nearer, "left_semi"))
    taken = closed
    return taken.select("doc_id", "source", "size", (F.col("whole") + F.col("drawn")).cast("bigint").alias("copies"))


def weighted_sources(sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most_copies: int = 2) -> DataFrame:
    """(source, source_size, weight, target): sources by code point, null last, take the weights in
    turn; together they share ``percent`` of all words."""
    per = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    # The rank of a source: its place in a range of sources, after the sources of earlier ranges.
    # Only the ranges' counts meet in one window.
    ranges = materialize(per.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()), "mix-ranges")
    counts = ranges.groupBy("range").agg(F.count("*").alias("n"))
    before = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last()))
    per = ranges.join(F.broadcast(before), "range").select("source", "source_size", (F.col("before") + inside - 1).alias("place"))
    place = F.col("place")
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = per.select("source", "source_size", F.element_at(turn, (place % len(weights) + 1).cast("int")).cast("bigint").alias("weight"))
    ranked = materialize(ranked, "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    return materialize(shares(ranked, total * percent / 100, most_copies), "mix-targets")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most_copies: int = 2, importance: Column | None = None, seed: str = "mix") -> DataFrame:
    """The mix of ``docs`` (doc_id, text, source): doc_id, source, size, copies, source_size, target."""
    size = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *([importance.alias("importance")] if importance is not None else []))
    if importance is None:
        size = size.withColumn("importance", default_importance(F.col("size")))
    sized = materialize(size, "mix-words")
    targets = weighted_sources(sized, weights, percent, most_copies)
    mixed = mix(sized, targets, most_copies, seed)
    return _null_safe(mixed, targets.select("source", "source_size", "target"), ["source"])


def repeat_documents(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``copies`` (doc_id, copies) says, all columns unchanged.

    Rows are found again by id. An id whose rows are taken differently often is settled by source and
    size as well (``copies`` must have them then), which with the id are all that a draw goes by.
    """
    key, times, copy, source, size = (unused(docs, n) for n in ("_id", "_times", "_copy", "_source", "_size"))
    per = copies.groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times), F.min("copies").alias("least"))
    per = materialize(per.where(F.col(times) > 0), "mix-times")
    by_id = F.col("doc_id").eqNullSafe(F.col(key))
    joined = docs.join(broadcast_if_small(per.where(F.col("least") == F.col(times)).drop("least")), by_id)
    differing = per.where(F.col("least") < F.col(times)).select(F.col(key).alias("_of"))
    if not differing.isEmpty():
        several = copies.where("copies > 0").join(broadcast_if_small(differing), F.col("doc_id").eqNullSafe(F.col("_of")), "left_semi")
        several = several.groupBy(F.col("doc_id").alias(key), F.col("source").alias(source), F.col("size").alias(size)).agg(F.max("copies").alias(times))
        several = materialize(several, "mix-times")
        same = by_id & F.col("source").eqNullSafe(F.col(source)) & (n_words(F.col("text")) == F.col(size))
        joined = joined.unionByName(docs.join(broadcast_if_small(several), same).drop(source, size))
    out = joined.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
