"""Quality classifier: support vectors over n-gram indicators scaled by naive Bayes ratios.

Each indicator counts r = log of its smoothed share among good rows over that among bad rows. A
row's vector holds r for the indicators it has, scaled to unit length; a linear hinge-loss model is
fitted to it by dual coordinate descent, and its weights are interpolated with their mean size, the
weight that plain naive Bayes would give all of them. Margins become probabilities by a sigmoid fitted to rows that the model did not
see.

The fit uses a bounded sample of labelled rows (``MOST_ROWS``, a documented parameter) and a bounded
number of features; every document is scored whole.

Edge cases: null or empty texts have no indicators and get the calibrated bias. With no labelled rows,
or those of one class only, every score is the smoothed share of good rows. Ties do not matter. An
empty table gives an empty result; columns of other names are not read, scores use the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches, unused
from .linear import calibrate, dual_coordinate_descent, margins, sigmoid
from .ngrams import choose_features, class_counts, held_out, indicators, sparse_rows, training_rows

MOST_ROWS = 8_000
MOST_FEATURES = 30_000
LEAST_ROWS = 3
LEAST_Z = 1.0
SMOOTHING = 1.0
COST = 4.0
#: Share of the fitted weights against their mean size.
INTERPOLATION = 0.25


@dataclass
class QualityModel:
    features: list[bytes]
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    a: float
    b: float

    def tables(self) -> tuple[dict, float, float, float]:
        """Per feature its part of the margin and of the squared length; bias; sigmoid."""
        parts = {f: (float(r * w), float(r * r)) for f, r, w in zip(self.features, self.ratio, self.weight)}
        return parts, self.bias, self.a, self.b


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", most_rows: int = MOST_ROWS) -> QualityModel:
    rows = materialize(
        training_rows(docs, labels.select("doc_id", F.col(label_col).alias("good")), ["good"], most_rows), "quality-sample"
    )
    total, good = rows.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    if not good or good == total:
        share = (good + 1) / (total + 2)
        return QualityModel([], np.zeros(0), np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    counts = class_counts(rows, ["good"])
    chosen = choose_features(counts, ["good"], {"total": total, "good": good}, LEAST_ROWS, LEAST_Z, MOST_FEATURES)
    features = [bytes(r["feature"]) for r in chosen]
    p = np.array([r["good"] for r in chosen], float) + SMOOTHING
    q = np.array([r["total"] - r["good"] for r in chosen], float) + SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    sample = sparse_rows(rows, ["good"], features)
    y = np.array([1.0 if r["good"] else -1.0 for r in sample])
    vectors = []
    for r in sample:
        ids = np.frombuffer(r["ids"], np.int32)
        values = ratio[ids]
        vectors.append((ids, values / (np.sqrt(values @ values) or 1.0)))
    # both classes carry the same total cost
    cost = COST * np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    seen = np.arange(len(y)) % 5 != 0

    at = np.flatnonzero(seen)
    w = dual_coordinate_descent([vectors[i] for i in at], y[at], len(features), cost[at])
    # in units of r the plain naive Bayes model has the weight 1 everywhere
    w[:-1] = (1 - INTERPOLATION) * np.abs(w[:-1]).mean() + INTERPOLATION * w[:-1]
    unseen = np.flatnonzero(~seen)
    a, b = calibrate(margins([vectors[i] for i in unseen], w), y[unseen])
    return QualityModel(features, ratio, w[:-1], float(w[-1]), a, b)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` and a column with the probability of label 1."""
    spark = docs.sparkSession
    small_batches(spark)
    tables = spark.sparkContext.broadcast(model.tables())  # bounded by MOST_FEATURES
    at = docs.columns.index(text_col)
    names = [*docs.columns, out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bias, a, b = tables.value
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                found = [parts[f] for f in indicators(text or "") if f in parts]
                length = sum(n for _, n in found) ** 0.5
                margin = bias + (sum(m for m, _ in found) / length if length else 0.0)
                out.append(float(sigmoid(a * margin + b)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, `{out_col}` double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns unchanged."""
    name = unused(docs, "_quality")
    return score(docs, fit(docs, labels), text_col, name).where(F.col(name) >= 0.5).drop(name)
