"""Toxicity by a classifier chain over n-gram indicators.

Categories are predicted one after the other. The model of a category is linear (hinge loss, dual
coordinate descent) over the text's indicators and the probabilities of the categories before it.
For its training those probabilities come from models that did not see the row (out-of-fold), as
they will for new documents; margins become probabilities by a sigmoid fitted to out-of-fold margins.

Only indicators whose counts deviate clearly from independence of some category are features, so
a long text is judged by its telling words, not by its length. Both the labelled sample and the
number of features are bounded by documented parameters; every document is scored whole.

Edge cases: null or empty texts have no indicators. A row whose label of one category is null trains the
others. An id that repeats is one row of the sample. A category without rows of both classes in the
sample gets the smoothed share of positive rows as its probability everywhere. An empty table
gives an empty result; columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .linear import calibrate, dual_coordinate_descent, margins, sigmoid
from .ngrams import choose_features, class_counts, held_out, indicators, sparse_rows, training_rows

MOST_ROWS = 12_000
MOST_FEATURES = 2_000
LEAST_ROWS = 4
LEAST_Z = 5.0
FOLDS = 5
#: Beginnings of words, in bytes, that are indicators too: abuse is often the stem of a longer word.
WORD_STARTS = (4, 5, 6, 7)
COST = 1.0


@dataclass
class Link:
    """One category's model: weights of the features, then of the earlier probabilities, bias, sigmoid."""

    weights: np.ndarray
    bias: float
    a: float
    b: float


def _fit_link(rows: list, y: np.ndarray, width: int, folds: np.ndarray) -> tuple[Link, np.ndarray]:
    """The category's model and its out-of-fold probabilities. Rows of unknown label (y = 0) train no
    model; their probabilities come from the model of all others."""
    known = np.flatnonzero(y != 0)
    if len(known) < len(y):
        link, inside = _fit_link([rows[i] for i in known], y[known], width, folds[known])
        w = np.append(link.weights, link.bias)
        outside = sigmoid(link.a * margins(rows, w) + link.b) if len(rows) else np.zeros(0)
        outside[known] = inside
        return link, outside
    share = (float((y > 0).sum()) + 1) / (len(y) + 2)
    constant = Link(np.zeros(width), 0.0, 1.0, float(np.log(share / (1 - share))))
    if min((y > 0).sum(), (y < 0).sum()) < 2 * FOLDS:
        return constant, np.full(len(y), share)
    cost = COST * np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))

    def weights(at: np.ndarray) -> np.ndarray:
        return dual_coordinate_descent([rows[i] for i in at], y[at], width, cost[at])

    outside = np.zeros(len(y))
    for fold in range(FOLDS):
        inside = np.flatnonzero(folds == fold)
        if len(inside):
            outside[inside] = margins([rows[i] for i in inside], weights(np.flatnonzero(folds != fold)))
    a, b = calibrate(outside, y)
    w = weights(np.arange(len(y)))
    return Link(w[:-1], float(w[-1]), a, b), sigmoid(a * outside + b)


@dataclass
class ChainModel:
    features: list[bytes]
    categories: list[str]
    links: list[Link]


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], most_rows: int = MOST_ROWS) -> ChainModel:
    """``labels``: doc_id and a 0/1 column per category, in the order of the chain."""
    rows = materialize(training_rows(docs, labels, categories, most_rows), "chain-sample")
    first = rows.agg(F.count("*").alias("total"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in categories]).first()
    sizes = first.asDict()
    chosen = choose_features(class_counts(rows, categories, WORD_STARTS), categories, sizes, LEAST_ROWS, LEAST_Z, MOST_FEATURES) if sizes["total"] else []
    features = [bytes(r["feature"]) for r in chosen]
    sample = sparse_rows(rows, categories, features, WORD_STARTS)
    folds = np.arange(len(sample)) % FOLDS
    vectors = []
    for r in sample:
        ids = np.frombuffer(r["ids"], np.int32)
        vectors.append((ids, np.ones(len(ids))))
    links = []
    for j, category in enumerate(categories):
        y = np.array([0.0 if r[category] is None else 1.0 if r[category] else -1.0 for r in sample])
        link, outside = _fit_link(vectors, y, len(features) + j, folds)
        links.append(link)
        extra = np.array([len(features) + j], np.int32)
        vectors = [(np.append(ids, extra), np.append(values, p)) for (ids, values), p in zip(vectors, outside)]
    return ChainModel(features, categories, links)


def score(docs: DataFrame, model: ChainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and a probability column per category."""
    spark = docs.sparkSession
    small_batches(spark)
    n = len(model.features)
    per_feature = np.stack([link.weights[:n] for link in model.links], 1)
    chain = [(link.weights[n:], link.bias, link.a, link.b) for link in model.links]
    tables = spark.sparkContext.broadcast(({f: i for i, f in enumerate(model.features)}, per_feature, chain))  # bounded by MOST_FEATURES
    names, starts = ["doc_id", *model.categories], WORD_STARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weights, links = tables.value
        for batch in batches:
            out: list[list[float]] = [[] for _ in links]
            for text in batch.column(1).to_pylist():
                ids = [place[f] for f in indicators(text or "", starts) if f in place]
                base = weights[ids].sum(0)
                earlier: list[float] = []
                for j, (w, bias, a, b) in enumerate(links):
                    margin = base[j] + bias + sum(x * p for x, p in zip(w, earlier))
                    earlier.append(float(sigmoid(a * margin + b)))
                for column, p in zip(out, earlier):
                    column.append(p)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.float64()) for c in out]], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"`{c}` double" for c in model.categories)
    return rows.mapInArrow(run, schema)


#: The chain of the registered query: toxic running text, toxic junk, and at its end toxic at all, whose
#: link reads the probabilities of the two before it.
CATEGORIES = ["toxic_prose", "toxic_junk", "toxic"]


def categories(labels: DataFrame) -> DataFrame:
    """The chain's categories from the labels: toxic, and whether a toxic text is otherwise good. Without
    a quality label only a text that is not toxic has the first two."""
    toxic, good = F.col("toxic"), F.col("quality")
    clean = F.when(toxic == 0, 0)
    return labels.select("doc_id", F.coalesce(clean, toxic * good).alias("toxic_prose"), F.coalesce(clean, toxic * (1 - good)).alias("toxic_junk"), toxic)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (the last link's probability, of toxic), predicted, and the earlier
    categories' probabilities of every document."""
    scored = score(docs, fit(docs, categories(labels), CATEGORIES))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxic").alias("score"),
        (F.col("toxic") >= 0.5).cast("int").alias("predicted"),
        F.col("toxic_prose").alias("p_toxic_prose"),
        F.col("toxic_junk").alias("p_toxic_junk"),
    )
