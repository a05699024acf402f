"""Quality and toxicity models: held-out accuracy, dual coordinate descent, edge cases."""

import numpy as np
import pytest

from txlens.llm import chain, linear, nbsvm, ngrams, registry

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def data(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out_rows(result, labels, column):
    rows = result.join(labels, "doc_id").where("held_out").select("score", "predicted", column).collect()
    return np.array([r["score"] for r in rows]), np.array([r["predicted"] for r in rows]), np.array([r[column] for r in rows])


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(y))
    rank[order] = np.arange(len(y))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_quality_is_learnt(spark, data):
    docs, labels = data
    result = registry.op5_quality_nbsvm(spark, SF)
    assert result.columns == ["doc_id", "held_out", "score", "predicted"]
    assert result.count() == docs.count()
    score, predicted, y = held_out_rows(result, labels, "quality")
    assert (predicted == y).mean() > 0.97 and auc(score, y) > 0.98
    assert ((score >= 0) & (score <= 1)).all() and (predicted == (score >= 0.5)).all()


def test_toxicity_is_learnt(spark, data):
    docs, labels = data
    result = registry.op6_toxicity_chain(spark, SF)
    assert result.count() == docs.count()
    score, predicted, y = held_out_rows(result, labels, "toxic")
    assert (predicted == y).mean() > 0.9 and auc(score, y) > 0.9


def test_held_out_labels_are_not_read(spark, data):
    docs, labels = data
    from pyspark.sql import functions as F

    spoilt = labels.withColumn("quality", F.when(ngrams.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = nbsvm.fit(docs, labels), nbsvm.fit(docs, spoilt)
    assert one.features == two.features and (one.weight == two.weight).all() and (one.a, one.b) == (two.a, two.b)


def test_held_out_is_crc32_of_the_id_as_text(spark):
    import zlib

    from pyspark.sql import functions as F

    rows = spark.range(-5, 50).select("id", ngrams.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


def test_few_labels_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "good text here"), (2, None), (3, ""), (None, "x"), (1, "good text here"), (5, "w " * 50_000)], "doc_id bigint, text string")
    docs = docs.selectExpr("*", "'a' AS score", "1 AS held_out", "2 AS good", "3 AS toxic")
    for rows in ([], [(1, 1, 1)], [(1, None, None), (None, 1, 0)], [(1, 1, 0), (2, 0, 1), (3, 0, 1), (5, 1, 1), (5, 1, 1)]):
        labels = spark.createDataFrame(rows, LABELS).selectExpr("*", "'t' AS text")
        good = nbsvm.quality(docs, labels).collect()
        bad = chain.toxicity(docs, labels).collect()
        assert len(good) == len(bad) == 6
        assert all(0 <= r["score"] <= 1 for r in good + bad)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert nbsvm.quality(empty, labels).count() == 0 and chain.toxicity(empty, labels).count() == 0
    kept = nbsvm.keep_good(docs.withColumnRenamed("score", "_quality"), labels)
    assert kept.columns == ["doc_id", "text", "_quality", "held_out", "good", "toxic"] and kept.count() <= 6


def test_indicators():
    found = ngrams.indicators("The the CAT!! sat-9", (2,))
    assert {b"the", b"cat", b"sat", b"the =", b"cat sat", b"#Aa", b"#A!", b"#a-0", b"#A!#a-0", b"^ca"} <= found
    assert ngrams.indicators("") == set() and ngrams.indicators(" \n") == set()


def test_dual_coordinate_descent_reaches_the_optimum():
    r = np.random.default_rng(1)
    x = r.normal(size=(60, 4))
    y = np.where(x @ np.array([1.0, -2, 0.5, 0]) + 0.3 + 0.5 * r.normal(size=60) > 0, 1.0, -1.0)
    rows = [(np.arange(4), v) for v in x]
    cost = np.full(60, 0.7)
    w = linear.dual_coordinate_descent(rows, y, 4, cost, epochs=2000)

    def loss(w):
        return 0.5 * w @ w + 0.7 * np.maximum(0, 1 - y * (x @ w[:4] + w[4])).sum()

    best = min(loss(w + d) for d in r.normal(size=(3000, 5)) * r.choice([1e-4, 1e-3, 1e-2, 0.1], size=(3000, 1)))
    assert loss(w) <= best + 1e-2 * abs(best)


def test_calibration_follows_the_shares():
    margin = np.concatenate([np.full(100, -1.0), np.full(100, 1.0)])
    y = np.concatenate([np.where(np.arange(100) < 20, 1.0, -1.0), np.where(np.arange(100) < 90, 1.0, -1.0)])
    a, b = linear.calibrate(margin, y)
    assert abs(linear.sigmoid(b - a) - 0.2) < 0.02 and abs(linear.sigmoid(a + b) - 0.9) < 0.02


def test_chain_feeds_earlier_probabilities_out_of_fold():
    """The second category equals the first; its own model leans on the first one's probability."""
    r = np.random.default_rng(2)
    rows = [(np.sort(r.choice(50, 5, replace=False)).astype(np.int32), np.ones(5)) for _ in range(400)]
    y = np.array([1.0 if 3 in ids or 7 in ids else -1.0 for ids, _ in rows])
    folds = np.arange(400) % chain.FOLDS
    first, outside = chain._fit_link(rows, y, 50, folds)
    assert ((outside > 0.5) == (y > 0)).mean() > 0.95
    extra = [(np.append(ids, 50).astype(np.int32), np.append(v, p)) for (ids, v), p in zip(rows, outside)]
    second, _ = chain._fit_link(extra, y, 51, folds)
    assert len(second.weights) == 51 and second.weights[50] == second.weights.max() > 0


def test_the_sample_is_bounded_and_has_one_row_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i % 3}") for i in range(3000)] + [(i, f"other {i}") for i in range(2, 60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, None if i % 3 else 1) for i in range(60)] * 2 + [(99, None, None)], LABELS)
    rows = ngrams.training_rows(docs, labels, ["quality", "toxic"], 10).collect()
    assert len(rows) <= 10 and len({r["doc_id"] for r in rows}) == len(rows)
    rows = ngrams.training_rows(docs, labels, ["quality", "toxic"], 1000).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) > 10 and any(r["toxic"] is None for r in rows)
    assert all(r["quality"] == r["doc_id"] % 2 for r in rows) and {r["text"] for r in rows if r["doc_id"] == 1} <= {"text 0", "text 1", "text 2"}


def test_the_score_comes_through_the_chain(spark):
    """Without the earlier links' probabilities the scores are others: the last link leans on them."""
    r = np.random.default_rng(5)
    words, rows, marks = [f"word{k}" for k in range(80)], [], []
    for i in range(900):
        text = list(r.choice(words, 12))
        toxic, good = r.random() < 0.3, r.random() < 0.6
        if toxic and r.random() < 0.9:  # abuse of many words, other ones in junk
            text += list(r.choice([f"{'vile' if good else 'trash'}{k}" for k in range(8)], 2))
        rows.append((i, " ".join(text)))
        marks.append((i, int(good), int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(marks, LABELS)
    model = chain.fit(docs, chain.categories(labels), chain.CATEGORIES)
    assert model.categories[-1] == "toxic"
    last, n = model.links[-1], len(model.features)
    assert last.weights[n:].max() > 0.1
    cut = chain.ChainModel(model.features, model.categories, [*model.links[:-1], chain.Link(np.append(last.weights[:n], [0.0, 0.0]), last.bias, last.a, last.b)])
    one = {r["doc_id"]: r["toxic"] for r in chain.score(docs, model).collect()}
    two = {r["doc_id"]: r["toxic"] for r in chain.score(docs, cut).collect()}
    assert len([i for i in one if abs(one[i] - two[i]) > 0.01]) > 0.1 * len(one)
    outside = [(i, t) for i, _, t in marks if one[i] is not None]
    assert np.mean([(one[i] >= 0.5) == t for i, t in outside]) > 0.9


def test_rows_of_unknown_category_train_the_others():
    r = np.random.default_rng(4)
    rows = [(np.sort(r.choice(30, 5, replace=False)).astype(np.int32), np.ones(5)) for _ in range(300)]
    y = np.array([1.0 if 3 in ids else -1.0 for ids, _ in rows])
    hidden = np.where(np.arange(300) % 4 == 0, 0.0, y)
    folds = np.arange(300) % chain.FOLDS
    link, outside = chain._fit_link(rows, hidden, 30, folds)
    assert len(outside) == 300 and ((outside > 0.5) == (y > 0)).mean() > 0.95
    link, outside = chain._fit_link(rows, np.zeros(300), 30, folds)
    assert len(outside) == 300 and (0 <= outside).all() and (outside <= 1).all()
