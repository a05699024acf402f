"""Ball-tree search, the registered queries and the pipeline against brute force."""

import hashlib
import importlib.util
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txlens.llm import balltree, common, nbsvm, registry

SF = "/root/testdata/sf0.001"
needs_tokenizer = pytest.mark.skipif(importlib.util.find_spec("public_tokenizers") is None, reason="no tokenizer files")


def brute_top(ids, vectors, chosen, k):
    out = set()
    for i in np.flatnonzero(chosen):
        score = vectors @ vectors[i]
        order = np.lexsort((ids, -score))
        order = order[ids[order] != ids[i]][:k]
        out |= {(int(ids[i]), n + 1, int(ids[j]), int(score[j])) for n, j in enumerate(order)}
    return out


@pytest.mark.parametrize("copies", [0, 150])
def test_top_k_equals_brute_force(spark, monkeypatch, copies):
    monkeypatch.setattr(balltree, "SHARD_VECTORS", 90)
    monkeypatch.setattr(balltree, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(balltree, "LEAF", 8)
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 6)) * 0.2
    x[:copies] = x[0]  # a hot vector: ties beyond k in every shard
    ids = r.permutation(1000)[:400] - 100
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    found = balltree.top_k(df.selectExpr("*", "1 AS id", "2 AS v"), F.col("id") % 10 == 0, k=12).collect()
    want = brute_top(ids, np.floor(64 * x), ids % 10 == 0, 12)
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == want


def test_top_k_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (21, [0.5, 0.5]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = balltree.top_k(df, F.col("id") % 20 == 0)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()) == [
        (0, 1, 20, 64 * 64 + 128 * 128), (0, 2, 21, 64 * 32 + 128 * 32), (20, 1, 0, 64 * 64 + 128 * 128), (20, 2, 21, 64 * 32 + 128 * 32),
    ]
    assert balltree.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_repeated_query_ids_and_a_hot_id_over_shards(spark, monkeypatch):
    """Every row of an id is a query and a candidate, as in the SQL; an id of a third of all rows is many shards and blocks."""
    monkeypatch.setattr(balltree, "SHARD_VECTORS", 60)
    monkeypatch.setattr(balltree, "BLOCK_QUERIES", 11)
    monkeypatch.setattr(balltree, "LEAF", 8)
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 4)) * 8
    rows = [(int(i % 130), [float(c) for c in centres[i % 6] + r.normal(size=4)]) for i in range(400)]
    rows += [(20, [1.0, 0.5, -1.0, 2.0])] * 150 + [(20, [float(c) for c in r.normal(size=4)]) for _ in range(50)]
    rows += [(40, [1.0, 2.0]), (41, [3.0, 1.0]), (60, []), (61, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows[:-2])
    want = con.sql(registry.ORACLE_SQL["op10_ball_tree_topk"]).fetchall()
    found = balltree.top_k(df.where("size(embedding) > 0"), F.col("id") % 20 == 0).collect()
    assert sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in found) == sorted(want)
    assert balltree.top_k(df.where("size(embedding) = 0"), F.col("id") % 20 == 0).collect()[0]["score"] == 0
    alone = balltree.top_k(df.where("vec_id = 20"), F.col("id") % 20 == 0)
    assert alone.count() == 0


def test_far_shards_are_not_asked(spark, monkeypatch):
    """With vectors in clusters, a query is sent to few of the shards, and the answer is whole."""
    monkeypatch.setattr(balltree, "SHARD_VECTORS", 50)
    monkeypatch.setattr(balltree, "LEAF", 8)
    seen = {}
    keep = balltree.materialize
    monkeypatch.setattr(balltree, "materialize", lambda df, name, *a: seen.setdefault(name, keep(df, name, *a)))
    r = np.random.default_rng(7)
    centres = r.normal(size=(12, 8)) * 20
    x = centres[np.arange(600) % 12] + r.normal(size=(600, 8)) * 0.2
    ids = np.arange(600)
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    found = balltree.top_k(df, F.col("id") % 10 == 0, k=5).collect()
    assert {(q["query_id"], q["rank"], q["vec_id"], q["score"]) for q in found} == brute_top(ids, np.floor(64 * x), ids % 10 == 0, 5)
    shards = seen["ball-trees"].count()
    asked = seen["ball-asked"].select(F.sum(F.size("q"))).first()[0] or 0
    assert shards > 6 and asked < 0.5 * 60 * (shards - 1)


def test_tree_bounds_hold():
    r = np.random.default_rng(2)
    v = np.floor(r.normal(size=(500, 5)) * 30)
    tree = balltree.BallTree(v, np.arange(500), leaf=10)
    packed = balltree.BallTree.unpack(5, tree.pack())
    q = r.normal(size=5) * 10
    for i in range(len(packed.first)):
        inside = packed.vectors[packed.first[i] : packed.last[i]]
        assert (inside @ q).max() <= packed.centres[i] @ q + np.linalg.norm(q) * packed.radii[i] + 1e-6


def views(sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    df = registry.QUERIES[name](spark, SF)
    want = views(SF).sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    columns = sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(
        map(str, want.project(", ".join(columns)).fetchall())
    )


def test_a_query_for_each_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run


def stripped(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


@needs_tokenizer
def test_pipeline_equals_brute_force(spark):
    """Stage by stage on the same fitted quality model, everything else redone in plain Python."""
    from tokenizers import Tokenizer

    docs = common.table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "encode"]
    out = corpus_pipeline.run(spark, SF).collect()

    scored = nbsvm.quality(docs, common.table(spark, SF, "labels")).collect()
    good = {r["doc_id"] for r in scored if r["predicted"] == 1}
    rows = {r["doc_id"]: r for r in docs.collect() if r["doc_id"] in good}
    groups = {}
    for i, r in rows.items():
        groups.setdefault(stripped(r["text"]), []).append((-len(r["text"] or ""), i))
    rows = {i: rows[i] for _, i in (min(g) for g in groups.values())}
    sets = {i: shingles(r["text"]) for i, r in rows.items()}
    label = {i: i for i in rows}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in rows:
        for j in rows:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    rows = {i: r for i, r in rows.items() if find(i) == i}

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, r["text"], r["source"]) for i, r in rows.items()])
    want = []
    library = Tokenizer.from_file(registry.tokenizer_path())
    for i, size, taken in con.sql(f"SELECT doc_id, size, taken FROM ({registry.ORACLE_SQL['op1_pareto_mix']})").fetchall():
        ids = library.encode(rows[i]["text"] or "", add_special_tokens=False).ids
        row = (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((rows[i]["text"] or "").encode()).hexdigest())
        want += [row] * (taken // size if size else 0)
    assert sorted(map(tuple, out)) == sorted(want)


def test_stages_keep_the_columns_of_documents(spark):
    docs = common.table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_nothing_else_imports_the_package():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "txlens")):
        if "llm" in os.path.relpath(folder, root).split(os.sep):
            continue
        for n in names:
            if n.endswith(".py"):
                text = open(os.path.join(folder, n), encoding="utf-8").read()
                assert not re.search(r"(from|import)\s+\S*llm", text), n
