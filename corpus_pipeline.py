"""A training-data pipeline over ``documents``: quality, exact and near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the
shared scratch folder and read again as the next stage's ``docs``, so a lost executor never repeats
an earlier stage. Every stage works on all rows that its predecessor kept; all but the last return
the columns of ``documents``.

Edge cases: a null text counts as empty; it stays if the quality model keeps empty texts, all empty texts are
one group of exact duplicates, the one that stays links with nothing, has no words and so is never taken by
the mix. Null and repeated ids are settled row by row: by digest in ``exact_dedup`` and ``near_dedup``, by source and
size in ``mix``. Of fully repeated rows one stays. Ties go to the smaller id, null ids last. Sources may be
null. Columns beside those of ``documents``, whatever their names, pass through all stages but the last. An
empty table, or one of which a stage keeps nothing, gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txlens.llm import cuckoo, jaccard, mixing, nbsvm, registry
from txlens.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model (5) rejects go."""
    return nbsvm.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the longest row stays, then the smallest id (4)."""
    return cuckoo.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 on five-word shingles (7):
    the one with the smallest id."""
    return jaccard.drop_near_duplicates(docs, k=5, num=80, den=100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the weights 3, 1, 2 (1): a document comes as often as the mix takes it, at most
    twice; those it does not take go."""
    return mixing.repeat_documents(docs, mixing.mix_documents(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-pair ids (9): token count and digests of ids and decoded text, for each row."""
    return registry.bpe_digests(docs, registry.tokenizer_path())


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: SQL cannot express the trained classifier; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
