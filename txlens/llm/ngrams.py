"""N-gram indicators of a text, their class counts over a bounded training sample, and the sample as
sparse rows.

A text is seen twice: as lower-cased words of letters (a word that repeats the one before becomes
``=``) and as word shapes (letter case, digits and marks, runs collapsed: ``Don't!!`` is ``Aa'a!``).
Indicators are the distinct 1- and 2-grams of both, and on demand the beginnings of the words. Byte tables do the mapping, so cost is linear in
the text and no text is cut.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_SHAPES = bytes(
    97 if b >= 128 or 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 32 if b in b" \t\n\x0b\x0c\r" else b
    for b in range(256)
)


def indicators(text: str, starts: tuple[int, ...] = ()) -> set[bytes]:
    """The distinct indicators; ``starts`` adds the beginnings of words of so many bytes (``^idio``)."""
    raw = text.encode()
    words = raw.translate(_LETTERS).split()
    seen = set(words)
    if starts:
        distinct = list(seen)
        for n in starts:
            seen.update({b"^" + w[:n] for w in distinct if len(w) >= n})
    marked = [b"=" if a == b else b for a, b in zip([b"", *words], words)]
    seen.update([a + b" " + b for a, b in zip(marked, marked[1:])])
    shape = np.frombuffer(raw.translate(_SHAPES), np.uint8)
    if len(shape):
        shape = shape[np.concatenate([[True], shape[1:] != shape[:-1]])]
    shapes = [b"#" + s for s in shape.tobytes().split()]
    seen.update(shapes)
    seen.update([a + b for a, b in set(zip(shapes, shapes[1:]))])
    return seen


def held_out(id_col: Column) -> Column:
    """Rows that no model learns from: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, columns: list[str], most: int, seed: int = 7) -> DataFrame:
    """(doc_id, text, *columns) of at most ``most`` labelled ids outside the held-out fold: those
    with the smallest hash of the id, one row each. Rows without any label are not used, a null beside
    other labels stays null; of repeated labels the largest counts, of the texts of a repeated id the one
    with the smallest digest."""
    chosen = (
        labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
        .dropna(how="all", subset=columns)
        .groupBy("doc_id")
        .agg(*[F.max(c).cast("int").alias(c) for c in columns])
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
        .limit(most)
    )
    texts = docs.select(F.col("doc_id"), F.col("text"))
    known = texts.join(F.broadcast(chosen), "doc_id")  # at most ``most`` ids
    first = F.min(F.struct(F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "text")).alias("first")
    one = known.groupBy("doc_id").agg(first, *[F.max(c).alias(c) for c in columns])
    return one.select("doc_id", F.col("first.text").alias("text"), *columns)


def class_counts(rows: DataFrame, columns: list[str], starts: tuple[int, ...] = ()) -> DataFrame:
    """(feature, total, *columns): in how many rows of the sample a feature occurs, and in how many
    of each column's positive rows. Counted per task first."""
    small_batches(rows.sparkSession)
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(n + 1)]
        for b in batches:
            marks = [b.column(1 + i).to_pylist() for i in range(n)]
            for k, text in enumerate(b.column(0).to_pylist()):
                found = indicators(text or "", starts)
                counts[0].update(found)
                for i in range(n):
                    if marks[i][k]:
                        counts[i + 1].update(found)
            if len(counts[0]) > 400_000:
                yield from _count_batches(counts)
                counts = [Counter() for _ in range(n + 1)]
        yield from _count_batches(counts)

    def _count_batches(counts: list[Counter]) -> Iterator[pa.RecordBatch]:
        keys = list(counts[0])
        for i in range(0, len(keys), 20_000):
            part = keys[i : i + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), *[pa.array([c[f] for f in part], pa.int64()) for c in counts]], ["feature", "total", *columns]
            )

    schema = "feature binary, total bigint, " + ", ".join(f"{c} bigint" for c in columns)
    partial = rows.select("text", *columns).mapInArrow(run, schema)
    return partial.groupBy("feature").agg(F.sum("total").alias("total"), *[F.sum(c).alias(c) for c in columns])


def choose_features(counts: DataFrame, columns: list[str], sizes: dict[str, int], least_rows: int, least_z: float, most: int) -> list:
    """Rows (feature, total, *columns) of the at most ``most`` features whose counts deviate most
    from independence of some column (largest z); ``sizes`` holds the rows of the sample (``total``)
    and the positive ones of each column."""
    z = F.lit(0.0)
    n = sizes["total"]
    for c in columns:
        share = sizes[c] / n if n else 0.0
        spread = F.sqrt(F.col("total") * (1 - F.col("total") / F.lit(float(n + 1))) * F.lit(max(share * (1 - share), 1e-9)))
        z = F.greatest(z, F.abs(F.col(c) - F.col("total") * F.lit(share)) / spread)
    ranked = counts.where(F.col("total") >= least_rows).withColumn("z", z).where(F.col("z") >= least_z)
    return ranked.orderBy(F.desc("z"), "feature").limit(most).drop("z").collect()


def sparse_rows(rows: DataFrame, columns: list[str], features: list[bytes], starts: tuple[int, ...] = ()) -> list:
    """(doc_id, *columns, ids of its features) of the bounded sample, in order of doc_id."""
    small_batches(rows.sparkSession)
    place = rows.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(features)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = place.value
        for b in batches:
            ids = [np.array(sorted(of[f] for f in indicators(t or "", starts) if f in of), np.int32).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], pa.array(ids, pa.binary())], ["doc_id", *columns, "ids"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} int" for c in columns) + ", ids binary"
    return sorted(rows.select("doc_id", "text", *columns).mapInArrow(run, schema).collect(), key=lambda r: (r["doc_id"], r["ids"]))
