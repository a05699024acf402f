"""Shared helpers: tables, written intermediates, checked broadcasts, batches and word hashing."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, session_conf

#: Largest side that is broadcast, in rows of a few fixed-width columns (about 16 MB).
BROADCAST_ROWS = 500_000
#: Narrow rows in a file of a table of known size.
FILE_ROWS = 200_000
#: Rows in an Arrow batch. Texts average a few kB, so a batch stays at a few MB.
BATCH_ROWS = 256
#: Bytes of text handled at once by the flat numpy passes (a longer single text is handled alone). They take about
#: 60 bytes for each, in every Python worker, and a worker keeps what it once took.
CHUNK_BYTES = 256 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives executor loss. What the step shuffled
    is not needed once its rows are written, so Spark removes it then and not when the driver next collects garbage.

    With a known bound on its ``rows`` (narrow ones) the table is written in as few files as that
    needs, so that steps over small tables stay small in tasks and files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if rows is not None:
        df = df.coalesce(-(-rows // FILE_ROWS) or 1)
    with session_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of few rows, for tables that hold whole texts (memory grows with a batch)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores before it, so that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def broadcast_if_small(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when the (counted) number of narrow rows is within the bound, else none."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= bound else df


@contextmanager
def runtime_filter(spark: SparkSession, keys: int) -> Iterator[None]:
    """Lets Spark put a Bloom filter of one join side (``keys`` of them; the filter is 8 MB at most)
    before the shuffle of the other, whatever their sizes, for the jobs run inside."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    bits = min(int(spark.conf.get(f"{prefix}maxNumBits")), max(1 << 20, 10 * keys))
    items = min(int(spark.conf.get(f"{prefix}maxNumItems")), max(1, keys))
    wanted = {"applicationSideScanSizeThreshold": "0", "creationSideThreshold": "4g", "expectedNumItems": str(items), "numBits": str(bits)}
    old = {k: spark.conf.get(prefix + k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(prefix + k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(prefix + k, v)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = column.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together (or one text)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


# ---- hashing of words -------------------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix): spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse; those for a chunk are kept, not those for a longer text."""
    powers = _POWERS
    if not powers or len(powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        powers = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, _BASE_INVERSE)]
        if n <= CHUNK_BYTES + 1:
            _POWERS[:] = powers
    return powers[0][:n], powers[1][:n]


def _byte_codes(lower: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of texts laid end to end, and for
    each text (n+1) the index of its first word. Positions count from ``offsets[0]``."""
    first = int(offsets[0])
    inside = ~_SPACE[data[first : int(offsets[-1])]]
    cuts = offsets - first
    n = len(inside)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = np.zeros(n, bool)
    ends[:-1] = inside[:-1] & ~inside[1:]
    if n:
        ends[-1] = inside[-1]
    at = cuts[(cuts > 0) & (cuts < n)]
    starts[at] |= inside[at]
    ends[at - 1] |= inside[at - 1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, cuts)


def span_hashes(view: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of the bytes of every span of ``view`` (A-Z lower-cased if asked)."""
    up, down = _powers(len(view) + 1)
    total = np.zeros(len(view) + 1, np.uint64)
    np.cumsum(_byte_codes(lower)[view] * up[: len(view)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (A-Z lower-cased if asked) and first word index of each text."""
    starts, ends, firsts = word_bounds(data, offsets)
    return span_hashes(data[int(offsets[0]) : int(offsets[-1])], starts, ends, lower), firsts


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes of its k-word shingles. A text of fewer words
    has one shingle, its whole sequence; a text without words has none."""
    n = len(words)
    if n >= k:
        rolled = words[: n - k + 1].copy()
        for j in range(1, k):
            rolled = mix(rolled * np.uint64(_BASE) + words[j : n - k + 1 + j])
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif b > a:
            one = words[a : a + 1].copy()
            for j in range(a + 1, b):
                one = mix(one * np.uint64(_BASE) + words[j : j + 1])
            yield one
        else:
            yield words[:0]


def text_shingles(column, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingle hashes of every text of an Arrow string column."""
    data, offsets = text_buffers(column)
    for i, j in chunks(offsets):
        words, firsts = word_hashes(data, offsets[i : j + 1])
        yield from shingle_hashes(words, firsts, k)
