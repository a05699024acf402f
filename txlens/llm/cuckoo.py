"""Exact duplicates through cuckoo-filter shards over live digests.

Two texts are equal when identical after white space (space, tab to carriage return) is deleted.
Every text becomes the SHA-256 of that form. A :class:`CuckooIndex` holds the live digests of one
shard: short tags in two candidate buckets answer most lookups, a tag hit is verified against the
full digest stored for that slot, and a table too full to place a tag is doubled and refilled from
the stored digests. It is used twice: on the map side over each input split, so that a text copied
into a third of all rows reaches the shuffle once per split, then over shards of the digest space.

Edge cases: a null text counts as empty; empty texts equal each other. Ties (same length) go to the
smaller id, null ids last; of fully repeated rows exactly one is kept. An empty table gives an empty
result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, small_batches, text_buffers, unused

WHITE = b" \t\n\x0b\x0c\r"
#: Live digests a map-side index holds before it hands its groups on and starts anew (the shards
#: merge what is handed on, so the result does not depend on it).
MAP_SIDE_LIVE = 500_000
#: Digests aimed at in a shard (about 100 bytes each in a Python worker).
SHARD_ROWS = 500_000


class CuckooIndex:
    """Cuckoo filter of 16-bit tags, four slots a bucket, with the stored digest of every slot.

    ``find`` and ``insert`` return the entry number of a digest, ``delete`` frees it. Entry numbers
    of deleted digests are used again.
    """

    SLOTS = 4
    KICKS = 256

    def __init__(self, buckets: int = 256):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.digests: list[bytes | None] = []
        self.free: list[int] = []
        self._clear(buckets)

    def __len__(self) -> int:
        return len(self.digests) - len(self.free)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags = array("H", bytes(2 * self.SLOTS * buckets))  # 0: free slot
        self.entries = array("q", bytes(8 * self.SLOTS * buckets))

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return (bucket ^ (tag * 0x5BD1E995)) & self.mask

    def _slot(self, digest: bytes) -> int:
        tag, a, b = self._place(digest)
        tags, entries, digests = self.tags, self.entries, self.digests
        for bucket in (a, b):
            for s in range(4 * bucket, 4 * bucket + 4):
                if tags[s] == tag and digests[entries[s]] == digest:
                    return s
        return -1

    def find(self, digest: bytes) -> int:
        s = self._slot(digest)
        return -1 if s < 0 else self.entries[s]

    def insert(self, digest: bytes) -> tuple[int, bool]:
        """Entry number, and whether the digest is new."""
        found = self.find(digest)
        if found >= 0:
            return found, False
        if self.free:
            entry = self.free.pop()
            self.digests[entry] = digest
        else:
            entry = len(self.digests)
            self.digests.append(digest)
        if not self._put(entry):
            self._grow()
        return entry, True

    def delete(self, digest: bytes) -> int:
        """Entry number that the digest had, or -1."""
        s = self._slot(digest)
        if s < 0:
            return -1
        entry = self.entries[s]
        self.tags[s] = 0
        self.digests[entry] = None
        self.free.append(entry)
        return entry

    def _put(self, entry: int) -> bool:
        tag, bucket, other = self._place(self.digests[entry])
        for choice in (bucket, other):
            for s in range(4 * choice, 4 * choice + 4):
                if not self.tags[s]:
                    self.tags[s], self.entries[s] = tag, entry
                    return True
        bucket = other
        for kick in range(self.KICKS):
            s = 4 * bucket + (kick + tag) % 4
            self.tags[s], tag = tag, self.tags[s]
            self.entries[s], entry = entry, self.entries[s]
            bucket = self._other(bucket, tag)
            for s in range(4 * bucket, 4 * bucket + 4):
                if not self.tags[s]:
                    self.tags[s], self.entries[s] = tag, entry
                    return True
        return False

    def _grow(self) -> None:
        """Doubled until every stored digest finds a place."""
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._put(e) for e, d in enumerate(self.digests) if d is not None):
                return


class _Groups:
    """Groups of equal digests: size and the row to keep, kept by entry number of a CuckooIndex."""

    def __init__(self):
        self.index = CuckooIndex()
        self.size: list[int] = []
        self.best: list[tuple] = []

    def add(self, digest: bytes, size: int, best: tuple) -> None:
        entry, new = self.index.insert(digest)
        if entry == len(self.size):
            self.size.append(size)
            self.best.append(best)
        elif new:
            self.size[entry], self.best[entry] = size, best
        else:
            self.size[entry] += size
            if best < self.best[entry]:
                self.best[entry] = best

    def remove(self, digest: bytes, size: int) -> None:
        entry = self.index.find(digest)
        if entry >= 0:
            self.size[entry] -= size
            if self.size[entry] <= 0:
                self.index.delete(digest)

    def batches(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        live = [e for e, d in enumerate(self.index.digests) if d is not None]
        for i in range(0, len(live), 10_000):
            part = live[i : i + 10_000]
            best = [self.best[e] for e in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([self.index.digests[e] for e in part], pa.binary()),
                    pa.array([self.size[e] for e in part], pa.int64()),
                    pa.array([-b[0] for b in best], pa.int64()),
                    pa.array([None if b[1] else b[2] for b in best], id_type),
                    pa.array([b[3] for b in best], pa.int64()),
                ],
                ["digest", "group_size", "chars", "keep_id", "keep_row"],
            )


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = text_buffers(b.column(1))
        raw, o = data.tobytes(), offsets.tolist()
        digests = [hashlib.sha256(raw[i:j].translate(None, WHITE)).digest() for i, j in zip(o, o[1:])]
        chars = pc.utf8_length(pc.fill_null(b.column(1), "")).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), chars], ["doc_id", "digest", "chars"])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, chars, row) of every row; ``row`` is a number of its own for each row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_digest_batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest binary, chars bigint")
    return materialize(out.withColumn("row", F.monotonically_increasing_id()), "cuckoo-digests")


def _local_groups(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups()
        for b in batches:
            ids, keys, chars, rows = (c.to_pylist() for c in b.columns)
            for i, d, n, r in zip(ids, keys, chars, rows):
                groups.add(d, 1, (-n, i is None, 0 if i is None else i, r))
            if len(groups.index) >= MAP_SIDE_LIVE:
                yield from groups.batches(id_type)
                groups = _Groups()
        yield from groups.batches(id_type)

    return run


def _merged_groups(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, gone = _Groups(), []
        for b in batches:
            for d, size, n, i, r in zip(*(c.to_pylist() for c in b.columns)):
                if size > 0:
                    groups.add(d, size, (-n, i is None, 0 if i is None else i, r))
                else:
                    gone.append((d, -size))
        for d, size in gone:
            groups.remove(d, size)
        yield from groups.batches(id_type)

    return run


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _sharded(partial: DataFrame, rows: int) -> DataFrame:
    shards = max(int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // SHARD_ROWS))
    return partial.repartition(shards, "digest").mapInArrow(_merged_groups(_arrow_type(partial, "keep_id")), partial.schema)


def build_index(rows: DataFrame) -> DataFrame:
    """Index of live digests of :func:`digests` rows: (digest, group_size, chars, keep_id, keep_row)."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    local = rows.select("doc_id", "digest", "chars", "row").mapInArrow(
        _local_groups(_arrow_type(rows, "doc_id")),
        f"digest binary, group_size bigint, chars bigint, keep_id {id_type}, keep_row bigint",
    )
    return _sharded(local, rows.count())


def update_index(index: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Index after rows (as :func:`digests` gives them) come or go.

    A digest leaves the index when as many of its rows were deleted as it had; while copies live
    on, the row named as kept stays the one chosen at insertion. Deleting what is absent does nothing.
    """
    id_type = index.schema["keep_id"].dataType.simpleString()
    parts = index
    for rows, sign in ((inserted, 1), (deleted, -1)):
        if rows is not None:
            local = rows.select("doc_id", "digest", "chars", "row").mapInArrow(
                _local_groups(_arrow_type(rows, "doc_id")),
                f"digest binary, group_size bigint, chars bigint, keep_id {id_type}, keep_row bigint",
            )
            parts = parts.unionByName(local.withColumn("group_size", F.col("group_size") * sign))
    return _sharded(parts, index.count())


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    Single texts need no partner: only groups of two or more are joined back, and a hot digest is
    one row on that side, so the adaptive skew split can cut its rows of documents.
    """
    rows = digests(docs, id_col, text_col)
    groups = build_index(rows).where("group_size > 1").select("digest", "group_size", "keep_id", "keep_row")
    joined = rows.join(groups, "digest", "left")
    single = F.col("keep_row").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "digest",
    )


def native_digest(text_col: str) -> Column:
    """The same digest as a column expression (for few rows)."""
    return F.unhex(F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), WHITE.decode(), ""), 256))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_duplicates` drops, all columns unchanged.

    Rows are found again by id. An id that occurs in several rows, some kept and some dropped, is
    settled by its digest as well, one row for each.
    """
    key, mark, kept_mark, place = (unused(docs, n) for n in ("_id", "_digest", "_kept", "_place"))
    found = materialize(exact_duplicates(docs, id_col, text_col), "cuckoo-decisions")
    dropped = found.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
    kept = found.where("kept").select(F.col("doc_id").alias(key), F.col("digest").alias(kept_mark))
    gone = dropped.withColumnRenamed(key, "_gone")
    both = materialize(kept.join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_semi"), "cuckoo-repeated")
    rest = docs.join(broadcast_if_small(dropped), F.col(id_col).eqNullSafe(F.col(key)), "left_anti")
    if both.isEmpty():
        return rest
    best = Window.partitionBy(id_col, mark).orderBy(F.length(text_col).desc_nulls_last())
    again = (
        docs.withColumn(mark, native_digest(text_col))
        .join(both, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(mark) == F.col(kept_mark)), "left_semi")
        .withColumn(place, F.row_number().over(best))
        .where(F.col(place) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
    return rest.unionByName(again)
