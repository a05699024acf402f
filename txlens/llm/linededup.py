"""Repeated lines through two Bloom filters: once seen and twice seen.

Every text is split at ``\\n``. A line's key is the line without white space (space, tab to carriage
return) at both ends, A-Z lower-cased. A key of at least ``min_chars`` code points that occurs in at
least ``min_docs`` documents is repeated: its lines stay in one document only, the one of largest id
(``keep="last"``) or smallest (``"first"``), and go from all others.

1. *Filters.* Each task marks the hashes of its keys in a pair of Bloom filters, "seen" and "seen
   twice", cut into segments of the hash space. Pairs are merged by
   ``seen = a | b, twice = a.twice | b.twice | (a & b)``, segment by segment, so no line leaves its
   task and a line copied into a third of all documents is two bits a task. The filters grow with the
   data (8 bits for each line that the bytes of text have room for); a merging task holds one segment.
   Only the twice-seen filter goes out to the tasks, folded to at most ``TWICE_BITS`` bits (32 MB). Beyond
   that it fills up and suspects more lines than needed; the result does not change.
2. *Confirmation.* Only lines that the twice-seen filter suspects are shuffled, as the SHA-256 of their
   key with their document's id: documents are counted exactly and the one that keeps the line is chosen.
3. *Rewriting.* Confirmed keys within ``TABLE_KEYS`` are sent to the tasks that cut the texts. Beyond
   that the suspects are joined with them (very frequent keys by a counted broadcast) and each document
   gets its own keys by a join on the id.

Edge cases: a null or empty text is one empty line. Documents are told by their id: rows with the
same id count once, and all of them keep the line where that id keeps it. A null id is one id, the
smallest (largest for ``"first"``): it keeps a line only where no other id holds it, which takes
``min_docs=1``. A line repeated inside the keeping document stays each time. Ties cannot arise.
Lines of one key may differ in case and outer white space; those that stay are left as they are. An
empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, _SPACE, chunks, materialize, mix, small_batches, span_hashes, text_buffers

#: Filter bits for each line that the bytes of text have room for.
BITS_PER_LINE = 8
#: Bits of a segment at most: what a merging task holds, a byte each, twice.
SEGMENT_BITS = 1 << 24
#: Bits of the twice-seen filter as it goes out to the tasks, at most.
TWICE_BITS = 1 << 28
#: Bit positions that a task gathers before it hands its filters on.
FLUSH = 2_000_000
#: Confirmed keys that are sent to the tasks, at most (40 bytes each).
TABLE_KEYS = BROADCAST_ROWS
#: Keys in more documents than this are joined by broadcast when the suspects are joined.
HOT_DOCS = 20_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SALT = np.uint64(0x632BE59BD9B4E019)


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the lines of texts laid end to end, and each text's first line (n+1)."""
    first, n = int(offsets[0]), len(offsets) - 1
    breaks = np.flatnonzero(data[first : int(offsets[-1])] == 10) + first
    firsts = np.searchsorted(breaks, offsets) + np.arange(n + 1)
    opens = np.zeros(len(breaks) + n, bool)
    opens[firsts[:-1]] = True
    starts, ends = np.empty(len(opens), np.int64), np.empty(len(opens), np.int64)
    starts[opens], starts[~opens] = offsets[:-1], breaks + 1
    closes = np.zeros(len(opens), bool)
    closes[firsts[1:] - 1] = True
    ends[closes], ends[~closes] = offsets[1:], breaks
    return starts, ends, firsts


def long_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_chars: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of lines, those whose key has ``min_chars`` code points: line number, byte start and end of the
    key, hash of the key. Lines come in groups of a few MB (or one line)."""
    if not len(starts):
        return
    for i, j in chunks(np.append(starts, ends[-1])):
        base = int(starts[i])
        view = data[base : int(ends[j - 1])]
        solid = np.flatnonzero(~_SPACE[view])
        a, b = np.searchsorted(solid, starts[i:j] - base), np.searchsorted(solid, ends[i:j] - base)
        full = np.flatnonzero(b > a)
        begin, end = solid[a[full]], solid[b[full] - 1] + 1
        points = np.zeros(len(view) + 1, np.int64)
        np.cumsum((view & 0xC0) != 0x80, out=points[1:])
        kept = points[end] - points[begin] >= min_chars
        full, begin, end = full[kept], begin[kept], end[kept]
        if len(full):
            yield full + i, begin + base, end + base, span_hashes(view, begin, end)


class Filters:
    """Geometry of the two filters: ``segments`` times ``bits`` (powers of two), folded to ``fold`` bits."""

    def __init__(self, lines: int):
        total = 1 << max(20, (BITS_PER_LINE * max(lines, 1) - 1).bit_length())
        self.segments = max(16, total // SEGMENT_BITS)
        self.bits = total // self.segments
        self.fold = min(total, TWICE_BITS) // self.segments

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment of each hash and its two places in there."""
        other = mix(hashes + _SALT)
        mask = np.uint64(self.bits - 1)
        return other >> np.uint64(65 - self.segments.bit_length()), hashes & mask, other & mask

    def marked(self, hashes: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """The pair of filters of some keys: per segment the places seen, and those seen twice."""
        segment, p, q = self.places(hashes)
        shift = np.uint64(self.bits.bit_length() - 1)
        places, counts = np.unique(np.concatenate([segment << shift | p, segment << shift | q]), return_counts=True)
        owner = (places >> shift).astype(np.int64)
        places = (places & np.uint64(self.bits - 1)).astype(np.uint32)
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        for i, j in zip(heads, np.append(heads[1:], len(owner))):
            yield int(owner[i]), places[i:j].tobytes(), places[i:j][counts[i:j] > 1].tobytes()

    def merged(self, parts: Iterator[tuple[bytes, bytes]]) -> bytes:
        """The twice-seen filter of one segment from the pairs of all tasks, folded and compressed."""
        seen, twice = np.zeros(self.bits, bool), np.zeros(self.bits, bool)
        for a, b in parts:
            a = np.frombuffer(a, np.uint32)
            twice[a[seen[a]]] = True
            seen[a] = True
            twice[np.frombuffer(b, np.uint32)] = True
        return zlib.compress(np.packbits(twice.reshape(-1, self.fold).any(axis=0)).tobytes(), 1)

    def gathered(self, segments: list[tuple[int, bytes]]) -> np.ndarray:
        size = self.fold // 8
        out = np.zeros(size * self.segments, np.uint8)
        for s, packed in segments:
            out[s * size : (s + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)
        return out

    def suspects(self, twice: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Whether both places of each hash are in the (gathered) twice-seen filter."""
        segment, p, q = self.places(hashes)
        hit = np.ones(len(hashes), bool)
        for place in (p, q):
            at = segment * np.uint64(self.fold) + (place & np.uint64(self.fold - 1))
            hit &= (twice[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1
        return hit


def _mark(filters: Filters, min_chars: int):
    def rows(hashes: list[np.ndarray]) -> pa.RecordBatch:
        found = list(filters.marked(np.concatenate(hashes)))
        columns = [pa.array([r[k] for r in found], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["segment", "seen", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            data, offsets = text_buffers(b.column(0))
            starts, ends, _ = line_bounds(data, offsets)
            for _, _, _, hashes in long_keys(data, starts, ends, min_chars):
                held.append(hashes)
                n += 2 * len(hashes)
                if n >= FLUSH:
                    yield rows(held)
                    held, n = [], 0
        if held:
            yield rows(held)

    return run


def _merge(filters: Filters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((s, a, b) for batch in batches for s, a, b in zip(*(c.to_pylist() for c in batch.columns)))
        row = next(pairs, None)
        while row is not None:
            segment = row[0]

            def same():
                nonlocal row
                while row is not None and row[0] == segment:
                    yield row[1:]
                    row = next(pairs, None)

            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([filters.merged(same())], pa.binary())], ["segment", "twice"])

    return run


def twice_seen(texts: DataFrame, text_col: str, min_chars: int) -> tuple[Filters, np.ndarray]:
    """Geometry, and the twice-seen filter of all long lines (packed bits)."""
    spark = texts.sparkSession
    room = texts.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n"), F.count("*").alias("r")).first()
    filters = Filters(room["n"] // (min_chars + 1) + room["r"])
    pairs = texts.select(text_col).mapInArrow(_mark(filters, min_chars), "segment int, seen binary, twice binary")
    parts = min(filters.segments, int(spark.conf.get("spark.sql.shuffle.partitions")))
    merged = pairs.repartition(parts, "segment").sortWithinPartitions("segment").mapInArrow(_merge(filters), "segment int, twice binary")
    return filters, filters.gathered([tuple(r) for r in merged.collect()])


def _digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw.translate(_LOWER)).digest()


def _suspect(filters: Filters, twice, min_chars: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = twice.value
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            starts, ends, firsts = line_bounds(data, offsets)
            ids, found = b.column(0).to_pylist(), set()
            for lines, begin, end, hashes in long_keys(data, starts, ends, min_chars):
                hit = filters.suspects(bits, hashes)
                owners = np.searchsorted(firsts, lines[hit], "right") - 1
                found.update((ids[o], _digest(data[i:j].tobytes())) for o, i, j in zip(owners.tolist(), begin[hit].tolist(), end[hit].tolist()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], id_type), pa.array([f[1] for f in found], pa.binary())], ["doc_id", "digest"])

    return run


class _Table:
    """Confirmed digests, sorted, with the id that keeps each."""

    def __init__(self, rows: list[tuple[bytes, object]]):
        rows = sorted(rows, key=lambda r: r[0])
        self.keys = np.array([int.from_bytes(d[:8], "big") for d, _ in rows], np.uint64)
        self.digests, self.keepers = b"".join(d for d, _ in rows), [k for _, k in rows]

    def find(self, digest: bytes) -> int:
        key = np.uint64(int.from_bytes(digest[:8], "big"))
        i = int(np.searchsorted(self.keys, key))
        while i < len(self.keys) and self.keys[i] == key:
            if self.digests[32 * i : 32 * i + 32] == digest:
                return i
            i += 1
        return -1


def _cut(data, starts, ends, firsts, gone: list[int]) -> tuple[list, list, list]:
    """Texts without the lines ``gone`` (ascending numbers), with lines before and lines dropped."""
    raw, texts, dropped = data.tobytes(), [], []
    bounds = np.searchsorted(np.array(gone, np.int64), firsts)
    for t in range(len(firsts) - 1):
        a, b = int(firsts[t]), int(firsts[t + 1])
        out = set(gone[bounds[t] : bounds[t + 1]])
        dropped.append(len(out))
        if out:
            texts.append(b"\n".join(raw[starts[k] : ends[k]] for k in range(a, b) if k not in out))
        else:
            texts.append(raw[starts[a] : ends[b - 1]])
    return [t.decode() for t in texts], np.diff(firsts).tolist(), dropped


def _rewrite(min_chars: int, id_type: pa.DataType, table=None, filters: Filters | None = None, twice=None):
    """Rows (id, text) or, without a table, (id, text, digests to drop) to the result's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = (None, None) if table is None else (table.value, twice.value)
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            starts, ends, firsts = line_bounds(data, offsets)
            ids, gone = b.column(0).to_pylist(), []
            drops = None if known is not None else [set(x or ()) for x in b.column(2).to_pylist()]
            for lines, begin, end, hashes in long_keys(data, starts, ends, min_chars):
                if known is not None:
                    hit = filters.suspects(bits, hashes)
                    lines, begin, end = lines[hit], begin[hit], end[hit]
                owners = np.searchsorted(firsts, lines, "right") - 1
                for line, o, i, j in zip(lines.tolist(), owners.tolist(), begin.tolist(), end.tolist()):
                    if known is not None:
                        at = known.find(_digest(data[i:j].tobytes()))
                        if at >= 0 and known.keepers[at] != ids[o]:
                            gone.append(line)
                    elif drops[o] and _digest(data[i:j].tobytes()) in drops[o]:
                        gone.append(line)
            texts, n, dropped = _cut(data, starts, ends, firsts, gone)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64())],
                ["doc_id", "text", "n_lines", "n_dropped"],
            )

    return run


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, keep: str = "last") -> DataFrame:
    """One row per row of ``docs``: doc_id, text without the repeated lines, n_lines before, n_dropped."""
    from pyspark.sql.pandas.types import to_arrow_type

    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    filters, bits = twice_seen(rows, "text", min_chars)
    twice = spark.sparkContext.broadcast(bits)
    suspects = rows.mapInArrow(_suspect(filters, twice, min_chars, id_type), f"doc_id {kind.simpleString()}, digest binary")
    suspects = materialize(suspects, "line-suspects")
    chosen = (F.max if keep == "last" else F.min)("doc_id")
    confirmed = suspects.distinct().groupBy("digest").agg(F.count("*").alias("n"), chosen.alias("keeper")).where(F.col("n") >= min_docs)
    confirmed = materialize(confirmed, "line-repeated")
    known, schema = confirmed.count(), f"doc_id {kind.simpleString()}, text string, n_lines bigint, n_dropped bigint"
    if known <= TABLE_KEYS:
        table = spark.sparkContext.broadcast(_Table([(bytes(r["digest"]), r["keeper"]) for r in confirmed.select("digest", "keeper").collect()]))
        return rows.mapInArrow(_rewrite(min_chars, id_type, table, filters, twice), schema)
    hot = max(HOT_DOCS, -(-suspects.count() // TABLE_KEYS))
    often, seldom = (confirmed.where(c).select("digest", "keeper") for c in (F.col("n") > hot, F.col("n") <= hot))
    parts = [
        suspects.join(F.broadcast(often), "digest"),
        suspects.join(F.broadcast(often), "digest", "left_anti").join(seldom, "digest"),
    ]
    parts = [p.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "digest") for p in parts]
    drops = parts[0].unionByName(parts[1]).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("digest").alias("drops"))
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "drops")
    return joined.mapInArrow(_rewrite(min_chars, id_type), schema)
