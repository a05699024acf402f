"""A small log-structured table of the latest parts per key, for update-mode queries.

Every micro-batch adds a segment of changed parts. A *ledger* of numbered manifests names the live
segments; a manifest is written last, by an atomic rename, so a segment of a batch that failed half-way
is never seen, and a batch that is played again finds itself in the ledger and adds nothing. When
``fanout`` segments of one level are live they are merged into one of the next level: the latest part
per key stays, parts of windows that the watermark has passed go. Segments all of whose windows are
passed leave the ledger unread. So a batch reads a bounded number of segments that hold open windows
only, however long the query runs.

Only the driver's ``foreachBatch`` function of one query writes a table. Manifests list segments, not
rows; they and the folders that no kept manifest names are removed by :meth:`PartsTable.vacuum`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.streaming.sinks import latest_per_key

#: Segments of one level that are merged into one of the next.
FANOUT = 8
#: Manifests kept for readers that are under way.
KEPT_MANIFESTS = 20
#: Rows in a file of a merged segment.
FILE_ROWS = 500_000


@dataclass
class Segment:
    path: str
    level: int
    first_batch: int
    last_batch: int
    rows: int
    low: int  # epoch seconds of the first window's start
    newest: int  # of the last window's start
    high: int  # of the last window's end


@dataclass
class Manifest:
    version: int = -1
    batch_id: int = -1
    segments: list[Segment] = field(default_factory=list)
    #: Last window start among all batches.
    newest: int | None = None

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(**{**d, "segments": [Segment(**s) for s in d["segments"]]})


class Files:
    """The few file-system calls needed, through Spark's own file systems (any URI Spark reads)."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Written beside its place, then renamed: readers see all of it or nothing."""
        draft = f"{path}.{uuid.uuid4().hex[:8]}.draft"
        stream = self.fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(self._path(draft), self._path(path)):
            raise RuntimeError(f"{path} exists: another writer has this table")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


class PartsTable:
    """``keys`` name a part, ``window_start`` and ``window_end`` (timestamps) its window; ``delay_seconds``
    is the query's watermark delay."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], delay_seconds: int, fanout: int = FANOUT):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys
        self.delay, self.fanout = delay_seconds, fanout
        self.files = Files(spark, self.root)
        self.segments_read = 0  # by the last batch, for monitoring

    # ---- ledger ----

    def _versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.root}/ledger") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self) -> Manifest:
        """What is committed now."""
        versions = self._versions()
        return Manifest.from_json(self.files.read(f"{self.root}/ledger/{max(versions):020d}.json")) if versions else Manifest()

    # ---- reading ----

    def _load(self, segments: list[Segment], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[s.path for s in segments])

    def read(self, schema, since: int | None = None) -> DataFrame:
        """The latest committed part of each key; of windows that start at ``since`` or later."""
        live = [s for s in self.manifest().segments if since is None or s.high > since]
        self.segments_read = len(live)
        if not live:
            return self.spark.createDataFrame([], schema).drop("batch_id")
        parts = self._load(live, schema)
        if since is not None:
            parts = parts.where(F.col("window_start") >= F.timestamp_seconds(F.lit(since)))
        return latest_per_key(parts, self.keys)

    # ---- writing ----

    def write_segment(self, rows: DataFrame, level: int, first: int, last: int, files: int | None = None) -> Segment | None:
        """Rows (with ``batch_id``) as a segment that no manifest names yet; None if there are none."""
        path = f"{self.root}/segments/L{level}-{first}-{last}-{uuid.uuid4().hex[:8]}"
        (rows.coalesce(files) if files else rows).write.parquet(path)
        stats = self.spark.read.schema(rows.schema).parquet(path).agg(
            F.count("*").alias("n"), F.min(F.unix_seconds("window_start")).alias("low"), F.max(F.unix_seconds("window_end")).alias("high"), F.max(F.unix_seconds("window_start")).alias("newest")
        ).first()
        if not stats["n"]:
            self.files.delete(path)
            return None
        return Segment(path, level, first, last, stats["n"], stats["low"], stats["newest"], stats["high"])

    def commit(self, segment: Segment | None, batch_id: int) -> Manifest:
        """Make the batch's segment visible, merging levels that are full. A batch that is committed
        already changes nothing."""
        now = self.manifest()
        if batch_id <= now.batch_id:
            return now
        newest = now.newest
        live = list(now.segments)
        if segment is not None:
            newest = segment.newest if newest is None else max(newest, segment.newest)
            live.append(segment)
        # Windows behind the watermark that the batches before this one raised are updated by none after it.
        passed = None if now.newest is None else now.newest - self.delay
        live = [s for s in live if passed is None or s.high > passed]
        level = 0
        while level <= max((s.level for s in live), default=-1):
            full = [s for s in live if s.level == level]
            if len(full) >= self.fanout:
                live = [s for s in live if s.level != level]
                merged = self._merge(full, passed)
                live += [merged] if merged else []
            level += 1
        after = Manifest(now.version + 1, batch_id, live, newest)
        self.files.publish(f"{self.root}/ledger/{after.version:020d}.json", after.to_json())
        return after

    def _merge(self, segments: list[Segment], passed: int | None) -> Segment | None:
        schema = self.spark.read.parquet(segments[0].path).schema
        parts = self._load(segments, schema)
        if passed is not None:
            parts = parts.where(F.col("window_end") > F.timestamp_seconds(F.lit(passed)))
        others = [c for c in schema.names if c not in self.keys]
        last = parts.groupBy(*self.keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_last")).select(*self.keys, "_last.*").select(*schema.names)
        files = -(-sum(s.rows for s in segments) // FILE_ROWS)
        return self.write_segment(last, segments[0].level + 1, min(s.first_batch for s in segments), max(s.last_batch for s in segments), files)

    def vacuum(self, keep: int = KEPT_MANIFESTS) -> int:
        """Remove manifests but the last ``keep``, and segments that none of these names (half-written
        ones too). Returns the number of segments removed. Only the writer may call it, between batches."""
        versions = self._versions()
        kept = versions[-keep:]
        named = {s.path.rsplit("/", 1)[1] for v in kept for s in Manifest.from_json(self.files.read(f"{self.root}/ledger/{v:020d}.json")).segments}
        gone = [n for n in self.files.names(f"{self.root}/segments") if n not in named]
        for n in gone:
            self.files.delete(f"{self.root}/segments/{n}")
        for v in versions[:-keep]:
            self.files.delete(f"{self.root}/ledger/{v:020d}.json")
        return len(gone)
