"""Users that hold a large share of the stream, from a bounded summary kept across batches.

The summary is that of Misra and Gries: at most ``k`` counters. A micro-batch's exact counts (one hash
aggregate) are added to the counters, the (k+1)-th largest sum is taken off all of them, and what is not
positive goes. A counter is never above the true count N_u and never more than ``error`` below it, where
``error``, the sum of what was taken off, is at most N / (k+1) for N rows in all; so a user with over that
many rows always has a counter. Summaries merge in any order with the same bound.

The anomaly join spreads only the hot users' buffered transactions over several state partitions, and
copies only their statistics. A query's plan is fixed when it starts, so the list is read at start; it only
grows while a checkpoint lives, since rows spread under an earlier list may still be in state (copies for
salt 0 are always made, so rows from before a user became hot are found as well).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlens.streaming.parts import Files

#: Counters of the summary.
COUNTERS = 1000
#: Share of all rows from which a user is hot.
HOT_SHARE = 0.01
#: Versions of the summary kept.
KEPT_VERSIONS = 20


@dataclass
class FrequentItems:
    """At most ``k`` counters; ``counter <= count <= counter + error`` for every item (counter 0 if absent)."""

    k: int = COUNTERS
    total: int = 0
    error: int = 0
    counters: dict[str, int] = field(default_factory=dict)

    def added(self, counts: DataFrame) -> FrequentItems:
        """The summary with ``counts`` (item string, n bigint; one row per item) added. Only the k+1
        largest sums reach the driver."""
        spark = counts.sparkSession
        rows = counts.select(F.col("item").cast("string").alias("item"), F.col("n").cast("bigint").alias("n")).where("item IS NOT NULL")
        total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        known = spark.createDataFrame(list(self.counters.items()), "item string, n bigint")
        sums = rows.unionByName(known).groupBy("item").agg(F.sum("n").alias("n"))
        top = [(r["item"], r["n"]) for r in sums.orderBy(F.desc("n"), "item").limit(self.k + 1).collect()]
        return self._reduced(self.total + total, self.error, top)

    def merged(self, other: FrequentItems) -> FrequentItems:
        sums = dict(self.counters)
        for item, n in other.counters.items():
            sums[item] = sums.get(item, 0) + n
        return self._reduced(self.total + other.total, self.error + other.error, sorted(sums.items(), key=lambda x: (-x[1], x[0])))

    def _reduced(self, total: int, error: int, top: list[tuple[str, int]]) -> FrequentItems:
        off = top[self.k][1] if len(top) > self.k else 0
        return FrequentItems(self.k, total, error + off, {i: n - off for i, n in top[: self.k] if n > off})

    def frequent(self, share: float) -> list[str]:
        """Every item with at least ``share`` of all rows (if that is over 1/(k+1)), and perhaps some with
        up to ``error`` rows less."""
        return sorted(i for i, n in self.counters.items() if n + self.error >= share * self.total)


class HotUsers:
    """Summaries by batch and the growing list of hot users, in a folder beside the checkpoints."""

    def __init__(self, spark: SparkSession, path: str, k: int = COUNTERS):
        self.spark, self.path, self.k = spark, path.rstrip("/"), k
        self.files = Files(spark, self.path)

    def _latest(self, kind: str) -> tuple[int, dict | None]:
        names = [n for n in self.files.names(f"{self.path}/{kind}") if n.endswith(".json")]
        if not names:
            return -1, None
        return int(names[-1][:-5]), json.loads(self.files.read(f"{self.path}/{kind}/{names[-1]}"))

    def _publish(self, kind: str, version: int, content: dict) -> None:
        self.files.publish(f"{self.path}/{kind}/{version:020d}.json", json.dumps(content))
        for old in [n for n in self.files.names(f"{self.path}/{kind}") if n.endswith(".json")][:-KEPT_VERSIONS]:
            self.files.delete(f"{self.path}/{kind}/{old}")

    def summary(self) -> FrequentItems:
        found = self._latest("summary")[1]
        return FrequentItems(**found) if found else FrequentItems(self.k)

    def add_batch(self, rows: DataFrame, batch_id: int, user_col: str = "user_id") -> None:
        """Adds a micro-batch; one that was added already changes nothing."""
        if batch_id <= self._latest("summary")[0]:
            return
        counts = rows.groupBy(F.col(user_col).alias("item")).agg(F.count(F.lit(1)).alias("n"))
        self._publish("summary", batch_id, asdict(self.summary().added(counts)))

    def known(self) -> list[str]:
        """The list of the last start."""
        found = self._latest("list")[1]
        return found["users"] if found else []

    def grown(self, share: float = HOT_SHARE) -> list[str]:
        """The list for a query that starts now: all that were hot before, and those that are."""
        version, _ = self._latest("list")
        known = self.known()
        users = sorted(set(known) | set(self.summary().frequent(share)))
        if users != known:
            self._publish("list", version + 1, {"users": users})
        return users


def start_hot_users(tx: DataFrame, checkpoint: str, path: str, name: str = "HotUsers", trigger: dict | None = None, k: int = COUNTERS) -> StreamingQuery:
    """A stateless query that keeps the summary of a stream's users."""
    users = HotUsers(tx.sparkSession, path, k)
    w = tx.select("user_id").writeStream.queryName(name).option("checkpointLocation", checkpoint)
    w = w.foreachBatch(lambda batch, batch_id: users.add_batch(batch, batch_id))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
