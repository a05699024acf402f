"""Totals over all progress reports of streaming queries (no UI or REST endpoint needed)."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class ProgressTotals(StreamingQueryListener):
    """Adds up every progress report as it arrives; Spark itself keeps the last 100 only.

    Register it before the queries start: ``totals = ProgressTotals.attach(spark)``.
    """

    def __init__(self):
        self._lock = threading.Condition()
        self._by_query: dict[str, dict] = {}
        self._ended: set[str] = set()

    @classmethod
    def attach(cls, spark: SparkSession) -> ProgressTotals:
        totals = cls()
        spark.streams.addListener(totals)
        return totals

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        ops = p.stateOperators or []
        with self._lock:
            t = self._by_query.setdefault(str(p.runId), {"batches": 0, "ms": 0, "rows": 0, "state": 0, "late": 0})
            t["batches"] += 1
            t["ms"] += p.durationMs.get("triggerExecution", 0)
            t["rows"] += p.numInputRows
            t["state"] = max(t["state"], sum(o.numRowsTotal for o in ops))
            t["late"] += sum(o.numRowsDroppedByWatermark for o in ops)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def summary(self, q: StreamingQuery, log_rows: int | None = None, wait: float = 30.0) -> dict:
        """Batches, summed batch time, input rows as Spark counts them (a source read by
        several plan branches is counted once per branch), rows per second (of
        ``log_rows`` when given, else of counted rows), peak state rows and rows dropped by
        the watermark. Reports arrive after the fact: of an ended query all are waited for."""
        run = str(q.runId)
        with self._lock:
            if not q.isActive:
                self._lock.wait_for(lambda: run in self._ended, wait)
            t = dict(self._by_query.get(run, {"batches": 0, "ms": 0, "rows": 0, "state": 0, "late": 0}))
        rows = log_rows if log_rows is not None else t["rows"]
        return {
            "name": q.name,
            "batches": t["batches"],
            "seconds": round(t["ms"] / 1000.0, 3),
            "rows_counted_by_spark": t["rows"],
            "rows_per_sec": round(rows / (t["ms"] / 1000.0)) if t["ms"] else 0,
            "peak_state_rows": t["state"],
            "rows_dropped_by_watermark": t["late"],
        }
