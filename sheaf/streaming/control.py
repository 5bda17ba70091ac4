"""Run control of an ingest stream (R6): start, stop, and a table of what happened.

A ``StreamingQueryListener`` notes each start, micro-batch and end of the run's query, with the
counts that ``observe`` took in the micro-batch; ``status`` is the newest state and ``history`` the
notes as a DataFrame.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

NOTES = 1000               # notes that are kept
OBSERVED = "ingest_input"
HISTORY = "at double, event string, run string, batch_id long, rows long, values_seen long, empty_values long, error string"


class _Notes(StreamingQueryListener):
    def __init__(self):
        self.rows: deque[tuple] = deque(maxlen=NOTES)
        self.run: str | None = None
        self.changed = threading.Condition()

    def note(self, event: str, run, batch_id=None, rows=None, seen=None, empty=None, error=None) -> None:
        if self.run is not None and str(run) != self.run:
            return                                                  # another query of the session
        with self.changed:
            self.rows.append((time.time(), event, str(run), batch_id, rows, seen, empty, error))
            self.changed.notify_all()

    def onQueryStarted(self, event) -> None:
        self.note("started", event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(OBSERVED)
        self.note("progress", p.runId, p.batchId, p.numInputRows, seen["values_seen"] if seen else None, seen["empty_values"] if seen else None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.note("failed" if event.exception else "stopped", event.runId, error=event.exception)


class IngestRun:
    """One ingest stream that can be started, watched and stopped.

    ``begin`` takes the observed events and starts the query, as ``ingest_stream.start`` does.
    """

    def __init__(self, spark: SparkSession, events: Callable[[], DataFrame], begin: Callable[[DataFrame], StreamingQuery], mode: str = "committed"):
        self.spark, self.events, self.begin, self.mode = spark, events, begin, mode
        self.query: StreamingQuery | None = None
        self.notes: _Notes | None = None

    def start(self) -> StreamingQuery:
        """An error while the run is active; after an end it may be started again."""
        if self.query is not None and self.query.isActive:
            raise RuntimeError("the ingest stream is already running")
        self._forget()
        self.notes = _Notes()
        self.spark.streams.addListener(self.notes)
        seen = self.events().observe(OBSERVED, F.count(F.lit(1)).alias("values_seen"),
                                     F.coalesce(F.sum((F.coalesce(F.trim("value"), F.lit("")) == "").cast("long")), F.lit(0)).alias("empty_values"))
        try:
            self.query = self.begin(seen)
        except Exception:
            self._forget()
            raise
        self.notes.run = str(self.query.runId)
        return self.query

    def stop(self, timeout_s: float = 30.0) -> bool:
        """Stop and wait; False if the query had not ended after ``timeout_s`` seconds."""
        if self.query is None or not self.query.isActive:
            return True
        self.query.stop()
        try:
            return bool(self.query.awaitTermination(timeout_s))
        except Exception:                                           # it ended with an error, which status() shows
            return True

    def wait(self, event: str, timeout_s: float = 30.0) -> bool:
        """Until the listener has noted ``event`` (it is told after the fact)."""
        with self.notes.changed:
            return self.notes.changed.wait_for(lambda: any(r[1] == event for r in self.notes.rows), timeout_s)

    def status(self) -> dict:
        if self.query is None:
            return {"state": "stopped", "mode": self.mode, "last_error": None, "batches": 0, "rows": 0}
        error = self.query.exception()
        progress = [r for r in list(self.notes.rows) if r[1] == "progress"]
        state = "running" if self.query.isActive else "failed" if error else "stopped"
        return {"state": state, "mode": self.mode, "last_error": str(error) if error else None,
                "batches": len(progress), "rows": sum(r[4] or 0 for r in progress)}

    def history(self) -> DataFrame:
        return self.spark.createDataFrame(list(self.notes.rows) if self.notes else [], HISTORY)

    def _forget(self) -> None:
        if self.notes is not None:
            self.spark.streams.removeListener(self.notes)
