"""What running streams do, landed as a table: a row for each trigger of each query."""

from __future__ import annotations

from threading import Condition

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = """query string, query_id string, run_id string, batch_id long, started_at string, input_rows long,
    late_rows long, state_rows long, state_bytes long, duration_ms long, add_batch_ms long"""


def trigger_row(progress) -> tuple:
    """One trigger. Late rows are those that stateful operators dropped behind the watermark; a windowed aggregate
    counts them after its partial sums, so a late window there is one row per task."""
    states, took = progress.stateOperators, progress.durationMs
    return (progress.name, str(progress.id), str(progress.runId), progress.batchId, progress.timestamp,
            progress.numInputRows, sum(s.numRowsDroppedByWatermark for s in states), sum(s.numRowsTotal for s in states),
            sum(s.memoryUsedBytes for s in states), took.get("triggerExecution"), took.get("addBatch"))


class RunMetrics(StreamingQueryListener):
    """Appends the triggers of all queries of a session to a table, ``every`` so many and when a query ends.

    Use as a context: it listens inside. Triggers are small rows on the driver, never more than ``every`` of them.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self._spark, self._path, self._every = spark, path, every
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._change = Condition()

    def __enter__(self) -> RunMetrics:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)
        with self._change:
            self._flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._change:
            self._rows.append(trigger_row(event.progress))
            if len(self._rows) >= self._every:
                self._flush()

    def onQueryTerminated(self, event) -> None:
        with self._change:
            try:
                self._flush()
            finally:
                self._ended.add(str(event.runId))
                self._change.notify_all()

    def landed(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all triggers of a query that has ended are in the table; events reach a listener some time later."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"the end of query {query.runId} was not reported within {seconds} seconds")

    def _flush(self) -> None:
        if self._rows:
            frame = self._spark.createDataFrame(self._rows, SCHEMA).coalesce(1)
            frame.write.mode("append").parquet(self._path)
            self._rows = []
