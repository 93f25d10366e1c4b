"""Running a stream as a job: told about batch by batch, started again after errors, stopped after a whole batch."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

Tell = Callable[[str], None]

# Seconds between looks at a running query.
_LOOK = 0.2


class StreamReport(StreamingQueryListener):
    """Tells of every batch and every failure of the session's streams, one line of JSON each.

    A batch comes with its number, how many rows it read, and what was counted in its pass:
    lines loaded and rejected, messages landed, quarantined and undated. An error of the
    broker, of a file or of a value ends its query, and is told with its message.
    """

    def __init__(self, tell: Tell = print):
        self._tell = tell

    def onQueryStarted(self, event) -> None:
        self._say("started", event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        self._say("batch", progress.runId, batch=progress.batchId, rows=progress.numInputRows, **counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._say("failed", event.runId, error=event.exception)
        else:
            self._say("ended", event.runId)

    def _say(self, what: str, run, **more) -> None:
        self._tell(json.dumps({"stream": what, "run": str(run), **more}))


def reported(spark: SparkSession, tell: Tell = print) -> StreamReport:
    """Report the session's streams from now on; ``spark.streams.removeListener`` ends it."""
    report = StreamReport(tell)
    spark.streams.addListener(report)
    return report


def run_stream(start: Callable[[], StreamingQuery], stop: threading.Event, retries: int = 0, pause: float = 10.0) -> None:
    """Run a stream until it ends by itself or ``stop`` is set; then its batch is finished first.

    A query that fails is started again from its checkpoint after ``pause`` seconds, up to
    ``retries`` times in a row without a finished batch between them; then its error is raised.
    """
    failures = 0
    while True:
        query = start()
        try:
            while not query.awaitTermination(_LOOK):
                if stop.is_set():
                    stop_after_batch(query)
                    return
            return
        except StreamingQueryException:
            failures = 1 if query.lastProgress is not None else failures + 1
            if failures > retries or stop.wait(pause):
                raise


def stop_after_batch(query: StreamingQuery) -> None:
    """Stop a running query once the batch that it is at is written and committed.

    A later batch that has just begun is given up; it comes again when the query goes on
    from its checkpoint, and nothing of it is seen before.
    """
    last = _batch(query)
    while query.isActive and _batch(query) == last and _in_batch(query):
        time.sleep(_LOOK / 4)
    query.stop()


def _batch(query: StreamingQuery) -> int:
    progress = query.lastProgress
    return -1 if progress is None else progress.batchId


def _in_batch(query: StreamingQuery) -> bool:
    status = query.status
    return status["isTriggerActive"] and not status["message"].startswith("Waiting")
