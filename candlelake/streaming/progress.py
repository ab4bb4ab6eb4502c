"""What queries report about their batches, kept beyond the few batches that Spark remembers."""

from __future__ import annotations

import threading
import time
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Counts the rows that each query has dropped for being later than its watermark, over all of its batches.

    Register it before the queries start: ``LateRows.of(spark)``. A query that is started again from its checkpoint goes
    on with its count, since its id stays; a batch that is run again is counted once.
    """

    def __init__(self) -> None:
        self._seen: dict[str, dict[int, int]] = defaultdict(dict)
        self._totals: dict[str, int] = defaultdict(int)
        self._news = threading.Condition()

    @classmethod
    def of(cls, spark: SparkSession) -> LateRows:
        listener = cls()
        spark.streams.addListener(listener)
        return listener

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        with self._news:
            # Only the newest batch can come again, so the earlier ones need no entry.
            query, batch = str(progress.id), progress.batchId
            self._totals[query] += dropped - self._seen[query].get(batch, 0)
            self._seen[query] = {batch: dropped}
            self._news.notify_all()

    def count(self, query: StreamingQuery, timeout: float = 60.0) -> int:
        """Rows dropped so far; waits until the report of the query's last batch has come."""
        name, last, until = str(query.id), query.lastProgress, time.monotonic() + timeout
        with self._news:
            while last is not None and max(self._seen[name], default=-1) < last["batchId"]:
                if not self._news.wait(until - time.monotonic()):
                    raise TimeoutError(f"no report of batch {last['batchId']} of query {name}")
            return self._totals[name]
