"""Counts of rejected messages in passing (P4): how many of each micro-batch's
messages were rejected, by reason, without a second pass over them.

``observed`` puts the counters into the plan of a parsed stream (Spark's
observed metrics: summed with the tasks' other accumulators); a ``RejectCounts``
listener takes them from every batch's progress.  A batch that is run again
after a restart replaces its counts.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from streamlens import schemas
from streamlens.operators.parse import _NUMERIC, REJECT

ACCEPTED = "accepted"
_NAME = "reject_counts"


def reasons(kind: str) -> list[str]:
    """Every reason with which the parser may reject a message of a kind."""
    out = ["malformed_json", "not_object"]
    for f in schemas.RECORD[kind].fields:
        if f.name in schemas.REQUIRED[kind]:
            out.append(f"missing:{f.name}")
            if isinstance(f.dataType, _NUMERIC):
                out.append(f"bad_type:{f.name}")
            if f.name in schemas.LIMITS:
                out.append(f"out_of_range:{f.name}")
    return [*out, f"bad_time:{schemas.TIME_FIELD[kind]}"]


def observed(parsed: DataFrame, kind: str) -> DataFrame:
    """``parsed`` (of ``parse_messages``), unchanged, with counters on it."""
    reason = F.col(REJECT)
    return parsed.observe(_NAME, F.count_if(reason.isNull()).alias("n"),
                          *[F.count_if(reason == r).alias(f"n{i}") for i, r in enumerate(reasons(kind))])


class RejectCounts(StreamingQueryListener):
    """Counts by (query id, batch) of the streams of one kind; register it with
    ``spark.streams.addListener`` before the queries start."""

    def __init__(self, kind: str):
        self.reasons = reasons(kind)
        self.batches: dict[tuple[str, int], dict[str, int]] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(_NAME)
        if row is None:
            return
        found = row.asDict()
        counts = {ACCEPTED: found["n"], **{r: found[f"n{i}"] for i, r in enumerate(self.reasons)}}
        if any(counts.values()):  # not a batch without data
            with self._changed:
                self.batches[str(event.progress.id), event.progress.batchId] = counts

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, run_id: str, timeout_s: float = 60) -> bool:
        """Wait for the last events of an ended query; False if they did not come."""
        with self._changed:
            return self._changed.wait_for(lambda: str(run_id) in self._ended, timeout_s)

    def frame(self, spark: SparkSession) -> DataFrame:
        """(query_id, batch_id, reason, n), one row per reason met in a batch."""
        rows = [(q, b, r, n) for (q, b), counts in self.batches.items() for r, n in counts.items() if n]
        return spark.createDataFrame(rows, T.StructType.fromDDL("query_id string, batch_id long, reason string, n long"))
