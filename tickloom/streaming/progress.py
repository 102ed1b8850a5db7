"""What a stream did with its rows, from its progress reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COUNTS = "query string, batch bigint, rows bigint, late bigint, duplicates bigint"


def counts_of(progress) -> tuple[str, int, int, int, int]:
    """Query, batch, rows read, rows that came behind the watermark, and repeated rows, of one progress report."""
    report = json.loads(progress.json) if hasattr(progress, "json") else progress
    operators = report.get("stateOperators") or []
    late = sum(o.get("numRowsDroppedByWatermark") or 0 for o in operators)
    repeated = sum((o.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0) for o in operators)
    return report.get("name") or report["id"], report["batchId"], report.get("numInputRows") or 0, late, repeated


class ProgressLog(StreamingQueryListener):
    """Keeps the counts of every micro-batch of a session's streams; ``spark.streams.addListener`` starts it.

    ``write`` appends what has come since the last call to a table of counts.
    """

    def __init__(self) -> None:
        self.counts: list[tuple[str, int, int, int, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.counts.append(counts_of(event.progress))

    def onQueryTerminated(self, event) -> None:
        pass

    def write(self, spark: SparkSession, path: str) -> None:
        taken, self.counts = self.counts, []
        if taken:
            spark.createDataFrame(taken, COUNTS).write.mode("append").parquet(path)


def table_of(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The counts of a query's last micro-batches (as many as the session keeps)."""
    return spark.createDataFrame([counts_of(p) for p in query.recentProgress], COUNTS)
