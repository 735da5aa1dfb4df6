"""What the totals query took in and left out, per batch, while it runs."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener
from pyspark.sql.window import Window

from tillwatch.sinks.ledger import read_or_empty

#: Name of the observed metrics ``events`` and ``timed`` in a batch's progress.
INTAKE = "intake"

_PROGRESS = "stream string, batch_id long, records long, events long, timed long, watermark timestamp"


class BatchProgress(StreamingQueryListener):
    """Writes a row per batch of every query that observes ``INTAKE``: ``spark.streams.addListener(BatchProgress(spark, path))``.

    Rows are records read, accepted events, those with a time, and the watermark that decided which were late. A batch that is run
    again writes the same row to the same place. Spark calls back behind the batch, so a row may follow a little later.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.seen: dict[str, int] = {}

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress, stream = event.progress, str(event.progress.id)
        intake = progress.observedMetrics.get(INTAKE)
        if intake is not None and progress.numInputRows:
            row = (stream, progress.batchId, progress.numInputRows, intake["events"], intake["timed"], progress.eventTime.get("watermark"))
            text = _PROGRESS.replace("watermark timestamp", "watermark string")
            self.spark.createDataFrame([row], text).coalesce(1).write.mode("overwrite").json(f"{self.path}/{stream}/{progress.batchId}")
        self.seen[stream] = progress.batchId

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the rows of all batches of a query that has ended are written."""
        last, until = query.lastProgress, time.monotonic() + seconds
        while last and self.seen.get(str(query.id), -1) < last["batchId"]:
            if time.monotonic() > until:
                raise TimeoutError(f"no progress of batch {last['batchId']} within {seconds} seconds")
            time.sleep(0.05)


def batch_progress(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, _PROGRESS)


def late_events(change_log: DataFrame, progress: DataFrame) -> DataFrame:
    """``(stream, batch_id, records, events, timed, late)``: events that a batch left out as their window was closed.

    The change log tells how many a batch counted, as what its groups grew by; the others of its timed events were late. No event
    is read again. The stream's own figure counts rows of partial aggregation, whose number depends on the tasks.
    """
    keys = ["stream", "start", "end", "type", "is_failed"]
    before = F.lag("event_count", 1, 0).over(Window.partitionBy(*keys).orderBy("batch_id"))
    grown = change_log.select("stream", "batch_id", (F.col("event_count") - before).alias("grown"))
    counted = grown.groupBy("stream", "batch_id").agg(F.sum("grown").alias("counted"))
    late = F.col("timed") - F.coalesce("counted", F.lit(0))
    return progress.join(counted, ["stream", "batch_id"], "left").select("stream", "batch_id", "records", "events", "timed", late.alias("late"))
